"""Published bars in versions: a snapshot names what is live, and a publish swaps it by one rename.

Below the table's folder::

    data/version=V/symbol=S/year=Y    the rows that one publish wrote; never changed afterwards
    keys/version=V                    per symbol and year: rows and checksum
    <side>/version=V                  what else belongs to the publish, such as refused rows
    snapshots/number=N/state          live versions, and the keys of theirs that later versions replaced
    snapshots/number=N/ledger         the delivery that made the snapshot
    pending/V                         a snapshot that is not in force yet

Readers follow the snapshot with the highest number, so they see all of a publish or nothing of it, and a reader that has begun keeps its
files until ``vacuum``. Two publishers that start from one snapshot cannot both take the next number.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BAR, STANDARD_COLUMNS

KEY = ["version", "symbol", "year"]
STATE = "kind string, version string, symbol string, year int"
LEDGER = "token string, version string, last_order string, delivered_rows long"
#: Beyond these a publish writes all live rows anew as one version: readers list the live versions and hold the replaced keys in memory.
MAX_VERSIONS, MAX_REPLACED = 32, 100_000
WHOLE = "w"  # ends the name of such a version


class PublishConflict(RuntimeError):
    """Another publish replaced some of the same symbols meanwhile."""


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> dict[str, int]:
    """What a folder holds, with the times of change in milliseconds; an absent folder holds nothing."""
    place, fs = _hadoop(spark, path)
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(place)} if fs.exists(place) else {}


def remove(spark: SparkSession, path: str) -> None:
    place, fs = _hadoop(spark, path)
    fs.delete(place, True)


def take_name(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a folder to a name that nothing has yet; False where something has."""
    jvm = spark._jvm
    place, fs = _hadoop(spark, target)
    fs.mkdirs(place.getParent())
    options = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration()).rename(
            jvm.org.apache.hadoop.fs.Path(source), place, options)
    except Exception:
        if fs.exists(place):
            return False
        raise
    return True


def numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n.partition("=")[2]) for n in names(spark, f"{root}/snapshots"))


def latest(spark: SparkSession, root: str) -> int:
    """The number of the snapshot in force, 0 before the first publish."""
    return max(numbers(spark, root), default=0)


class Snapshot:
    """What one snapshot says. Live versions and wholly replaced years are few and read at once; replaced keys are bounded and broadcast."""

    def __init__(self, spark: SparkSession, root: str, path: str | None):
        self.spark, self.root = spark, root
        empty = spark.createDataFrame([], STATE)
        self.state = spark.read.schema(STATE).parquet(f"{path}/state") if path else empty
        few = self.state.where("kind <> 'key'").unionByName(self.state.where("kind = 'key'").limit(1)).collect() if path else []
        self.live = sorted(r["version"] for r in few if r["kind"] == "live")
        self.years = sorted((r["version"], r["year"]) for r in few if r["kind"] == "year")
        self.replaced = self.state.where("kind = 'key'").select(*KEY)
        self.has_replaced = any(r["kind"] == "key" for r in few)

    @classmethod
    def at(cls, spark: SparkSession, root: str, number: int) -> "Snapshot":
        return cls(spark, root, f"{root}/snapshots/number={number}" if number else None)

    def _current(self, rows: DataFrame) -> DataFrame:
        """Without replaced years and keys."""
        for version in {v for v, _ in self.years}:
            gone = [y for v, y in self.years if v == version]
            rows = rows.where(~((F.col("version") == version) & F.col("year").isin(gone)))
        return rows.join(F.broadcast(self.replaced), KEY, "left_anti") if self.has_replaced else rows

    def keys(self) -> DataFrame:
        """(version, symbol, year, row_count, checksum) of all live rows."""
        return self._current(self._table("keys", "symbol string, year int, row_count long, checksum long"))

    def all_keys(self) -> DataFrame:
        return self._table("keys", "symbol string, year int, row_count long, checksum long")

    def rows(self) -> DataFrame:
        """The live rows, with their version."""
        return self._current(self._table("data", BAR))

    def _table(self, name: str, schema) -> DataFrame:
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
        if not self.live:
            return self.spark.createDataFrame([], schema)
        places = [f"{self.root}/{name}/version={v}" for v in self.live]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*places)


def versioned(spark: SparkSession, root: str) -> bool:
    return bool(names(spark, f"{root}/snapshots"))


def live_rows(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The rows of the snapshot in force, or of an earlier one that has not been vacuumed."""
    if number is not None and number not in numbers(spark, root):
        raise ValueError(f"no snapshot {number} of {root}")
    return Snapshot.at(spark, root, latest(spark, root) if number is None else number).rows()


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row per snapshot: its number, the token of its delivery, its version, the last order in it, and its rows."""
    schema = T.StructType.fromDDL(LEDGER).add("number", T.IntegerType())
    if not versioned(spark, root):
        return spark.createDataFrame([], schema)
    base = f"{root}/snapshots"
    return spark.read.schema(schema).option("basePath", base).parquet(f"{base}/number=*/ledger")


def applied(spark: SparkSession, root: str, token: str) -> bool:
    """Whether a delivery is already part of the table."""
    return not ledger(spark, root).where(F.col("token") == token).isEmpty()


def side_table(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """What the publishes in force and before them have put beside the data, with their versions; leftovers of failed ones are not part of it."""
    full = T.StructType.fromDDL(schema).add("version", T.StringType())
    try:
        rows = spark.read.schema(full).parquet(f"{root}/{name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
    return rows.join(ledger(spark, root).select("version"), "version", "left_semi").select(*full.fieldNames())


def checksum() -> F.Column:
    """Of a group of rows, whatever their order: rows that occur twice do not cancel out, as a sum keeps them."""
    return F.sum(F.xxhash64(*STANDARD_COLUMNS).cast("decimal(38,0)")).alias("sum_")


def key_rows(rows: DataFrame) -> DataFrame:
    """(symbol, year, row_count, checksum) of rows with their year."""
    sums = rows.groupBy("symbol", "year").agg(F.count("*").alias("row_count"), checksum())
    return sums.select("symbol", "year", "row_count", F.xxhash64(F.col("sum_").cast("string")).alias("checksum"))


def _next_state(base: Snapshot, symbols: DataFrame, version: str | None) -> DataFrame:
    """The state in which ``version`` holds ``symbols`` and all earlier rows of theirs are replaced."""
    spark = base.spark
    added = spark.range(1 if version else 0).select(
        F.lit("live").alias("kind"), F.lit(version).cast("string").alias("version"),
        F.lit(None).cast("string").alias("symbol"), F.lit(None).cast("int").alias("year"))
    if not base.live or not version:
        return base.state.unionByName(added)
    gone = F.lit(False)
    for v, year in base.years:
        gone = gone | ((F.col("version") == v) & (F.col("year") == year))
    keys = base.all_keys().select(*KEY)
    if base.has_replaced:
        keys = keys.join(F.broadcast(base.replaced.withColumn("was_", F.lit(True))), KEY, "left")
    else:
        keys = keys.withColumn("was_", F.lit(None).cast("boolean"))
    keys = keys.join(symbols.select("symbol", F.lit(True).alias("now_")), "symbol", "left").select(
        *KEY, (gone | F.coalesce("was_", F.lit(False)) | F.coalesce("now_", F.lit(False))).alias("dead"))
    years = keys.groupBy("version", "year").agg(F.count("*").alias("n"), F.count_if("dead").alias("lost"))
    versions = years.groupBy("version").agg(F.sum("n").alias("n"), F.sum("lost").alias("lost")).where("lost < n").select("version")
    lost_years = years.where("lost = n").join(versions, "version", "left_semi").select("version", "year")
    lost_keys = keys.where("dead").join(versions, "version", "left_semi").join(lost_years, ["version", "year"], "left_anti")
    none = lambda kind: F.lit(None).cast(kind)
    return (
        added
        .unionByName(versions.select(F.lit("live").alias("kind"), "version", none("string").alias("symbol"), none("int").alias("year")))
        .unionByName(lost_years.select(F.lit("year").alias("kind"), "version", none("string").alias("symbol"), "year"))
        .unionByName(lost_keys.select(F.lit("key").alias("kind"), "version", "symbol", "year"))
    )


def _versions_of(base: Snapshot, symbols: DataFrame) -> set:
    """The versions that hold rows of ``symbols``, with a digest of their keys: equal sets mean that nothing of them was replaced."""
    held = base.keys().join(symbols, "symbol", "left_semi").groupBy("version").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("symbol", "year").cast("decimal(38,0)")).alias("d"))
    return {tuple(r) for r in held.collect()}


def _too_large(state: DataFrame) -> bool:
    sizes = {r["kind"]: r["count"] for r in state.groupBy("kind").count().collect()}
    return sizes.get("live", 0) > MAX_VERSIONS or sizes.get("key", 0) > MAX_REPLACED


def commit(
    spark: SparkSession, root: str, rows: DataFrame | None, write: Callable[[DataFrame, str], None], *,
    check: Callable[[DataFrame], None] | None = None, confirm: Callable[[DataFrame, DataFrame], None] | None = None,
    side: dict[str, DataFrame] | None = None, token: str | None = None, last_order: str | None = None, attempts: int = 5,
) -> tuple[int, str | None] | None:
    """Makes ``rows`` the whole history of their symbols; returns the new snapshot's number and the version that holds them, None if ``token`` is
    applied already.

    The rows are written as a version of their own (by ``write``) and read back for ``check``. ``confirm`` gets them and the rows of their
    symbols as readers will see them; it runs before the swap, so nobody reads rows that were not confirmed. Anything that fails leaves the
    snapshot in force as it was, and what was written is deleted. ``side`` tables come into force with the snapshot, also where ``rows`` is None.
    A number that another publish has taken meanwhile is no failure unless that publish replaced the same symbols.
    """
    if token is not None and applied(spark, root, token):
        return None
    number = latest(spark, root)
    version = f"{number + 1:08d}-{uuid.uuid4().hex[:12]}"
    pending, written = f"{root}/pending/{version}", [f"{root}/{name}/version={version}" for name in side or {}]

    def store(table: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """The rows as version ``name``, read back, and their symbols."""
        data, keys = f"{root}/data/version={name}", f"{root}/keys/version={name}"
        written.extend([data, keys])
        write(table, data)
        back = spark.read.schema(BAR).parquet(data)
        key_rows(back).write.parquet(keys)
        return back, spark.read.schema("symbol string").parquet(keys).distinct()

    try:
        base = Snapshot.at(spark, root, number)
        live, symbols, staged = None, spark.createDataFrame([], "symbol string"), None
        if rows is not None:
            staged, symbols = store(rows, version)
            live = version
            if check is not None:
                check(staged.select(*STANDARD_COLUMNS))
        for name, table in (side or {}).items():
            table.write.parquet(f"{root}/{name}/version={version}")
        sizes = spark.range(1).select(F.lit(0).alias("row_count"))
        if live:
            sizes = spark.read.schema("row_count long").parquet(f"{root}/keys/version={version}")
        note = sizes.agg(F.sum("row_count").cast("long").alias("delivered_rows")).select(
            F.lit(token).cast("string").alias("token"), F.lit(version).alias("version"), F.lit(last_order).cast("string").alias("last_order"),
            "delivered_rows")
        note.write.parquet(f"{pending}/ledger")
        held = _versions_of(base, symbols) if live and base.live else set()
        for _ in range(attempts):
            _next_state(base, symbols, live).write.mode("overwrite").parquet(f"{pending}/state")
            if live and _too_large(spark.read.schema(STATE).parquet(f"{pending}/state")):
                others = base.rows().join(symbols, "symbol", "left_anti").select(*STANDARD_COLUMNS)
                live = f"{version}{WHOLE}"
                staged, symbols = store(staged.select(*STANDARD_COLUMNS).unionByName(others), live)
                held = _versions_of(base, symbols)
                _next_state(base, symbols, live).write.mode("overwrite").parquet(f"{pending}/state")
            if confirm is not None and live:
                seen = Snapshot(spark, root, pending).rows().join(symbols, "symbol", "left_semi")
                confirm(staged.select(*STANDARD_COLUMNS), seen.select(*STANDARD_COLUMNS))
            if take_name(spark, pending, f"{root}/snapshots/number={number + 1}"):
                return number + 1, live
            number = latest(spark, root)
            base = Snapshot.at(spark, root, number)
            again = token is not None and applied(spark, root, token)
            if again or (live and _versions_of(base, symbols) != held):
                raise PublishConflict(f"snapshot {number} holds {'this delivery' if again else 'some of the same symbols'}")
        raise PublishConflict(f"no number was free in {attempts} attempts")
    except Exception:
        for path in (pending, *written):
            remove(spark, path)
        raise


def damaged_keys(spark: SparkSession, root: str) -> DataFrame:
    """(version, symbol, year, problem) of live keys whose stored rows are missing, too few, too many or changed."""
    snapshot = Snapshot.at(spark, root, latest(spark, root))
    want = snapshot.keys().select(*KEY, "row_count", "checksum")
    rows = snapshot.rows()
    sums = rows.groupBy(*KEY).agg(F.count("*").alias("n"), checksum())
    have = sums.select(*KEY, "n", F.xxhash64(F.col("sum_").cast("string")).alias("sum"))
    problem = (
        F.when(F.col("n").isNull(), "missing").when(F.col("row_count").isNull(), "unexpected")
        .when(F.col("n") < F.col("row_count"), "truncated").when(F.col("n") > F.col("row_count"), "repeated").otherwise("changed"))
    return want.join(have, KEY, "full").where("not (row_count <=> n and checksum <=> sum)").select(*KEY, problem.alias("problem"))


def vacuum(spark: SparkSession, root: str, keep: int = 2, leftover_hours: float = 24.0) -> list[str]:
    """Deletes what no snapshot but the last ``keep`` needs, and leftovers of publishes that failed or died more than
    ``leftover_hours`` ago; returns the versions deleted. Readers of earlier snapshots must have ended. The ledger stays whole."""
    if keep < 1:
        raise ValueError("the snapshot in force stays")
    known = numbers(spark, root)
    needed: set[str] = set()
    for number in known[-keep:]:
        needed |= set(Snapshot.at(spark, root, number).live)
    past: set[str] = set()
    for number in known[:-keep]:
        if names(spark, f"{root}/snapshots/number={number}/state"):
            past |= set(Snapshot.at(spark, root, number).live)
            remove(spark, f"{root}/snapshots/number={number}/state")
    now = spark._jvm.System.currentTimeMillis()
    gone = []
    for name, changed in names(spark, f"{root}/data").items():
        version = name.partition("=")[2]
        # a version of no snapshot belongs to a publish that failed, or that is under way
        if version not in needed and (version in past or now - changed > leftover_hours * 3_600_000):
            for table in ("data", "keys"):
                remove(spark, f"{root}/{table}/version={version}")
            gone.append(version)
    for name, changed in names(spark, f"{root}/pending").items():
        if now - changed > leftover_hours * 3_600_000:
            remove(spark, f"{root}/pending/{name}")
    if known:
        for name in names(spark, root):
            if name.startswith("symbol="):
                remove(spark, f"{root}/{name}")
    return sorted(gone)

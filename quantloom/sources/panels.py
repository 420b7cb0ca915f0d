"""Stored factor panels, keyed by factor name, version and date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PANEL, STORED_PANEL
from ..session import durable
from .bars import has_files

FOLDERS = ["factor_name", "factor_version", "year"]
KEY = [*FOLDERS, "as_of_date"]
NAMED = ["factor_name", "factor_version", "as_of_date"]
#: One row per key and file: where its rows are, how many, and their checksum. Kept beside the panels, in a folder that scans of them pass over.
_BESIDE = "_keys"
RECORDS = "as_of_date date, folder string, file string, file_bytes long, row_count long, checksum long, factor_name string, factor_version string, year int"


def write_panels(panel: DataFrame, root: str) -> None:
    """Replaces exactly the dates being written; every other stored date stays.

    A folder holds a year of one factor version, its rows in order of date, so that row-group statistics prune single
    dates. The years touched are read, the dates being written taken out of them, and the whole years replaced.
    """
    spark = panel.sparkSession
    fresh = durable(
        panel.select("symbol", "raw_value", "is_eligible", "factor_name", "factor_version",
                     F.year("as_of_date").alias("year"), "as_of_date"), "panel")
    rows = fresh
    if has_files(spark, root):
        held = stored_panels(spark, root).join(fresh.select(*FOLDERS).distinct(), FOLDERS, "left_semi")
        held = held.join(fresh.select(*KEY).distinct(), KEY, "left_anti")
        # what is overwritten below must not be read while it is
        rows = durable(held.unionByName(fresh), "years")
    (
        rows.hint("rebalance", *[F.col(c) for c in FOLDERS])
        .sortWithinPartitions(*KEY, "symbol")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*FOLDERS).parquet(root)
    )
    _record(spark, root, fresh)


def _record(spark: SparkSession, root: str, written: DataFrame) -> None:
    """The records of the years that were written, read off the files as they are. Until they are stored the old records name files that
    are gone, so a write that was cut off is refused by readers, never half read."""
    rows = stored_panels(spark, root, files=True).join(written.select(*FOLDERS).distinct(), FOLDERS, "left_semi")
    total = F.sum(F.xxhash64("symbol", "raw_value", "is_eligible").cast("decimal(38,0)")).cast("string")
    kept = rows.groupBy(*KEY, "file", "file_bytes").agg(F.count("*").alias("row_count"), F.xxhash64(total).alias("checksum"))
    kept = kept.withColumn("folder", F.concat(*[x for c in FOLDERS for x in (F.lit(f"/{c}="), F.col(c).cast("string"))]))
    kept.select(*[c.split()[0] for c in RECORDS.split(", ")]).repartition(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*FOLDERS).parquet(f"{root}/{_BESIDE}")


def panel_records(spark: SparkSession, root: str) -> DataFrame:
    place = f"{root}/{_BESIDE}"
    return spark.read.schema(RECORDS).parquet(place) if has_files(spark, place) else spark.createDataFrame([], RECORDS)


def _files(spark: SparkSession, root: str) -> DataFrame:
    """(file, found_in, found_bytes) of all panel files, as the folder lists them: none is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*.parquet").load(root)
    listed = listed.select("path", "length").where(~F.contains("path", F.lit(f"/{_BESIDE}/")))
    return listed.select(
        F.substring_index("path", "/", -1).alias("file"), F.regexp_extract("path", r"(/factor_name=[^/]*/factor_version=[^/]*/year=[^/]*)/[^/]*$", 1).alias("found_in"),
        F.col("length").alias("found_bytes"))


def panel_problems(spark: SparkSession, root: str) -> DataFrame:
    """(factor_name, factor_version, as_of_date, year, problem) of stored panels that are not as they were written.

    ``missing``: a file of theirs is gone; ``misfiled``: it lies in another folder; ``changed``: its length is not what it was;
    ``unrecorded``: a file that no write has recorded, with the version and year of its folder and no date. Records are joined with the list of files, so no panel is read.
    """
    records = panel_records(spark, root)
    if not has_files(spark, root):
        return records.select(*NAMED, "year", F.lit("").alias("problem"))
    files = _files(spark, root)
    both = records.join(files, (records["file"] == files["file"]) & (records["folder"] == files["found_in"]), "full").select(
        records["*"], files["file"].alias("found"), "found_in", "found_bytes")
    # tasks name their files alike in all folders, so a moved file is looked for among those that no record places where they are,
    # by name and length
    strange = both.where("file is null").select("found", "found_in", "found_bytes")
    gone = both.where("found is null").drop("found", "found_in", "found_bytes").join(
        strange, (F.col("file") == F.col("found")) & (F.col("file_bytes") == F.col("found_bytes")), "left")
    moved = gone.where("found is not null").select("found", "found_in").distinct()
    problem = F.when(F.col("found").isNull(), "missing").otherwise("misfiled")
    lost = gone.select(*NAMED, "year", problem.alias("problem"))
    changed = both.where("file_bytes <> found_bytes").select(*NAMED, "year", F.lit("changed").alias("problem"))
    part = lambda n: F.regexp_extract("found_in", f"/{n}=([^/]*)", 1)
    others = strange.join(moved, ["found", "found_in"], "left_anti").select(
        part("factor_name").alias("factor_name"), part("factor_version").alias("factor_version"), F.lit(None).cast("date").alias("as_of_date"),
        part("year").try_cast("int").alias("year"), F.lit("unrecorded").alias("problem"))
    return lost.unionByName(changed).unionByName(others).distinct()


def stored_panels(spark: SparkSession, root: str, files: bool = False) -> DataFrame:
    """All stored rows; with ``files``, also the name and length of the file each is in."""
    if not has_files(spark, root):
        return spark.createDataFrame([], STORED_PANEL)
    rows = spark.read.schema(STORED_PANEL).parquet(root)
    return rows.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("file_bytes")) if files else rows


def read_panels(
    spark: SparkSession, root: str, name: str, version: str,
    start: date | None = None, end: date | None = None,
) -> DataFrame:
    """Panels of one factor version in a closed range; only their years' folders are listed.

    Dates without a panel are simply absent, never filled.
    """
    rows = stored_panels(spark, root).where(
        (F.col("factor_name") == name) & (F.col("factor_version") == version)
    )
    if start is not None:
        rows = rows.where((F.col("as_of_date") >= F.lit(start)) & (F.col("year") >= start.year))
    if end is not None:
        rows = rows.where((F.col("as_of_date") <= F.lit(end)) & (F.col("year") <= end.year))
    return rows.select(*PANEL.fieldNames())


def misfiled(spark: SparkSession, root: str) -> DataFrame:
    """Stored keys whose year folder is not the year of their date."""
    return (
        stored_panels(spark, root).where(F.year("as_of_date") != F.col("year")).select(*KEY).distinct()
    )


def _refuse(problems: DataFrame, what: str) -> None:
    some = problems.limit(5).collect()
    if some:
        raise ValueError(f"{what}: {[{k: str(v) for k, v in r.asDict().items()} for r in some]}")


def read_whole_panels(
    spark: SparkSession, root: str, name: str, version: str, start: date | None = None, end: date | None = None, wanted: DataFrame | None = None,
) -> DataFrame:
    """:func:`read_panels` that refuses what it cannot vouch for: panels of the version in the range that are missing, misfiled, changed or
    unrecorded, and ``wanted`` dates (as_of_date) that are not stored. Both are told from the records; a store whose panels were written
    without records is scanned for panels filed under a year that is not their date's."""
    own = (F.col("factor_name") == name) & (F.col("factor_version") == version)
    day = F.col("as_of_date")
    reach = day.isNull() | (F.lit(True) if start is None else day >= F.lit(start)) & (F.lit(True) if end is None else day <= F.lit(end))
    if has_files(spark, f"{root}/{_BESIDE}"):
        # a misfiled panel belongs to the range of its date, whatever folder it lies in
        _refuse(panel_problems(spark, root).where(own & reach), "misfiled, missing or changed panels")
    else:
        _refuse(misfiled(spark, root).where(own), "misfiled panels")
    rows = read_panels(spark, root, name, version, start, end)
    if wanted is not None:
        held = stored_keys(spark, root).where(own)
        lost = wanted.select("as_of_date").distinct().join(held, "as_of_date", "left_anti")
        _refuse(lost.select("as_of_date"), "panels are not stored")
    return rows


def stored_keys(spark: SparkSession, root: str) -> DataFrame:
    """The keys of all stored panels, from their records; a store without records is scanned."""
    held = panel_records(spark, root) if has_files(spark, f"{root}/{_BESIDE}") else stored_panels(spark, root)
    return held.select(*NAMED).distinct()


def missing_keys(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """Wanted ``(factor_name, factor_version, as_of_date)`` keys that are not stored."""
    return wanted.join(stored_keys(spark, root), NAMED, "left_anti")


def cache_plan(schedule: DataFrame, stored: DataFrame, force: bool = False) -> DataFrame:
    """Per scheduled date: ``hit``, ``miss`` or ``forced``; only hits are not computed again."""
    held = stored.select("as_of_date").distinct().withColumn("held", F.lit(True))
    outcome = F.lit("forced") if force else F.when(F.col("held"), "hit").otherwise("miss")
    return schedule.join(held, "as_of_date", "left").select("as_of_date", outcome.alias("outcome"))

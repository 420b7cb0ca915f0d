"""Raw bar files arriving over time, folded into the published table; what a symbol cannot take yet waits in quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import valid_symbol
from ..operators.bars import parse_raw
from ..operators.contracts import bar_violations
from ..operators.merge import merge_bars
from ..schemas import PRICE_COLUMNS
from ..session import durable
from ..sources import versions
from ..sources.bars import publish_bars, rows_of_symbols

#: Where a row stands among all deliveries: the file's time and name, then the row's place in it.
ORDER = {"modified_": "_metadata.file_modification_time", "file_": "_metadata.file_path", "row_": "_metadata.row_index"}
_VALUES = [*PRICE_COLUMNS, "volume"]
_ROW = "symbol string, date date, open double, high double, low double, close double, adjusted_close double, volume long, raw string, row_order string"
#: Rows that wait: as they came (``raw``), what was read of them, and what is wrong with them; none of it if they wait for their symbol.
QUARANTINE = f"{_ROW}, reasons array<string>, token string"
RELEASED, DELIVERED = "row_order string, outcome string", "symbol string, date date, row_order string"


def _order():
    """One text per row that sorts like (file time, file name, place in the file)."""
    time, place = F.unix_micros("modified_").cast("string"), F.col("row_").cast("string")
    return F.concat_ws("|", F.lpad(time, 20, "0"), F.col("file_"), F.lpad(place, 20, "0"))


def incoming_rows(batch: DataFrame) -> DataFrame:
    """A batch with its order as (symbol, date, values, raw, row_order, reasons)."""
    own = [c for c in batch.columns if c not in ORDER]
    raw = batch.withColumn("raw", F.to_json(F.struct(*(F.col(f"`{c}`") for c in own)), {"ignoreNullFields": "false"})).withColumn("row_order", _order())
    parsed = parse_raw(raw)
    wrong = F.array_compact(F.array(
        F.when(F.col("date").isNull(), "unparseable_date"), F.when(~F.coalesce(valid_symbol("symbol"), F.lit(False)), "malformed_symbol")))
    return parsed.select("symbol", "date", *_VALUES, "raw", "row_order", wrong.alias("reasons"))


def quarantined(spark: SparkSession, root: str) -> DataFrame:
    """Every row that was ever held, with its outcome so far: held, readmitted or corrected."""
    rows = versions.side_table(spark, root, "quarantine", QUARANTINE).drop("version")
    done = versions.side_table(spark, root, "released", RELEASED).select("row_order", "outcome")
    return rows.join(done, "row_order", "left").withColumn("outcome", F.coalesce("outcome", F.lit("held")))


def incremental_rejects(spark: SparkSession, root: str) -> DataFrame:
    """The rows that are held now, whole and with their reasons."""
    return quarantined(spark, root).where("outcome = 'held'").drop("outcome")


def _newest(rows: DataFrame) -> DataFrame:
    """The last delivered row of each day."""
    return rows.groupBy("symbol", "date").agg(*[F.max_by(c, "row_order").alias(c) for c in _VALUES], F.max("row_order").alias("row_order"))


def _in_order(rows: DataFrame, root: str, first: str) -> DataFrame:
    """Without rows for days that the table has from a later delivery. Only versions with deliveries later than ``first`` are looked into."""
    spark = rows.sparkSession
    later = versions.ledger(spark, root).where(F.col("last_order") > first).select("version")
    if later.isEmpty():
        return rows
    held = versions.side_table(spark, root, "delivered", DELIVERED).join(later, "version", "left_semi")
    last = held.groupBy("symbol", "date").agg(F.max("row_order").alias("last_"))
    return rows.join(last, ["symbol", "date"], "left").where("last_ is null or row_order > last_").drop("last_")


def fold_batch(batch: DataFrame, root: str, token: str) -> bool:
    """One micro-batch, all of it or nothing; False if the table has it already.

    A symbol takes its rows only if all of them can be read and the history they make keeps the contract; else all its rows of the batch are
    held in quarantine, the wrong ones with their reasons, and its published rows stay. Other symbols are not affected. When a later
    batch brings rows that the symbol can take, the sound rows held for it are taken too, in the order of their delivery; a wrong row is
    done with once its day arrives anew. Of several rows for one day the last delivered stays, whatever batch it came in.

    The published rows, the quarantine and the ledger entry of ``token`` come into force together, so a batch that is
    replayed after a failure is skipped or done afresh.
    """
    spark = batch.sparkSession
    if versions.applied(spark, root, token):
        return False
    rows = durable(incoming_rows(batch), "incoming")
    span = rows.agg(F.min("row_order").alias("first"), F.max("row_order").alias("last")).head()
    if span["first"] is None:
        return False
    symbols = rows.select("symbol").distinct()
    unread = rows.where(F.size("reasons") > 0).select(F.col("symbol").alias("bad_")).distinct()
    readable = rows.join(unread, F.col("symbol").eqNullSafe(F.col("bad_")), "left_anti")
    waiting = durable(incremental_rejects(spark, root).join(symbols, "symbol", "left_semi"), "waiting")
    sound = waiting.where(F.size("reasons") == 0)
    names = ["symbol", "date", *_VALUES, "row_order"]
    both = readable.select(*names).unionByName(sound.join(readable.select("symbol").distinct(), "symbol", "left_semi").select(*names))
    earliest = waiting.agg(F.min("row_order")).head()[0]
    fresh = durable(_newest(_in_order(both, root, min(span["first"], earliest or span["first"]))), "fresh")
    touched = rows_of_symbols(spark, root, fresh)
    merged = durable(merge_bars(touched, fresh.withColumn("arrival", F.lit(0).cast("bigint"))), "merged")
    broken = durable(_keyed(bar_violations(merged)), "broken")
    refused = unread.unionByName(broken.select(F.col("symbol").alias("bad_"))).distinct()

    wrong = broken.where(~F.col("rule").isin(NEIGHBOUR_RULES)).groupBy("symbol", "date").agg(F.array_sort(F.collect_set("rule")).alias("rules"))
    winners = fresh.join(wrong, ["symbol", "date"]).select("row_order", "rules")
    held = rows.join(refused, F.col("symbol").eqNullSafe(F.col("bad_")), "left_semi").join(winners, "row_order", "left").select(
        *[c for c in rows.columns if c != "reasons"],
        F.array_union("reasons", F.coalesce("rules", F.array().cast("array<string>"))).alias("reasons"), F.lit(token).alias("token"))
    good = durable(merged.join(refused, F.col("symbol") == F.col("bad_"), "left_anti"), "good")
    taken = fresh.join(good.select("symbol").distinct(), "symbol", "left_semi")
    arrived = taken.select("symbol", "date", F.lit(True).alias("arrived_"))
    released = waiting.join(taken.select("symbol").distinct(), "symbol", "left_semi").join(arrived, ["symbol", "date"], "left").select(
        "row_order", F.when(F.size("reasons") == 0, "readmitted").when(F.col("arrived_"), "corrected").alias("outcome")).where("outcome is not null")
    side = {"quarantine": held, "released": released, "delivered": taken.select("symbol", "date", "row_order")}
    publish_bars(None if good.isEmpty() else good, root, token=token, side=side, last_order=span["last"])
    return True


#: Rules that another day's price can break: they hold a symbol back but are no fault of the row they name.
NEIGHBOUR_RULES = ["first_return_not_null", "later_return_null"]


def _keyed(violations: DataFrame) -> DataFrame:
    """(symbol, date, rule) of violations whose key names a bar."""
    day = F.try_to_date(F.substring_index("key", "|", -1))
    return violations.where(F.col("key").contains("|")).select(F.substring_index("key", "|", 1).alias("symbol"), day.alias("date"), "rule")


def incremental_bars(
    spark: SparkSession, source: str, schema, root: str, checkpoint: str, files_per_batch: int = 1000, name: str | None = None,
) -> StreamingQuery:
    """Drains the files available now; run it again, or on a schedule, for the next ones.

    ``name`` (the source if None) with the batch's number is the delivery's token in the table's ledger. Rows that cannot be taken yet are read by
    :func:`incremental_rejects`.
    """
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    raw = raw.select("*", *[F.col(path).alias(column) for column, path in ORDER.items()])
    name = name or source
    return (
        raw.writeStream.foreachBatch(lambda batch, number: fold_batch(batch, root, f"{name}#{number}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

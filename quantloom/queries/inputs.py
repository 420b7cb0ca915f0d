"""The engine's tables, derived by Spark from the given ones.

Order lines are trades: a brand is a symbol and a week is a session, so every table below
grows with the tables it is read from.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import weekday_index
from ..operators import bars as bar_ops
from ..operators import evaluation, execution, labels, panel, schedule, selection, transition, weights
from ..operators.calendar import session_calendar
from ..operators.ranking import checked_bound
from ..schemas import MOMENTUM_LOOKBACK, MOMENTUM_SKIP
from ..plans.research import momentum_pairs
from ..session import durable
from ..sources import universe
from ..sources.bars import trades_from_lineitem

HORIZON, TOP_N, CASH, CAP = 21, 5, 0.05, 0.25
CAPITAL = 1_000_000.0
PLAN_START, PLAN_END = date(1995, 3, 1), date(2001, 10, 15)
STUDY_START, STUDY_END = date(1995, 3, 1), date(2001, 6, 30)


class Market:
    def __init__(
        self, spark: SparkSession, sf_dir: str, grain: str = "week",
        lookback: int = MOMENTUM_LOOKBACK, skip: int = MOMENTUM_SKIP, horizon: int = HORIZON,
    ):
        self.spark, self.sf_dir, self.grain = spark, sf_dir, grain
        self.lookback, self.skip, self.horizon = lookback, skip, horizon

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- bars and sessions -------------------------------------------------
    @cached_property
    def bars(self) -> DataFrame:
        trades = trades_from_lineitem(self.table("lineitem"), self.table("part"), self.grain)
        return bar_ops.bars_from_trades(trades)

    @cached_property
    def stored_bars(self) -> DataFrame:
        """Bars as a written table, for plans that read them more than once."""
        return durable(self.bars, "bars")

    @cached_property
    def standard(self) -> DataFrame:
        return bar_ops.derive_features(self.bars)

    @cached_property
    def calendar(self) -> DataFrame:
        """Sessions as a stored table: plans use it many times, the order lines are read once for it."""
        days = self.table("lineitem").select(
            F.trunc(F.to_date("l_shipdate"), self.grain).alias("date")
        )
        return durable(session_calendar(days), "calendar")

    @cached_property
    def business_days(self) -> DataFrame:
        """Weekdays on which anything is traded, without two holidays in 23 days: a daily calendar from all order lines."""
        days = self.table("lineitem").select(F.to_date("l_shipdate").alias("date"))
        holiday = F.pmod(F.datediff("date", F.lit("1990-01-01")), F.lit(23)).isin(5, 11)
        return durable(session_calendar(days.where((weekday_index("date") < 5) & ~holiday)), "calendar")

    @cached_property
    def bars_by_sid(self) -> DataFrame:
        standard = bar_ops.derive_features(self.stored_bars)
        return standard.join(self.calendar, F.col("date") == F.col("session")).drop("session")

    @property
    def last_sid(self):
        return self.calendar.agg(F.max("sid")).scalar()

    # -- universe ----------------------------------------------------------
    @cached_property
    def master(self) -> DataFrame:
        """A clean security master: one row per brand."""
        symbols = self.table("part").select(
            F.upper(F.replace("p_brand", F.lit("#"), F.lit("."))).alias("symbol")
        ).distinct()
        return symbols.select(
            "symbol", F.concat(F.lit("Brand "), "symbol").alias("name"),
            F.lit("NYSE").alias("exchange"), F.lit("common_stock").alias("security_type"),
            F.lit("true").alias("is_active"),
        )

    @cached_property
    def messy_master(self) -> DataFrame:
        """Suppliers and customers as an unkempt security master."""
        supplier = self.table("supplier").select(
            F.concat(F.lit(" s"), F.col("s_suppkey").cast("string"), F.lit(" ")).alias("symbol"),
            F.col("s_name").alias("name"),
            F.when(F.col("s_nationkey") < 12, "nyse").when(F.col("s_nationkey") < 20, " Nasdaq ")
            .otherwise("lse").alias("exchange"),
            F.when(F.col("s_nationkey") == 3, "etf").otherwise("Common_Stock").alias("security_type"),
            F.when(F.col("s_acctbal") > 0, "Yes").when(F.col("s_acctbal") > -500, "n")
            .otherwise("maybe").alias("is_active"),
            F.col("s_suppkey").alias("line"),
        )
        customer = self.table("customer").select(
            F.when(F.col("c_nationkey") == 5, F.concat(F.lit("s"), F.col("c_custkey").cast("string")))
            .when(F.col("c_nationkey") == 6, F.lit("   "))
            .when(F.col("c_nationkey") == 7, F.concat(F.lit("c_"), F.col("c_custkey").cast("string")))
            .when(F.col("c_nationkey") == 8, F.col("c_name"))
            .otherwise(F.concat(F.lit("c"), F.col("c_custkey").cast("string"))).alias("symbol"),
            F.when(F.col("c_nationkey") == 9, F.lit(None)).otherwise(F.col("c_name")).alias("name"),
            F.when(F.col("c_mktsegment") == "BUILDING", "nyse arca").when(F.col("c_mktsegment") == "MACHINERY", "")
            .otherwise("bats").alias("exchange"),
            F.lit("common_stock").alias("security_type"),
            F.when(F.col("c_acctbal") > 0, "TRUE").otherwise("0").alias("is_active"),
            (F.col("c_custkey") + 10_000_000_000).alias("line"),
        )
        return supplier.unionByName(customer)

    @cached_property
    def normalized(self) -> DataFrame:
        return universe.normalize_universe(self.messy_master)

    @cached_property
    def pool(self) -> DataFrame:
        return durable(universe.active_pool(universe.normalize_universe(self.master)), "pool")

    @cached_property
    def bound(self) -> int | None:
        return checked_bound(self.pool)

    # -- factor, labels ----------------------------------------------------
    @cached_property
    def dates(self) -> DataFrame:
        return self.calendar.select(F.col("session").alias("as_of_date"))

    @cached_property
    def grid(self) -> DataFrame:
        return panel.dense_grid(self.pool, self.dates)

    @cached_property
    def panel(self) -> DataFrame:
        factor = panel.momentum(self.lookback, self.skip)
        return factor(self.stored_bars, self.dates, self.pool, self.calendar)

    @cached_property
    def labels(self) -> DataFrame:
        return labels.forward_returns(self.panel, self.stored_bars, self.calendar, self.horizon)

    @cached_property
    def labelled_panel(self) -> DataFrame:
        ends = labels.label_sessions(self.calendar, self.horizon).select("as_of_date")
        return self.panel.join(ends, "as_of_date", "left_semi")

    @cached_property
    def pairs(self) -> DataFrame:
        return momentum_pairs(self.bars, self.pool, self.calendar, self.lookback, self.skip, self.horizon)

    @cached_property
    def ics(self) -> DataFrame:
        return evaluation.daily_ic(self.pairs, bound=self.bound)

    @cached_property
    def quantiles(self) -> DataFrame:
        return evaluation.quantile_returns(self.pairs, bound=self.bound)

    # -- strategy, portfolio, execution -------------------------------------
    @cached_property
    def stored_panel(self) -> DataFrame:
        """The panel as a written table: strategies read stored panels."""
        return durable(self.panel, "panel")

    @cached_property
    def result(self) -> DataFrame:
        return selection.top_n_by_factor(self.stored_panel, TOP_N, self.bound)

    @cached_property
    def selected(self) -> DataFrame:
        return selection.selected_scores(self.result)

    @cached_property
    def positions(self) -> DataFrame:
        return durable(weights.capped_score_weights(self.selected, CASH, CAP), "positions")

    @cached_property
    def cash(self) -> DataFrame:
        """Cash of every date with a valid target: refused dates have no portfolio."""
        refused = weights.weight_refusals(self.selected, CASH, CAP).select("as_of_date").distinct()
        return durable(
            weights.target_cash(self.result, CASH).join(refused, "as_of_date", "left_anti"), "cash"
        )

    @cached_property
    def state(self) -> tuple[DataFrame, DataFrame]:
        return transition.previous_target(self.positions, self.cash)

    @cached_property
    def transition(self) -> DataFrame:
        return transition.portfolio_transition(self.state[0], self.positions)

    @cached_property
    def events(self) -> DataFrame:
        decisions = self.cash.select(F.col("as_of_date").alias("decision_date"))
        return schedule.with_execution(decisions, self.calendar, date(9999, 12, 31)).where(
            "execution_date is not null"
        )

    @cached_property
    def orders(self) -> DataFrame:
        """One order per moved name, sized off the close of the decision date."""
        closes = self.stored_bars.select(F.col("date").alias("decision_date"), "symbol", "close")
        moved = self.transition.where("abs(weight_change) > 1e-12").withColumnRenamed("as_of_date", "decision_date")
        return (
            moved.join(self.events, "decision_date")
            .join(closes, ["decision_date", "symbol"])
            .select(
                F.concat_ws("-", F.col("decision_date").cast("string"), "symbol").alias("order_id"),
                "decision_date",
                F.col("execution_date").alias("scheduled_fill_date"),
                "symbol",
                F.when(F.col("weight_change") > 0, "BUY").otherwise("SELL").alias("side"),
                (F.abs("weight_change") * CAPITAL / F.col("close")).alias("quantity"),
            )
        )

    @cached_property
    def opens(self) -> DataFrame:
        return self.stored_bars.select("date", "symbol", "open")

    @cached_property
    def fills(self) -> DataFrame:
        return execution.fill_orders(self.orders, self.opens, commission=1.0)

    # -- incremental loads -------------------------------------------------
    @cached_property
    def published(self) -> DataFrame:
        return self.bars_by_sid.where(F.col("sid") <= self.last_sid - 10).drop("sid")

    @cached_property
    def downloaded(self) -> DataFrame:
        """The last sessions again with revised closes, the newest ones delivered twice."""
        fresh = self.bars_by_sid.where(F.col("sid") > self.last_sid - 15)
        again = fresh.where(F.col("sid") > self.last_sid - 3)

        def revised(rows, factor, arrival):
            return rows.select(
                "symbol", "date", "open", "high", "low",
                (F.col("close") * factor).alias("close"),
                (F.col("adjusted_close") * factor).alias("adjusted_close"),
                "volume", F.lit(arrival).cast("bigint").alias("arrival"),
            )

        return revised(fresh, 1.01, 0).unionByName(revised(again, 1.02, 1))

    @cached_property
    def held_dates(self) -> DataFrame:
        """Published days: late starts, early ends, gaps at other weeks for every symbol, some symbols never loaded."""
        rows = self.stored_bars.select("symbol", "date").join(self.calendar, F.col("date") == F.col("session"))
        rows = rows.join(self.pool, "symbol")
        keep = (
            (F.col("ord") <= 22) & (F.pmod(7 * F.col("sid") + 3 * F.col("ord"), F.lit(11)) != 4)
            & (F.col("sid") >= 5 + 2 * F.col("ord")) & (F.col("sid") <= self.last_sid - F.col("ord"))
        )
        return durable(rows.where(keep).select("symbol", "date"), "held")

    @cached_property
    def raw(self) -> DataFrame:
        """Vendor rows as text, with unreadable cells, days and symbols among them."""
        sid, text = F.col("sid"), lambda c: F.col(c).cast("string")
        rows = self.bars_by_sid
        return rows.select(
            F.when(F.pmod(sid, F.lit(97)) == 3, F.lit("soon")).otherwise(text("date")).alias("Date"),
            F.when(F.pmod(sid, F.lit(89)) == 4, F.concat(F.lit("??"), "symbol"))
            .otherwise(F.concat(F.lit(" "), F.lower("symbol"))).alias("symbol"),
            F.when(F.pmod(sid, F.lit(41)) == 5, F.lit("n/a")).otherwise(F.col("volume").cast("string")).alias("Volume"),
            F.when(F.pmod(sid, F.lit(43)) == 6, F.lit("-")).otherwise(F.col("volume").cast("string")).alias("Open"),
            F.col("volume").cast("string").alias("High"),
            F.col("volume").cast("string").alias("Low"),
            (F.col("volume") + 1).cast("string").alias("Close"),
            (F.col("volume") + 2).cast("string").alias("Adj Close"),
        )

    @cached_property
    def damaged(self) -> DataFrame:
        """Standard bars with one kind of defect every few dozen sessions."""
        sid = F.col("sid")

        def every(n, k):
            return F.pmod(sid, F.lit(n)) == k

        rows = self.bars_by_sid
        broken = rows.select(
            "date",
            F.when(every(100, 23), F.lower("symbol")).otherwise(F.col("symbol")).alias("symbol"),
            "open",
            F.when(every(50, 7), F.col("low") * 0.5).otherwise(F.col("high")).alias("high"),
            "low", "close",
            F.when(every(70, 13), F.lit(0.0)).otherwise(F.col("adjusted_close")).alias("adjusted_close"),
            F.when(every(60, 11), F.lit(-1)).otherwise(F.col("volume")).cast("bigint").alias("volume"),
            F.when(every(80, 17), F.lit(None)).otherwise(F.col("daily_return")).alias("daily_return"),
            "dollar_volume", "sid",
        )
        return broken.unionByName(broken.where(every(90, 19))).drop("sid")


__all__ = ["CAP", "CAPITAL", "CASH", "HORIZON", "Market", "PLAN_END", "PLAN_START",
           "STUDY_END", "STUDY_START", "TOP_N"]

import random

import pandas as pd
import pytest

from quantloom.operators import ranking

from .conftest import rows


@pytest.fixture(scope="module")
def ties(spark):
    rng = random.Random(7)
    # one group holds most rows, and one value holds a third of that group
    data = [("hot" if i % 10 else "cold", f"S{i:04d}", 1.0 if i % 3 == 0 else float(rng.randint(0, 40))) for i in range(900)]
    data += [("hot", "NONE", None)]
    return data, spark.createDataFrame(data, "day string, symbol string, value double").repartition(5)


@pytest.mark.parametrize("bound", [None, 1000])
def test_average_rank_matches_pandas(ties, bound):
    data, df = ties
    pdf = pd.DataFrame(data, columns=["day", "symbol", "value"])
    pdf["rank"] = pdf.groupby("day")["value"].rank(method="average")
    want = {(r.day, r.symbol): None if pd.isna(r.rank_) else r.rank_ for r in pdf.rename(columns={"rank": "rank_"}).itertuples()}
    got = {(a, b): c for a, b, c in rows(ranking.average_rank(df, ["day"], "value", "r", bound), "day", "symbol", "r")}
    assert got == want


@pytest.mark.parametrize("bound", [None, 1000])
def test_ordinal_rank_is_gapless(ties, bound):
    data, df = ties
    got = rows(ranking.ordinal_rank(df, ["day"], "value", "symbol", "r", bound), "day", "symbol", "r")
    for day in ("hot", "cold"):
        scored = sorted((r for r in data if r[0] == day and r[2] is not None), key=lambda r: (-r[2], r[1]))
        want = {r[1]: i + 1 for i, r in enumerate(scored)}
        assert {b: c for a, b, c in got if a == day and c is not None} == want
    assert ("hot", "NONE", None) in got


def test_bound_is_checked(spark):
    assert ranking.checked_bound(spark.range(10)) == 10
    assert ranking.checked_bound(spark.range(ranking.WINDOW_ROWS + 5)) is None

"""Interval joins by dyadic ranges of days: every length of interval, ends that never come, and what they cost."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tallyspark.functions import dates as DT
from tallyspark.operators import turnover as TO

D = dt.date


def days_apart(rng, first, last):
    span = (last - first).days
    a, b = sorted(first + dt.timedelta(days=rng.randrange(span + 1)) for _ in range(2))
    return a, b


def test_a_day_meets_an_interval_in_one_range_if_it_lies_inside(spark):
    rng = random.Random(1)
    spans = [days_apart(rng, D(1, 1, 1), D(9999, 12, 31)) for _ in range(40)] + [days_apart(rng, D(1969, 11, 1), D(1970, 3, 1)) for _ in range(40)]
    spans += [(D(2020, 2, 29), D(2020, 2, 29)), (D(1, 1, 1), D(9999, 12, 31)), (D(1, 1, 1), D(1, 1, 1)), (D(9999, 12, 31), D(9999, 12, 31))]
    near = [x + dt.timedelta(days=k) for a, b in spans for x, k in ((a, 0), (b, 0), (a, 1), (b, -1), (a, -1), (b, 1)) if D(1, 1, 2) < x < D(9999, 12, 30)]
    days = sorted({*near, D(1, 1, 1), D(9999, 12, 31), D(1970, 1, 1)})
    left = spark.createDataFrame([(d,) for d in days], "d DATE").select("d", F.inline(DT.dyadic_path(F.col("d"))))
    right = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spans)], "i INT, a DATE, b DATE").select("i", F.inline(DT.dyadic_cover(F.col("a"), F.col("b"))))
    got = sorted((r.d, r.i) for r in left.join(right, ["level", "bin"]).collect())
    assert got == sorted((d, i) for d in days for i, (a, b) in enumerate(spans) if a <= d <= b)


def test_cost_of_an_interval_is_bounded(spark):
    rows = [(1, D(1998, 9, 15), D(9999, 12, 31)), (2, D(1, 1, 1), D(9999, 12, 31)), (3, D(1, 1, 2), D(9999, 12, 30)), (4, D(2020, 1, 1), D(2020, 1, 1)),
            (5, D(2020, 1, 2), D(2020, 1, 1)), (6, None, D(2020, 1, 1)), (7, D(2020, 1, 1), None)]
    rates = spark.createDataFrame([(i, "1.5", a, b) for i, a, b in rows], "currency_rk INT, reduced_cource STRING, data_actual_date DATE, data_actual_end_date DATE")
    cost = dict(map(tuple, TO.rate_ranges(rates).groupBy("currency_rk").count().collect()))
    assert max(cost.values()) <= 44 and cost[4] == 1 and set(cost) == {1, 2, 3, 4}


def test_rates_overlap_never_end_and_null_dates_keep_their_rows(spark):
    rates = spark.createDataFrame([(1, "1", D(1998, 1, 1), D(9999, 12, 31)), (1, "2", D(1998, 5, 1), D(1998, 5, 31)), (2, "3", D(1990, 1, 1), D(1998, 4, 30))],
                                  "currency_rk INT, reduced_cource STRING, data_actual_date DATE, data_actual_end_date DATE")
    rows = [(1, D(1998, 5, 1)), (1, D(1998, 6, 1)), (1, D(1997, 12, 31)), (2, D(1998, 4, 30)), (2, D(1998, 5, 1)), (3, D(1998, 5, 1)), (None, D(1998, 5, 1)), (1, None)]
    got = TO.with_rates(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "currency_rk INT, oper_date DATE, n INT"), rates)
    assert sorted((r.n, r.reduced_cource or "") for r in got.collect()) == [
        (0, "1"), (0, "2"), (1, "1"), (2, ""), (3, "3"), (4, ""), (5, ""), (6, ""), (7, "")]


def test_rows_are_not_spread_over_the_levels(spark):
    """Only distinct (currency, day) pairs are exploded: the rows reach the join once each."""
    rates = spark.createDataFrame([(1, "1", D(1998, 1, 1), D(9999, 12, 31))], "currency_rk INT, reduced_cource STRING, data_actual_date DATE, data_actual_end_date DATE")
    rows = spark.range(0, 10_000, 1, 4).select(F.lit(1).alias("currency_rk"), F.lit(D(1998, 5, 1)).alias("oper_date"), "id")
    plan = TO.with_rates(rows, rates)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Generate")]
    assert "Aggregate" in plan[plan.index("Generate"):] and "Join LeftOuter" in above

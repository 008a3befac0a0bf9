"""Quantiles and ranks by value ranges: skewed keys, continuous values, ties, values that are no numbers."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seawake.operators import aggregates
from tests.helpers import rows_of

NAN, INF = float("nan"), float("inf")
FIVE = {"minimum": 0.0, "q1": 0.25, "mediane": 0.5, "q3": 0.75, "maximum": 1.0}


def table(spark, pairs):
    return spark.createDataFrame(pairs, "navire_id string, v double")


@pytest.fixture(scope="module")
def hot():
    """Nine tenths of the rows on one ship, in 0..1, with ties; a ship with one value, one with few."""
    rng = random.Random(7)
    pairs = [("HOT", rng.random()) for _ in range(4000)] + [("HOT", 0.5)] * 800 + [("HOT", 0.25)] * 300
    return pairs + [("ONE", 3.0)] + [("FEW", float(x)) for x in (1, 2, 2, 9)] + [(None, -1.5), (None, 4.0)]


def test_quantiles_of_continuous_values(spark, hot):
    got = {r.navire_id: r for r in aggregates.quantiles(table(spark, hot), "v", FIVE).collect()}
    assert len(got) == 4
    for ship, r in got.items():
        values = [v for s, v in hot if s == ship]
        assert r.nombre == len(values)
        for name, p in FIVE.items():
            assert abs(r[name] - np.quantile(values, p)) < 1e-12, (ship, name)


def test_quantiles_pass_over_what_is_no_number(spark):
    pairs = [("A", x) for x in (10.0, 20.0, NAN, None)] + [("B", x) for x in (1.0, 2.0, INF, -INF)] + [("C", NAN), ("C", None)]
    got = {r.navire_id: tuple(r[1:]) for r in aggregates.quantiles(table(spark, pairs), "v", FIVE).collect()}
    assert got == {"A": (2, 10.0, 12.5, 15.0, 17.5, 20.0), "B": (2, 1.0, 1.25, 1.5, 1.75, 2.0)}
    assert aggregates.quantiles(table(spark, pairs).limit(0), "v", FIVE).isEmpty()


def test_grid_passes_over_what_is_no_number(spark):
    rows = rows_of(spark, {}, {"longitude": INF}, {"latitude": -INF}, {"latitude": NAN})
    assert [r.nombre for r in aggregates.traffic_grid(rows).collect()] == [1]


def test_ranks_equal_a_window(spark, hot):
    rows = table(spark, [*hot, ("HOT", NAN), ("HOT", NAN), ("HOT", None), ("HOT", None), ("HOT", INF), ("FEW", None)])
    rows = rows.withColumn("id", F.monotonically_increasing_id()).cache()
    got = aggregates.ranked(rows, "v", ["navire_id"], "r", "d")
    over = Window.partitionBy("navire_id").orderBy(F.col("v").desc())
    want = rows.select("id", F.rank().over(over).alias("r"), F.dense_rank().over(over).alias("d"))
    assert sorted((x.id, x.r, x.d) for x in got.collect()) == sorted((x.id, x.r, x.d) for x in want.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert all("_bin" in line for line in plan.splitlines() if "rank(" in line and "Window" in line)


def test_a_task_holds_a_share_of_a_hot_key(spark, hot):
    sizes = aggregates.in_value_ranges(table(spark, hot), "v", ["navire_id"]).filter("navire_id = 'HOT'").groupBy("_bin").count()
    # Equal values share a range; the distinct ones are what a range orders.
    distinct = aggregates.in_value_ranges(table(spark, hot).distinct(), "v", ["navire_id"])
    largest = distinct.filter("navire_id = 'HOT'").groupBy("_bin").count().agg(F.max("count")).first()[0]
    assert sizes.count() > 40 and largest < 4000 / 25

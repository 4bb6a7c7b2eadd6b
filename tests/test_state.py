"""Merged states against the whole table, and the rank error of approximate quantiles."""

import bisect
import math
import random

import pytest
from pyspark.sql import functions as F

from sparkprep.operators.missing import MissingValueTransformer
from sparkprep.operators.outliers import OutlierRemovalTransformer
from sparkprep.operators.state import (
    ProfileStore,
    approximate_quantiles,
    merge_states,
    profile_state,
    rank_error,
    state_report,
    statistics_of,
)


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(40_000).select(
        "id",
        F.when(F.col("id") % 9 != 0, F.pow(F.col("id") % 1000, F.lit(1.7)) + 1e6).alias("x"),
        F.when(F.col("id") < 100, F.lit(float("nan"))).otherwise(F.lit(3.0)).alias("same"),
        F.lit(None).cast("double").alias("none"),
        F.concat(F.lit("t"), F.col("id") % 5000).alias("t"),
    )


def rows(report):
    return {r["column"]: r.asDict() for r in report.collect()}


def close(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-9))


def test_merged_states_are_the_state_of_the_whole(spark, table, tmp_path):
    store = ProfileStore(spark, str(tmp_path), label="t")
    for k in range(4):
        store.add(table.where(F.col("id") % 4 == k) if k else table.where("id % 4 = 0 AND id < 5000"), str(k))
    store.add(table.where("id % 4 = 0"), "0")  # replaced, not counted twice
    store.add(table.limit(0), "empty")
    whole, merged = rows(state_report(profile_state(table))), rows(state_report(store.state()))
    assert whole.keys() == merged.keys() == set(table.columns)
    for c, w in whole.items():
        for k in ("rows", "missing", "n", "mean", "std", "skew", "min", "max"):
            assert close(w[k], merged[c][k]), (c, k, w[k], merged[c][k])
    assert merged["same"]["missing"] == 100 and merged["same"]["skew"] is None and merged["none"]["quantiles"] is None
    assert abs(merged["t"]["distinct"] - 5000) < 250
    own = table.agg(F.avg("x"), F.stddev_pop("x"), F.skewness("x")).first()
    assert all(close(a, merged["x"][k]) for a, k in zip(own, ("mean", "std", "skew")))
    counts = {r["label"]: r["n"] for r in store.class_counts().collect()}
    assert len(counts) == 5000 and set(counts.values()) == {8}
    assert close(statistics_of(store.state(), ["x"])["x"]["mean"], own[0])


def test_merging_in_any_order(spark, table):
    parts = [profile_state(table.where(F.col("id") % 3 == k)) for k in range(3)]
    left = merge_states(merge_states(parts[0].unionByName(parts[1])).unionByName(parts[2]))
    right = merge_states(parts[0].unionByName(merge_states(parts[2].unionByName(parts[1]))))
    a, b = rows(state_report(left)), rows(state_report(right))
    assert all(close(a[c][k], b[c][k]) for c in a for k in ("rows", "n", "mean", "std", "skew"))


def test_rank_error_of_ten_million_values(spark):
    df = spark.range(10_000_000).select(
        (F.col("id") * 48_271 % 10_000_019).cast("double").alias("x"), F.rand(3).alias("y")
    )
    places = [0.01, 0.25, 0.5, 0.75, 0.99]
    found = approximate_quantiles(df, ["x", "y"], places)
    for c in ("x", "y"):
        below = df.agg(*[F.avg((F.col(c) <= v).cast("double")) for v in found[c]]).first()
        assert all(abs(b - p) <= 2 * rank_error() for b, p in zip(below, places)), (c, below)


def test_stages_take_approximate_quantiles(spark):
    rng = random.Random(1)
    values = [rng.gauss(10, 3) if rng.random() < 0.9 else None for _ in range(20_000)]
    df = spark.createDataFrame([(i, "a", v) for i, v in enumerate(values)], "id long, y string, x double")
    roles = dict(label="y", preserve_cols=["id"], quantiles="approximate")
    median = MissingValueTransformer(**roles).fit(df).fitted["fills"]["x"]["value"]
    ordered = sorted(v for v in values if v is not None)
    assert abs(bisect.bisect(ordered, median) / len(ordered) - 0.5) <= 2 * rank_error()
    stage = OutlierRemovalTransformer(valid_ranges={"x": (-1e9, 1e9)}, remove_statistical_outliers=True, **roles)
    exact = OutlierRemovalTransformer(
        valid_ranges={"x": (-1e9, 1e9)}, remove_statistical_outliers=True, label="y", preserve_cols=["id"]
    )
    assert stage.fit(df).fitted["fences"]["x"] == pytest.approx(exact.fit(df).fitted["fences"]["x"], rel=0.02)
    with pytest.raises(ValueError):
        MissingValueTransformer(label="y", preserve_cols=["id"], quantiles="rough").fit(df)

"""Exactness, skew and numbers of passes of what is built for large tables."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkprep.operators import lookup, quantiles, tally
from sparkprep.operators.encoding import FeatureEncoder


def by_sorting(values, probabilities):
    ordered = sorted(v for v in values if v is not None)
    if not ordered:
        return [None] * len(probabilities)
    places = [p * (len(ordered) - 1) for p in probabilities]
    return [quantiles._between(x, ordered[math.floor(x)], ordered[math.ceil(x)]) for x in places]


def same(a, b):
    return all(x == y or (x != x and y != y) for x, y in zip(a, b, strict=True))


FLOATS = st.one_of(
    st.none(), st.floats(-1e6, 1e6), st.sampled_from([0.0, -0.0, 1.0, math.inf, -math.inf])
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(FLOATS, FLOATS, st.integers(0, 2)), min_size=1, max_size=60), st.floats(0, 1))
def test_searched_quantiles_of_any_values(spark, monkeypatch, rows, p):
    """Several columns and groups, infinities and both zeros, by one search to single rows."""
    monkeypatch.setattr(quantiles, "INSIDE_ROWS", 1)
    df = spark.createDataFrame(rows, "x double, y double, g int")
    places = [0.0, p, 1.0]
    found = quantiles.exact_quantiles(df, ["x", "y"], places)
    assert same(found["x"], by_sorting([r[0] for r in rows], places))
    assert same(found["y"], by_sorting([r[1] for r in rows], places))
    for r in quantiles.exact_quantiles_by(df, "g", ["x", "y"], places).collect():
        own = [x["xy".index(r["column"])] for x in rows if x[2] == r["g"]]
        assert same(r["quantiles"], by_sorting(own, places))


def test_column_filled_by_one_value(spark):
    df = spark.range(50_000).select(F.lit(7.0).alias("x"), F.lit(None).cast("double").alias("z"))
    assert quantiles.exact_quantiles(df, ["x", "z"], [0.5]) == {"x": [7.0], "z": [None]}


def jobs_of(spark, action):
    """Spark jobs that ``action`` starts."""
    sc = spark.sparkContext
    group = f"count-{random.random()}"
    sc.setJobGroup(group, group)
    try:
        action()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_many_large_groups_share_the_rounds(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "INSIDE_ROWS", 10)

    def table(groups):
        return spark.range(groups * 40).select(
            (F.col("id") % groups).alias("g"), (F.col("id") * 7 % 1009).cast("double").alias("x")
        )

    counts = [
        jobs_of(spark, lambda g=g: quantiles.exact_quantiles_by(table(g), "g", ["x"], [0.5])) for g in (10, 1000)
    ]
    assert counts[1] <= counts[0] + 8


def test_two_hundred_thousand_groups(spark, monkeypatch):
    """Many small groups and a few large ones, by hash joins; nothing of a group is collected."""
    monkeypatch.setattr(quantiles, "BROADCAST_GAPS", 100)
    monkeypatch.setattr(quantiles, "INSIDE_ROWS", 500)
    g = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 97 == 1, F.lit(None)).otherwise(F.col("id") % 200_000)
    x = F.when(F.col("id") % 11 != 0, (F.col("id") * 7919 % 10_007).cast("double"))
    df = spark.range(900_000).select(g.cast("long").alias("g"), x.alias("x"))
    found = quantiles.exact_quantiles_by(df, "g", ["x"], [0.25, 0.5, 1.0])
    wanted = df.groupBy("g").agg(*[F.percentile("x", p).alias(f"p{i}") for i, p in enumerate((0.25, 0.5, 1.0))])
    rows = found.select("g", *[F.get("quantiles", F.lit(i)).alias(f"p{i}") for i in range(3)])
    assert rows.count() == wanted.count() > 190_000
    assert rows.exceptAll(wanted).isEmpty()


def test_skewed_categories(spark, monkeypatch):
    """Hot, rare, missing and unseen categories; the hot unseen one is dealt to several parts."""
    monkeypatch.setattr(lookup, "HOT_SHARE", 0.1)
    df = spark.range(5000).select(
        F.when(F.col("id") < 2000, "hot")
        .when(F.col("id") < 4900, F.concat(F.lit("c"), F.col("id") % 300))
        .alias("g"),
        (F.col("id") % 3).cast("double").alias("x"),
        F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("y"),
    )
    stage = FeatureEncoder(multilabel_cols=[], onehot_cols=[], target_cols=["g"], label="y", preserve_cols=[])
    model = stage.fit(df)
    rows = df.collect()
    y = {k: [r["y"] == "b" for r in rows if r["g"] == k] for k in {r["g"] for r in rows}}
    mean = sum(map(sum, y.values())) / 5000

    def expected(k):
        if k not in y:
            return mean
        n, own = len(y[k]), sum(y[k]) / len(y[k])
        weight = n * mean * (1 - mean) / (n * mean * (1 - mean) + own * (1 - own))
        return weight * own + (1 - weight) * mean

    unseen = spark.range(3000).select(F.lit("new").alias("g"), F.col("id").cast("double").alias("x"), F.lit("a").alias("y"))
    model.tables = {c: t.hint("merge") for c, t in model.tables.items()}
    both = df.withColumn("k", F.col("g")).unionByName(unseen.withColumn("k", F.col("g")))
    for r in model.transform(both).collect():
        assert r["g"] == pytest.approx(expected(r["k"]), abs=1e-9)
    cold = model.transform(unseen).select("g", F.spark_partition_id().alias("part"))
    with_parts = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert cold.groupBy("part").count().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_parts)


def test_fit_passes_do_not_grow_with_the_columns(spark):
    df = spark.range(500).select(
        *[F.concat(F.lit("a,b"), F.col("id") % (i + 2)).alias(f"l{i}") for i in range(4)],
        *[(F.col("id") % (i + 2)).cast("string").alias(f"s{i}") for i in range(4)],
        *[(F.col("id") % (i + 5)).cast("string").alias(f"t{i}") for i in range(4)],
        F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("y"),
    )
    scanned = []
    original = tally.land

    def counted(frame, name):
        scanned.append(name)
        return original(frame, name)

    def fit(n):
        scanned.clear()
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(tally, "land", counted)
            FeatureEncoder(
                multilabel_cols=[f"l{i}" for i in range(n)],
                onehot_cols=[f"s{i}" for i in range(n)],
                target_cols=[f"t{i}" for i in range(n)],
                label="y",
                preserve_cols=[],
            ).fit(df)
        return list(scanned)

    assert fit(1) == fit(4) == ["tally"]


def test_transform_of_a_fitted_chain_shuffles_nothing(spark, small):
    from sparkprep.plans.queries_checks import prepared, split_landed

    df = split_landed(spark, small)
    done = prepared(include_pca=True).fit(df).transform(df)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_only_needed_columns_are_read(spark, small):
    from sparkprep.operators import profile
    from sparkprep.plans.product_features import table

    found = profile.class_distribution(table(spark, small, "orders"), "o_orderpriority")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderpriority:string>" in plan
    assert "PushedFilters: [IsNotNull(o_orderpriority)]" in plan

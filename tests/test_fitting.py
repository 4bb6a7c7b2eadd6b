"""The chain fitted with shared passes: same models as stage after stage, and few passes."""

import math
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from sparkprep.operators.derived import FeatureEngineer
from sparkprep.operators.encoding import FeatureEncoder
from sparkprep.operators.reduction import FeatureReducer
from sparkprep.operators.scaling import FeatureScaler
from sparkprep.operators.tally import (
    Tally,
    cell,
    column_moments,
    indicator_statistics,
    number_cells,
    number_statistics,
)
from sparkprep.plans.fitting import fit_stages
from sparkprep.plans.preparation import preparation_stages

ROLES = dict(label="y", split_col="part", preserve_cols=["id"])


def made(spark, rows=600, extra=0):
    rng = random.Random(4)
    out = []
    for i in range(rows):
        out.append(
            (
                i,
                rng.choice("abc") if i % 50 else None,
                ",".join(rng.choices(["fr", "de", "fr ", "unknown", ""], k=rng.randrange(4))) or None,
                rng.choice(["x", "y", "z", None]),
                rng.choice([f"k{j}" for j in range(40)] + [None]),
                rng.gauss(0, 1) if i % 7 else None,
                float(int(rng.expovariate(0.3))),
                3.5,
                "train",
                *[rng.random() * (k + 1) for k in range(extra)],
            )
        )
    names = ["id", "y", "many", "one", "wide", "a", "b", "same", "part", *[f"n{k}" for k in range(extra)]]
    kinds = ["long"] + ["string"] * 4 + ["double"] * 3 + ["string"] + ["double"] * extra
    return spark.createDataFrame(out, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def chain(**settings):
    return list(
        preparation_stages(
            target_col="y",
            split_group_col="part",
            preserve_cols=["id"],
            valid_ranges={"b": (0.0, 9.0)},
            zero_fill=[],
            multilabel_cols=["many"],
            onehot_cols=["one"],
            target_encoded_cols=["wide"],
            feature_engineering_kwargs=dict(
                ratios=[("a_to_b", "a", "b")], densities=[], contributions=[("b4", "b", 4.0)], flags=[("high", "a", 0.5)]
            ),
            **settings,
        ).values()
    )


def near(x, y):
    if isinstance(x, dict):
        return x.keys() == y.keys() and all(near(x[k], y[k]) for k in x)
    if isinstance(x, list):
        return len(x) == len(y) and all(map(near, x, y))
    if isinstance(x, float) and isinstance(y, float):
        return math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)
    return x == y


def states(model):
    return [m.fitted for m in model.stages if hasattr(m, "fitted")]


@pytest.mark.parametrize("settings", [{}, {"scaling_method": "robust"}, {"include_feature_engineering": False}, {"include_pca": False}])
def test_same_models_as_stage_after_stage(spark, settings):
    df = made(spark)
    one, two = fit_stages(chain(**settings), df), Pipeline(stages=chain(**settings)).fit(df)
    for x, y in zip(states(one), states(two)):
        assert near(x, y), (x, y)
    a, b = (sorted(tuple(r) for r in m.transform(df).collect()) for m in (one, two))
    assert len(a) == len(b) and all(near(list(x), list(y)) for x, y in zip(a, b))


def test_derived_columns_of_encoded_ones_are_fitted_in_turn(spark):
    """A derived column whose source is target-encoded sees another version of it."""
    df = made(spark).withColumn("wide", (F.col("id") % 5).cast("double"))
    stages = lambda: [
        FeatureEncoder(multilabel_cols=["many"], onehot_cols=["one"], target_cols=["wide"], **ROLES),
        FeatureEngineer(ratios=[], densities=[], contributions=[("w2", "wide", 2.0)], flags=[]),
        FeatureScaler(**ROLES),
    ]
    df = df.where("y IS NOT NULL")
    one, two = fit_stages(stages(), df), Pipeline(stages=stages()).fit(df)
    assert all(near(x, y) for x, y in zip(states(one), states(two)))
    assert "w2" in states(one)[-1]


def test_tally_and_indicators(spark):
    df = made(spark)
    tally = Tally(df, {"one": F.array(cell(F.col("one"))), "numbers": number_cells(df, ["a", "b", "same"])})
    few = tally.most({"one": 2, "numbers": 3})
    counts = {r["one"]: r["count"] for r in df.groupBy("one").count().collect()}
    assert few["one"][0]["token"] is None and few["one"][0]["n"] == counts[None]
    assert few["one"][1]["n"] == max(n for t, n in counts.items() if t is not None)
    found = number_statistics(few["numbers"])
    assert found["a"]["n"] == df.where("a IS NOT NULL").count() and found["same"]["std"] == 0
    ones = df.select(
        F.col("one").eqNullSafe("x").cast("double").alias("v")
    )
    r = ones.agg(F.count("v"), F.avg("v"), F.stddev_pop("v"), F.min("v"), F.max("v"), F.skewness("v")).first()
    made_of = indicator_statistics(counts["x"], 600)
    assert near(list(made_of.values()), list(r))


def passes(spark, df, action):
    """How often ``action`` reads all rows of the landed table ``df``, by the records its stages read."""
    sc = spark.sparkContext
    store = sc._jsc.sc().statusStore()
    none = sc._gateway.new_array(sc._jvm.double, 0)

    def read():
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(None, False, False, none, None)
        return {stages.apply(i).stageId(): stages.apply(i).inputRecords() for i in range(stages.size())}

    before = read()
    action()
    return sum(n for s, n in read().items() if s not in before) / df.count()


def test_passes_do_not_grow_with_columns(spark, tmp_path):
    found = []
    for extra in (0, 30):
        path = f"{tmp_path}/{extra}"
        made(spark, 3000, extra).repartition(2).write.parquet(path)
        df = spark.read.parquet(path)
        found.append(passes(spark, df, lambda df=df: fit_stages(chain(), df)))
    assert found[0] <= 12 and found[1] <= found[0] + 0.5, found


def test_tokens_of_a_cell_are_made_once(spark):
    """Not once more for each token, which a nested expression would cost."""
    ask = FeatureEncoder(multilabel_cols=["many"], onehot_cols=[], target_cols=[], **ROLES).asks(made(spark))["list many"]
    assert str(ask).count("regexp_replace") == 1


def test_moments_of_columns(spark):
    """Against Spark's own aggregates; numbers are added up in their tasks and not exploded."""
    far = float("inf")
    rows = [(i, float(i * i % 31) + 1e6, 5.5, None, i / 3 if i % 4 else None, far if i == 9 else 1.0) for i in range(300)]
    rows += [(None, float("nan"), 5.5, None, None, 2.0)]
    df = spark.createDataFrame(rows, "a int, b double, c double, d double, e float, f double").repartition(5)
    found = number_statistics(column_moments(df, df.columns).collect())
    assert sorted(found) == sorted(df.columns)
    for c in df.columns:
        v = F.nanvl(F.col(c).cast("double"), F.lit(None))
        r = df.agg(F.count(v), F.avg(v), F.stddev_pop(v), F.min(v), F.max(v), F.skewness(v)).first()
        for x, y in zip(found[c].values(), r):
            assert x == y or (x != x and y != y) or abs(x - y) <= 1e-9 * max(abs(x), abs(y), 1), (c, found[c], r)
    assert column_moments(df.where("a > 1000"), df.columns).count() == 0
    assert "Generate" not in column_moments(df, df.columns)._jdf.queryExecution().toString()


def test_components_read_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    plain = made(spark, 3000).select("id", "a", "b", "same").na.fill(0.0)
    df = plain.mapInArrow(counted, plain.schema)
    reducer = FeatureReducer(label="y", split_col="part", preserve_cols=["id"])
    columns = reducer.columns_of(df)
    means = [plain.agg(F.avg(c)).first()[0] for c in columns]
    model = reducer.fit_centred(df, columns, means, 3000)
    assert seen.value == 3000
    assert abs(sum(model.explained_variance_ratio())) >= 0.95

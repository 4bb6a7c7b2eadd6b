"""Sources, sinks, saved stages and whole jobs."""

import gzip
import warnings
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparkprep import PreprocessingPipeline, create_preprocessing_pipeline, workspace
from sparkprep.operators import validation
from sparkprep.operators.derived import FeatureEngineer
from sparkprep.operators.encoding import FeatureEncoder, FeatureEncoderModel
from sparkprep.operators.missing import MissingValueModel, MissingValueTransformer
from sparkprep.operators.scaling import FeatureScaler, FeatureScalerModel
from sparkprep.plans import jobs
from sparkprep.plans.product_features import KEY, LABEL
from sparkprep.plans.queries_checks import prepared, split_landed
from sparkprep.plans.queries_transform import ROLES
from sparkprep.sources import reports, splits, tables
from sparkprep.streaming.scoring import prepare_stream, read_stream

LINES = [
    "grade\tcode\tx\textra",
    "A\t1\t1.5\tq",
    "b\t2\tNA\tq",
    "c\t3\t2\tq\tsurplus",
    "d\t4",
    "z\t5\t3\tq",
    "\t6\t4\tq",
    'e\t7\t"5"\t"two\nlines and a ""quote"""',
    "a\t8\tnot a number\tnull",
    'b\t9\t1\t"tab\there"',
]


@pytest.fixture
def dump(tmp_path):
    path = tmp_path / "dump.tsv.gz"
    with gzip.open(path, "wt") as f:
        f.write("\n".join(LINES) + "\n")
    return str(path)


def test_delimited_text(spark, dump):
    rows = {
        r["code"]: r for r in tables.read_delimited(spark, dump, numeric=["x"]).collect()
    }
    assert set(rows) == set("12456789")
    assert rows["1"]["x"] == 1.5 and rows["2"]["x"] is None and rows["8"]["x"] is None
    assert rows["4"]["x"] is None and rows["4"]["extra"] is None
    assert rows["6"]["grade"] is None and rows["8"]["extra"] is None
    assert rows["7"]["extra"] == 'two\nlines and a "quote"' and rows["9"]["extra"] == "tab\there"


def test_only_wanted_columns_are_kept(spark, dump):
    got = tables.read_delimited(spark, dump, columns=["x", "absent", "code"], numeric=["x"])
    assert got.columns == ["x", "code"] and got.count() == 8


def test_single_line_reading(spark, tmp_path):
    path = tmp_path / "plain.tsv"
    path.write_text("\n".join([LINES[0], *LINES[1:7], LINES[8]]) + "\n")
    got = tables.read_delimited(spark, str(path), numeric=["x"], multi_line=False)
    assert sorted(r["code"] for r in got.collect()) == ["1", "2", "4", "5", "6", "8"]


def test_acquire(spark, dump, tmp_path):
    found = jobs.acquire(
        spark, dump, label="grade", columns=["grade", "code", "x", "absent"], numeric=["x"]
    )
    assert sorted(r["code"] for r in found.table.collect()) == ["1", "2", "4", "7", "8", "9"]
    assert {r["label"]: r["n"] for r in found.distribution.collect()} == {
        "A": 2, "B": 2, "D": 1, "E": 1,
    }
    row = found.metadata.first()
    assert (row["total_products"], row["labelled_products"], row["filtered_products"]) == (8, 7, 6)
    assert row["missing_columns"] == "absent" and row["columns"] == 3
    jobs.load_and_filter_data(
        spark, dump, str(tmp_path / "out"), str(tmp_path / "meta"), label="grade",
        columns=["grade", "code", "x"], numeric=["x"], sample_size=4,
    )
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    assert reports.read_report(spark, str(tmp_path / "meta")).first()["kept_products"] == 4
    with pytest.raises(ValueError):
        jobs.acquire(spark, dump, label="absent")


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a,"b"\nc', 1.5), ("2", None, None)], "k string, t string, x double")
    tables.write_table(df, str(tmp_path / "t"), "csv")
    back = tables.read_csv(spark, str(tmp_path / "t"), numeric=["x"], multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_landed_tables_lie_in_one_folder_of_the_application(spark):
    class Elsewhere:
        """The session with another application's folder."""

        sparkContext = type("Context", (), {"applicationId": "gone"})()
        conf, _jvm, _jsc = spark.conf, spark._jvm, spark._jsc

    path = workspace.run_path(Elsewhere, "table")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3 and "sparkprep-gone" in path
    workspace.drop_landed(Elsewhere)
    assert not Path(path).exists()
    assert spark.sparkContext.applicationId in workspace.run_path(spark, "table")


def test_saved_splits(spark, small, tmp_path):
    df = split_landed(spark, small)
    paths = splits.save_splits(df, str(tmp_path / "s"))
    assert paths["val"].endswith("split_group=val")
    x, y = splits.load_val_data(spark, str(tmp_path / "s"), label=LABEL)
    assert x.count() == y.count() == df.where("split_group = 'val'").count()
    assert LABEL not in x.columns and y.columns == [LABEL]
    assert splits.load_train_data(spark, str(tmp_path / "s"), label=LABEL)[0].count() > x.count()
    plan = x._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split_group" in plan
    assert splits.load_test_data(spark, str(tmp_path / "s"), label=LABEL)[1].count() > 0


def test_split_job(spark, small, tmp_path):
    df = split_landed(spark, small)
    stats = jobs.split_dataset(
        df, str(tmp_path / "s"), str(tmp_path / "m"), label=LABEL, key=[KEY]
    )
    assert stats["is_balanced"] and sum(stats["train_counts"].values()) > 0
    row = reports.read_report(spark, str(tmp_path / "m")).first()
    assert row["target_col"] == LABEL and row["random_state"] == "42"


def test_preprocess_job(spark, tmp_path):
    rows = [("1", "a", "en:us,france", 1.0, 4.2, "m1"), ("2", "b", None, None, 8.4, "m2"),
            ("3", None, "it", 3.0, 1.0, "m3")]
    df = spark.createDataFrame(
        rows,
        "code string, nutriscore_grade string, countries string, fat_100g double, "
        "energy_100g double, main_category string",
    )
    tables.write_table(df, str(tmp_path / "in.csv"), "csv")
    done, model = jobs.preprocess_dataset(
        spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), str(tmp_path / "report")
    )
    assert done.columns == ["code", "nutriscore_grade", "countries", "fat_100g", "main_category"]
    got = {r["code"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got["1"]["countries"] == "France,United States" and got["2"]["countries"] == "unknown"
    assert got["2"]["fat_100g"] == 1.0 and set(got) == {"1", "2"}
    assert reports.read_report(spark, str(tmp_path / "report")).count() == 2


def test_wide_text_is_dropped_by_exact_count_near_the_bound(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("t"), F.col("id")).alias("all"), (F.col("id") % 100).cast("string").alias("some")
    )
    assert jobs.drop_wide_text(df, ["all", "some", "none"], bound=100).columns == ["some"]
    assert jobs.drop_wide_text(df, ["all", "some"], bound=99).columns == []
    assert jobs.drop_wide_text(df, ["all"], bound=1000).columns == ["all", "some"]


def test_single_stages_come_back(spark, tmp_path, small):
    df = split_landed(spark, small)
    pairs = [
        (MissingValueTransformer(**ROLES), MissingValueModel),
        (FeatureScaler(**ROLES), FeatureScalerModel),
        (
            FeatureEncoder(
                multilabel_cols=["countries"], onehot_cols=["seg"], target_cols=["nation"], **ROLES
            ),
            FeatureEncoderModel,
        ),
    ]
    for stage, model_class in pairs:
        path = str(tmp_path / model_class.__name__)
        model = stage.fit(df)
        model.write().overwrite().save(path)
        loaded = model_class.load(path)
        assert loaded.fitted == model.fitted
        assert loaded.transform(df).exceptAll(model.transform(df)).count() == 0
    FeatureEngineer(add_ratios=False).save(str(tmp_path / "engineer"))
    assert FeatureEngineer.load(str(tmp_path / "engineer")).value("add_ratios") is False


def test_prepared_chain(spark, small, tmp_path):
    df = split_landed(spark, small)
    chain = prepared(include_pca=True)
    assert chain.get_pipeline_steps() == [
        "missing_values", "outlier_removal", "encoding", "feature_engineering", "scaling", "pca",
    ]
    with pytest.raises(ValueError):
        chain.transform(df)
    done = chain.fit_transform(df)
    reducer = chain.get_transformer("pca")
    assert reducer.cumulative_variance()[-1] >= 0.95 and chain.get_transformer("absent") is None
    assert set(done.columns) == {*reducer.component_columns, LABEL, "split_group", KEY}
    before = df
    for stage in chain.model.stages[:-1]:
        before = stage.transform(before)
    checks = validation.check_reduction(reducer, before, done, LABEL, "split_group").collect()
    assert all(r["passed"] for r in checks)
    encoder = chain.get_transformer("encoding")
    assert 0 < len(encoder.top_countries["countries"]) <= 15
    chain.save(str(tmp_path / "chain"))
    loaded = PreprocessingPipeline.load(str(tmp_path / "chain"))
    assert loaded.get_pipeline_steps() == chain.get_pipeline_steps()
    assert loaded.transform(df).exceptAll(done).count() == 0


def test_held_out_rows_do_not_change_what_is_fitted(spark, small):
    df = split_landed(spark, small)
    shifted = df.withColumn(
        "carb", F.when(F.col("split_group") == "train", F.col("carb")).otherwise(F.lit(99.0))
    )
    models = [prepared(include_pca=False).fit(d) for d in (df, shifted)]
    for step in ("missing_values", "encoding", "scaling"):
        assert models[0].get_transformer(step).fitted == models[1].get_transformer(step).fitted


def test_fitting_without_split_column_warns(spark, small):
    df = split_landed(spark, small).drop("split_group")
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        done = prepared(include_pca=False, include_feature_engineering=False).fit_transform(df)
    assert any(issubclass(w.category, UserWarning) for w in caught)
    assert done.count() > 0


def test_plain_stage_list(spark):
    names = [type(s).__name__ for s in create_preprocessing_pipeline(include_pca=False).getStages()]
    assert names == [
        "MissingValueTransformer", "OutlierRemovalTransformer", "FeatureEncoder",
        "FeatureEngineer", "FeatureScaler",
    ]


def test_unlabelled_and_single_rows_can_be_prepared(spark, small):
    df = split_landed(spark, small)
    chain = prepared(include_pca=True).fit(df)
    one = df.where("salt BETWEEN 0 AND 50").limit(1)
    assert chain.transform(one).count() == 1
    assert chain.transform(one.drop(LABEL, "split_group")).count() == 1
    assert chain.transform(df.limit(0)).count() == 0


def test_stream_needs_fitted_statistics(spark, small):
    df = split_landed(spark, small)
    model = MissingValueTransformer(stats_from="transform", **ROLES).fit(df)
    with pytest.raises(ValueError):
        prepare_stream(model, df, "/nowhere", "/nowhere-checkpoint")


def test_stream_refuses_an_output_of_another_checkpoint(spark, small, tmp_path):
    df = split_landed(spark, small).select("code", "fat").limit(10)
    df.write.parquet(f"{tmp_path}/in")

    class Same:
        stages: list = []

        def transform(self, rows):
            return rows

    rows = read_stream(spark, f"{tmp_path}/in", df.schema)
    prepare_stream(Same(), rows, f"{tmp_path}/out", f"{tmp_path}/one").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 10
    with pytest.raises(ValueError, match="another checkpoint"):
        prepare_stream(Same(), rows, f"{tmp_path}/out", f"{tmp_path}/two")


def test_checks_find_what_is_wrong(spark):
    df = spark.createDataFrame(
        [("a", -1.0, 0.5, "p"), (None, 5.0, 2.0, "q")], "y string, x double, g_1 double, g string"
    )
    domain = {(r["check"], r["column"]): r for r in validation.check_domain(df, {"x": (0, 3)}, "y").collect()}
    assert domain[("negative values", "x")]["value"] == 1 and not domain[("label missing", "y")]["passed"]
    assert domain[("outside range", "x")]["value"] == 2
    onehot = {r["check"]: r["passed"] for r in validation.check_onehot(df, "g", ["g_1"]).collect()}
    assert onehot == {
        "values not 0 or 1": False, "row sums not 0 or 1": False, "source removed": False,
    }
    assert not validation.check_target_encoding(df, "g").first()["passed"]
    assert not validation.check_target_encoding(df, "g_1").where("check = 'maximum'").first()["passed"]
    assert [r["passed"] for r in validation.check_columns(df, ["x", "zz"]).collect()] == [True, False]

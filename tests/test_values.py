"""Hand-computed fixtures for missing values, filters, derived columns and scaling."""

import collections
import math

import pytest
from pyspark.sql import functions as F

from sparkprep.functions import text
from sparkprep.functions.countries import country_aliases
from sparkprep.operators.dictionary import clean_lists
from sparkprep.operators import outliers, profile, scaling
from sparkprep.operators.derived import FeatureEngineer
from sparkprep.operators.encoding import FeatureEncoder, top_tokens
from sparkprep.operators.missing import MissingValueTransformer
from sparkprep.operators.outliers import OutlierRemovalTransformer
from sparkprep.operators.reduction import FeatureReducer, FeatureReducerModel, select_components
from sparkprep.operators.scaling import FeatureScaler

ROLES = {"label": "y", "preserve_cols": ["code"]}


def values(df, column):
    return [r[column] for r in df.collect()]


def test_null_and_nan_pass_range_rules(spark):
    df = spark.createDataFrame([(1.0,), (None,), (math.nan,), (200.0,), (-1.0,)], "x double")
    kept = values(outliers.domain_filter(df, {"x": (0.0, 100.0)}), "x")
    assert len(kept) == 3 and kept[0] == 1.0 and kept[1] is None and math.isnan(kept[2])


def test_range_bounds_are_inclusive_and_absent_columns_ignored(spark):
    df = spark.createDataFrame([(0.0,), (100.0,), (100.1,)], "x double")
    assert outliers.domain_filter(df, {"x": (0.0, 100.0), "z": (0.0, 1.0)}).count() == 2


def test_first_failing_rule_gets_the_row(spark):
    df = spark.createDataFrame([(200.0, 99.0), (1.0, 99.0), (1.0, 1.0)], "a double, b double")
    ranges = {"a": (0.0, 100.0), "b": (0.0, 50.0)}
    counts = {r["column"]: r["count"] for r in outliers.removal_reasons(df, ranges).collect()}
    assert counts == {"a": 1, "b": 1}


def test_empty_table_has_zero_percent_removed(spark):
    df = spark.createDataFrame([], "x double")
    row = outliers.removal_totals(df, {"x": (0.0, 1.0)}).first()
    assert (row["rows_before"], row["rows_removed"], row["removal_percentage"]) == (0, 0, 0.0)
    assert profile.outlier_profile(df, {"x": (0.0, 1.0)}).first()["median"] is None
    assert profile.missing_profile(df).first()["missing_percentage"] == 0.0


def test_fences_cut_only_above_and_never_beyond_the_valid_maximum(spark):
    rows = [(float(v),) for v in [0, *([50] * 20), *([52] * 20), 90, 99]]
    df = spark.createDataFrame(rows, "x double")
    fences = outliers.upper_fences(df, {"x": (0.0, 100.0)})
    assert fences == {"x": 58.0}
    assert outliers.upper_fences(df, {"x": (0.0, 55.0)}) == {"x": 55.0}
    assert min(values(outliers.fence_filter(df, fences), "x")) == 0.0


def test_fence_table_is_the_fitted_or_the_transformed_one(spark):
    train = spark.createDataFrame([(float(i % 10),) for i in range(100)], "x double")
    test = spark.createDataFrame([(float(40 + i % 10),) for i in range(100)], "x double")
    kept = {}
    for source in ("fit", "transform"):
        stage = OutlierRemovalTransformer(
            valid_ranges={"x": (0, 100)}, remove_statistical_outliers=True, stats_from=source
        )
        kept[source] = stage.fit(train).transform(test).count()
    assert kept == {"fit": 0, "transform": 100}


def test_guarded_ratios(spark):
    rows = [(6.0, 3.0), (6.0, 0.0), (6.0, None), (None, 3.0)]
    df = spark.createDataFrame(rows, "fat_100g double, proteins_100g double")
    done = FeatureEngineer().transform(df)
    assert values(done, "fat_to_protein_ratio") == [2.0, 0.0, 0.0, 0.0]
    assert values(done, "calories_from_fat") == [54.0, 54.0, 54.0, 0.0]
    assert values(done, "high_fat") == [0, 0, 0, 0]
    assert "energy_density" not in done.columns


def test_switches_of_derived_columns(spark):
    df = spark.createDataFrame([(30.0, 5.0)], "fat_100g double, proteins_100g double")
    stage = FeatureEngineer(add_ratios=False, add_caloric_contributions=False)
    assert stage.transform(df).columns == ["fat_100g", "proteins_100g", "high_fat"]


def test_flags_are_strict(spark):
    df = spark.createDataFrame([(20.0,), (20.1,)], "fat_100g double")
    assert values(FeatureEngineer().transform(df), "high_fat") == [0, 1]


def test_moments(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "x double")
    s = scaling.learn_scaling(df, ["x"], "robust")["x"]
    assert s["centre"] == 3.0 and s["scale"] == pytest.approx(5.5 - 1.75)
    s = scaling.learn_scaling(df, ["x"], "standard")["x"]
    assert s["scale"] == pytest.approx(3.4910600) and s["skewness"] == pytest.approx(0.8483207)
    row = profile.describe(df, ["x"]).first()
    assert (row["q25"], row["q50"], row["q75"]) == (1.75, 3.0, 5.5)


@pytest.mark.parametrize("method", ["auto", "standard", "minmax", "robust"])
def test_constant_column_is_only_centred(spark, method):
    df = spark.createDataFrame([(5.0, "a")] * 3, "x double, y string")
    model = FeatureScaler(method=method, **ROLES).fit(df)
    assert values(model.transform(df), "x") == [0.0, 0.0, 0.0]


def test_auto_threshold_is_strict_and_nothing_is_clipped(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (0.0,), (1.0,)], "x double")
    skew = scaling.learn_scaling(df, ["x"])["x"]["skewness"]
    assert scaling.learn_scaling(df, ["x"], skew_threshold=skew)["x"]["method"] == "standard"
    model = FeatureScaler().fit(df)
    assert model.scalers == {"x": "minmax"}
    far = spark.createDataFrame([(3.0,)], "x double")
    assert values(model.transform(far), "x") == [3.0]


def test_scaler_skips_metadata_and_needs_numbers(spark):
    df = spark.createDataFrame([(1, 2.0, "a")], "y int, x double, code string")
    assert list(FeatureScaler(**ROLES).fit(df).scalers) == ["x"]
    with pytest.raises(ValueError):
        FeatureScaler(**ROLES).fit(df.select("y", "code"))


def test_missing_percent_is_rounded_before_the_strict_threshold(spark):
    def with_missing(n, total):
        return spark.range(total).select(
            F.when(F.col("id") >= n, F.lit(1.0)).alias("x"), F.lit("a").alias("y")
        )

    fit = MissingValueTransformer(threshold_drop_feature=0.95, **ROLES).fit
    assert fit(with_missing(23751, 25000)).dropped_features == []
    assert fit(with_missing(9501, 10000)).dropped_features == ["x"]


def test_fill_rules(spark):
    rows = [
        ("1", "a", 1.0, None, "s", True),
        ("2", "a", None, 3, None, None),
        ("3", "b", 4.0, 4, "t", False),
        ("4", None, 100.0, 9, "u", True),
    ]
    df = spark.createDataFrame(
        rows, "code string, y string, x double, additives_n long, s string, flag boolean"
    )
    model = MissingValueTransformer(**ROLES).fit(df)
    done = {r["code"]: r for r in model.transform(df).collect()}
    assert set(done) == {"1", "2", "3"}
    assert done["2"]["x"] == 2.5 and done["1"]["additives_n"] == 0
    assert done["2"]["s"] == "unknown" and done["2"]["flag"] is None
    report = {r["column"]: r for r in model.imputation_report(spark).collect()}
    assert report["x"]["method"] == "median" and report["additives_n"]["method"] == "constant"
    assert report["x"]["missing_count"] == 1


def test_whole_number_column_with_a_fractional_median_becomes_double(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", None)], "y string, n long")
    done = MissingValueTransformer(**ROLES).fit(df).transform(df)
    assert dict(done.dtypes)["n"] == "double" and values(done, "n")[2] == 1.5


def test_unlabelled_rows_can_be_transformed(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "y string, x double")
    new = spark.createDataFrame([(None,), (7.0,)], "x double")
    for source in ("fit", "transform"):
        model = MissingValueTransformer(stats_from=source, **ROLES).fit(df)
        assert model.transform(new).count() == 2


def test_approximate_distinct_counts(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.lit(None).cast("string").alias("z"))
    rows = {r["column"]: r for r in profile.missing_profile(df, exact_distinct=False).collect()}
    assert rows["k"]["unique_values"] == 7 and rows["z"]["unique_values"] == 0
    assert rows["z"]["missing_percentage"] == 100.0


def test_top_n_ties_by_token(spark):
    df = spark.createDataFrame([("b,a",), ("b, a ,c",), ("unknown,,",), (None,)], "t string")
    assert [r["token"] for r in top_tokens(df, "t", 1).collect()] == ["a"]
    model = FeatureEncoder(
        multilabel_cols=["t"], onehot_cols=[], target_cols=[], top_n_countries=2, **ROLES
    ).fit(df)
    rows = model.transform(df).collect()
    assert [tuple(r) for r in rows] == [(1, 1), (1, 1), (0, 0), (0, 0)]
    assert rows[0].asDict() == {"t_a": 1, "t_b": 1}


def test_one_hot_ignores_unseen_and_odd_names(spark):
    df = spark.createDataFrame([("a.b",), ("c`d",), (None,)], "g string")
    model = FeatureEncoder(
        multilabel_cols=[], onehot_cols=["g"], target_cols=[], **ROLES
    ).fit(df)
    new = spark.createDataFrame([("c`d",), ("zz",), (None,)], "g string")
    done = model.transform(new)
    assert done.columns == ["g_a.b", "g_c`d"]
    assert [tuple(r) for r in done.collect()] == [(0.0, 1.0), (0.0, 0.0), (0.0, 0.0)]
    with pytest.raises(ValueError):
        FeatureEncoder(
            multilabel_cols=[], onehot_cols=["g"], target_cols=[], max_categories=1
        ).fit(df)


def shrunk(ys, group):
    mean = sum(ys) / len(ys)
    var = sum((y - mean) ** 2 for y in ys) / len(ys)
    m = sum(group) / len(group)
    v = sum((y - m) ** 2 for y in group) / len(group)
    weight = var * len(group) / (var * len(group) + v)
    return weight * m + (1 - weight) * mean


def encoder(**settings):
    return FeatureEncoder(multilabel_cols=[], onehot_cols=[], target_cols=["g"], **settings)


def test_target_encoding_of_two_and_more_classes(spark):
    two = spark.createDataFrame(
        [("p", "n"), ("p", "y"), ("p", "y"), ("q", "n"), (None, "y")], "g string, y string"
    )
    model = encoder(**ROLES).fit(two)
    ys = [0, 1, 1, 0, 1]
    got = values(model.transform(two), "g")
    assert got[0] == pytest.approx(shrunk(ys, [0, 1, 1]))
    assert got[3] == pytest.approx(shrunk(ys, [0])) and got[4] == pytest.approx(shrunk(ys, [1]))
    unseen = spark.createDataFrame([("zz", "y")], "g string, y string")
    assert values(model.transform(unseen), "g") == [pytest.approx(0.6)]
    more = spark.createDataFrame(
        [("p", "a"), ("p", "b"), ("p", "c"), ("q", "a")], "g string, y string"
    )
    got = values(encoder(**ROLES).fit(more).transform(more), "g")
    assert got[0] == pytest.approx(shrunk([1, 0, 0, 1], [1, 0, 0]))


def test_target_encoding_without_spread_or_label(spark):
    same = spark.createDataFrame([("p", "a"), ("q", "a")], "g string, y string")
    assert values(encoder(**ROLES).fit(same).transform(same), "g") == [0.0, 0.0]
    with pytest.raises(ValueError):
        encoder(**ROLES).fit(same.drop("y"))


def test_country_cells(spark):
    cells = [
        "France, en:us,germany,france", "atlantis", "", None, "unknown", " en:de ,DEU,Deutschland",
        "usa,republic of korea", "south korea",
    ]
    df = spark.createDataFrame(list(enumerate(cells)), "i long, c string")
    got = values(clean_lists(df, "c", country_aliases(spark)).orderBy("i"), "c")
    assert got == [
        "France,Germany,United States", "unknown", "unknown", "unknown", "unknown", "Germany",
        "South Korea,United States", "South Korea",
    ]


def test_every_code_of_a_country_gives_its_name(spark):
    """Two letters, three letters and the number, with and without leading zeros, of all countries."""
    locale, region = spark._jvm.java.util.Locale, spark._jvm.com.ibm.icu.util.Region
    rows = []
    for code in locale.getISOCountries():
        number = region.getInstance(code).getNumericCode()
        rows += [(code, t) for t in (code, locale("", code).getISO3Country(), str(number), f"{number:03d}")]
    df = spark.createDataFrame(rows, "code string, cell string")
    names = collections.defaultdict(set)
    for r in clean_lists(df, "cell", country_aliases(spark)).collect():
        names[r["code"]].add(r["cell"])
    assert len(names) == 249 and all(len(n) == 1 and "unknown" not in n for n in names.values())
    assert names["BM"] == {"Bermuda"} and names["MH"] == {"Marshall Islands"}


def test_cells_with_a_large_alias_table_and_a_hot_cell(spark):
    """More aliases than any literal could hold; a third of all rows hold one cell."""
    aliases = spark.range(60_000).select(
        F.concat(F.lit("Alias-"), "id").alias("alias"), F.concat(F.lit("name "), F.col("id") % 50).alias("name")
    )
    cell = F.when(F.col("id") % 3 == 0, "alias 7,en:alias 57, nothing").otherwise(
        F.concat(F.lit("ALIAS "), F.col("id"), F.lit(",kingdom of alias "), F.col("id") + 1)
    )
    df = spark.range(3000).select("id", cell.alias("c"), F.lit(1).alias("n"), F.lit("x").alias("value"))
    found = {r["id"]: r["c"] for r in clean_lists(df, "c", aliases).collect()}
    for i in range(3000):
        wanted = {"name 7"} if i % 3 == 0 else {f"name {i % 50}", f"name {(i + 1) % 50}"}
        assert found[i] == ",".join(sorted(wanted))
    assert clean_lists(df.limit(0), "c", aliases).count() == 0
    assert clean_lists(df, "c", aliases).columns == df.columns


def test_normal_form_order(spark):
    df = spark.createDataFrame([(" EN:Saint-Lucia ",), ("en: x",)], "c string")
    assert values(df.select(text.normal_form(F.col("c")).alias("c")), "c") == ["saint lucia", " x"]


def test_component_choice():
    assert select_components([0.6, 0.3, 0.1], 0.89, None, 100) == 2
    assert select_components([0.6, 0.3, 0.0999], 1.0, None, 100) == 3
    assert select_components([0.6, 0.3, 0.1], 0.95, 2, 100) == 2
    assert select_components([0.6, 0.3, 0.1], 0.95, 9, 100) == 3
    assert select_components([0.6, 0.3, 0.1], 0.95, None, 2) == 2


def test_reduction_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 4)) @ rng.normal(size=(4, 4)) + 5
    rows = [tuple(map(float, r)) + ("a",) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y string")
    model = FeatureReducer(n_components=4, **ROLES).fit(df)
    eigenvalues = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert np.allclose(model.explained_variance_ratio(), eigenvalues / eigenvalues.sum())
    assert model.cumulative_variance()[-1] == pytest.approx(1.0)
    done = model.transform(df)
    assert done.columns == ["PC1", "PC2", "PC3", "PC4", "y"]
    scores = np.array([[r[c] for c in model.component_columns] for r in done.collect()])
    assert np.allclose(scores.mean(axis=0), 0, atol=1e-9)
    assert np.allclose(np.cov(scores.T), np.diag(eigenvalues), atol=1e-8)


def test_reduction_errors(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, y string")
    with pytest.raises(ValueError):
        FeatureReducerModel({}).explained_variance_ratio()
    with pytest.raises(ValueError):
        FeatureReducer(**ROLES).fit(df.select("y"))
    with pytest.raises(ValueError):
        FeatureReducer(**ROLES).fit(df).transform(df.select("y"))


def test_histogram_of_a_constant_and_of_nothing(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, None)], "x double, z double")
    rows = profile.histogram(df, ["x", "z"], bins=4).collect()
    assert [(r["n"], r["lower"]) for r in sorted(rows, key=lambda r: r["bin"])] == [
        (0, 4.5), (0, 4.75), (2, 5.0), (0, 5.25),
    ]


def test_float_and_decimal_columns(spark):
    df = spark.range(4).select(
        F.when(F.col("id") == 0, F.lit(math.nan)).otherwise(F.col("id")).cast("float").alias("f"),
        F.when(F.col("id") > 0, F.col("id")).cast("decimal(10,2)").alias("d"),
        F.lit("a").alias("y"),
    )
    done = MissingValueTransformer(**ROLES).fit(df).transform(df)
    assert dict(done.dtypes)["f"] == "float"
    assert sorted(values(done, "f")) == [1.0, 2.0, 2.0, 3.0]
    assert sorted(map(float, values(done, "d"))) == [1.0, 2.0, 2.0, 3.0]
    assert set(FeatureScaler(**ROLES).fit(done).scalers) == {"f", "d"}
    row = profile.missing_profile(df).where("column = 'f'").first()
    assert (row["missing_count"], row["unique_values"]) == (1, 3)

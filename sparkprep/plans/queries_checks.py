"""Queries over data-quality checks, whole fitted chains and their use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.functions.columns import col
from sparkprep.operators import forest, outliers, validation
from sparkprep.operators.encoding import FeatureEncoder
from sparkprep.operators.reduction import FeatureReducer
from sparkprep.operators.scaling import FeatureScaler, FeatureScalerModel
from sparkprep.plans import jobs
from sparkprep.plans.preparation import PreprocessingPipeline
from sparkprep.plans.product_features import DERIVED, KEY, LABEL, RANGES, table
from sparkprep.plans.queries_transform import (
    CATEGORIES,
    DERIVED_CTE,
    ENGINEER,
    IMPUTED,
    IS_A,
    ROLES,
    SCALED,
    VIOLATIONS,
    derived,
    impute_cte,
    imputed,
    skew_sql,
    target_ctes,
)
from sparkprep.plans.registry import (
    LAB,
    features,
    registered,
    rounded,
    split_ctes,
    tagged,
    union_all,
    with_pf,
)
from sparkprep.streaming.scoring import prepare_stream, read_stream
from sparkprep.workspace import land, run_path


def check(name: str, column: str, value: str, passed: str, source: str = "") -> str:
    return (
        f"SELECT '{name}' AS \"check\", '{column}' AS \"column\", "
        f"round(CAST({value} AS DOUBLE), 6) AS value, {passed} AS passed {source}"
    )


# ------------------------------------------------------------------ single checks


@registered(
    "check_retention",
    with_pf(
        union_all(
            [
                check("rows retained", "*",
                      "(SELECT COUNT(*) FROM imp) / CAST((SELECT COUNT(*) FROM pf) AS DOUBLE)", "true"),
                check("columns retained", "*", "11 / 12.0::DOUBLE", "true"),
                check("missing cells", "*", "0", "true"),
                check("label missing", "grade", "(SELECT COUNT(*) FROM imp WHERE grade IS NULL)", "true"),
            ]
        ),
        IMPUTED,
    ),
)
def check_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = validation.check_retention(features(spark, sf_dir), imputed(spark, sf_dir), LABEL)
    return rounded(found)


TYPES_AFTER = {"carb": "double", "additives_n": "bigint", "seg": "string", "high_fat": "int"}


def _type_sql(column: str, kind: str) -> str:
    """Whether every cell that SQL derives for the column is of the type."""
    name = {"double": "DOUBLE", "bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER"}[kind]
    right = f"(SELECT bool_and(typeof({column}) = '{name}') FROM eng)"
    return check("data type", column, f"CASE WHEN {right} THEN 1 ELSE 0 END", right)


@registered(
    "check_types",
    with_pf(union_all([_type_sql(c, kind) for c, kind in TYPES_AFTER.items()]), IMPUTED, DERIVED_CTE),
)
def check_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.check_types(derived(spark, sf_dir), TYPES_AFTER)


def _domain_sql(source: str) -> str:
    parts = []
    for c, (low, high) in RANGES.items():
        negative = f"(SELECT COUNT(*) FROM {source} WHERE {c} < 0)"
        outside = f"(SELECT COUNT(*) FROM {source} WHERE {c} < {low} OR {c} > {high})"
        parts.append(check("negative values", c, negative, f"{negative} = 0"))
        parts.append(check("outside range", c, outside, f"{outside} = 0"))
    missing = f"(SELECT COUNT(*) FROM {source} WHERE grade IS NULL)"
    parts.append(check("label missing", "grade", missing, f"{missing} = 0"))
    return union_all(parts)


@registered("check_domain_before", with_pf(_domain_sql("pf")))
def check_domain_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validation.check_domain(features(spark, sf_dir), RANGES, LABEL))


@registered(
    "check_domain_after",
    with_pf(_domain_sql("clean"), IMPUTED, f"clean AS (SELECT * FROM imp WHERE NOT ({VIOLATIONS}))"),
)
def check_domain_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = outliers.domain_filter(imputed(spark, sf_dir), RANGES)
    return rounded(validation.check_domain(clean, RANGES, LABEL))


@registered(
    "check_derived",
    with_pf(
        union_all(
            [
                check(name, c, f"(SELECT COUNT(*) FROM eng WHERE {test})",
                      f"(SELECT COUNT(*) FROM eng WHERE {test}) = 0")
                for c in DERIVED
                for name, test in (
                    ("null values", f"{c} IS NULL"),
                    ("infinite values", f"isinf(CAST({c} AS DOUBLE))"),
                )
            ]
        ),
        IMPUTED,
        DERIVED_CTE,
    ),
)
def check_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validation.check_derived(derived(spark, sf_dir), DERIVED))


def encoded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Split rows, and the same with categories encoded by what train holds."""
    df = tagged(spark, sf_dir)
    stage = FeatureEncoder(
        multilabel_cols=["countries"], onehot_cols=["seg"], target_cols=["nation"], **ROLES
    )
    return df, stage.fit(df.where("split_group = 'train'")).transform(df)


SEG = [f"seg_{c}" for c in CATEGORIES]
ENCODED_CTE = "encd AS (SELECT sp.* EXCLUDE (nation), " + ", ".join(
    f"CASE WHEN seg = '{c}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS seg_{c}" for c in CATEGORIES
) + (
    ", coalesce(encoding, mean) AS nation FROM sp "
    "LEFT JOIN enc ON category IS NOT DISTINCT FROM sp.nation, enc_all)"
)
TRAIN_ENCODING = target_ctes("(SELECT * FROM sp WHERE split_group = 'train') t", "nation", IS_A)


@registered(
    "check_onehot",
    with_pf(
        union_all(
            [
                check("values not 0 or 1", "seg",
                      f"(SELECT COUNT(*) FROM encd WHERE {' OR '.join(f'{c} NOT IN (0, 1)' for c in SEG)})",
                      "true"),
                check("row sums not 0 or 1", "seg",
                      f"(SELECT COUNT(*) FROM encd WHERE {' + '.join(SEG)} NOT IN (0, 1))", "true"),
                check("source removed", "seg", "1", "true"),
            ]
        ),
        LAB,
        split_ctes(),
        TRAIN_ENCODING,
        ENCODED_CTE,
    ),
)
def check_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, done = encoded(spark, sf_dir)
    return validation.check_onehot(done, "seg", [c for c in done.columns if c.startswith("seg_")])


@registered(
    "check_target_encoding",
    with_pf(
        union_all(
            [
                check("numeric", "nation", "1", "true"),
                check("minimum", "nation", "(SELECT min(nation) FROM encd)",
                      "(SELECT min(nation) FROM encd) >= 0"),
                check("maximum", "nation", "(SELECT max(nation) FROM encd)",
                      "(SELECT max(nation) FROM encd) <= 1"),
            ]
        ),
        LAB,
        split_ctes(),
        TRAIN_ENCODING,
        ENCODED_CTE,
    ),
)
def check_target_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, done = encoded(spark, sf_dir)
    return rounded(validation.check_target_encoding(done, "nation"))


def _side(function: str, c: str, train: bool) -> str:
    return f"(SELECT {function}({c}) FROM encd WHERE split_group {'=' if train else '<>'} 'train')"


MEAN_GAP = (
    "(" + " + ".join(f"abs({_side('avg', c, True)} - {_side('avg', c, False)})" for c in SEG)
    + f") / {len(SEG)}.0::DOUBLE"
)
ALL_ONES = " AND ".join(f"{_side('max', c, True)} = 1 AND {_side('max', c, False)} = 1" for c in SEG)
NATION_GAP = f"abs({_side('avg', 'nation', True)} - {_side('avg', 'nation', False)})"


@registered(
    "check_encoder_leak",
    with_pf(
        union_all(
            [
                check("encoder leak hint", "seg", MEAN_GAP, f"NOT ({MEAN_GAP} < 0.001 AND {ALL_ONES})"),
                check("encoder leak hint", "nation", NATION_GAP, f"NOT ({NATION_GAP} < 0.001)"),
            ]
        ),
        LAB,
        split_ctes(),
        TRAIN_ENCODING,
        ENCODED_CTE,
    ),
)
def check_encoder_leak(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, done = encoded(spark, sf_dir)
    groups = {"seg": [c for c in done.columns if c.startswith("seg_")], "nation": ["nation"]}
    kinds = {"seg": "onehot", "nation": "target"}
    return rounded(validation.check_encoder_leak(done, groups, "split_group", kinds))


def scaled(spark: SparkSession, sf_dir: str) -> tuple[FeatureScalerModel, DataFrame]:
    df = tagged(spark, sf_dir).select(*SCALED, "split_group", "code")
    model = FeatureScaler(method="standard", **ROLES).fit(df.where("split_group = 'train'"))
    return model, model.transform(df)


STANDARD_CTES = ", ".join(
    f"s_{c} AS (SELECT avg({c}) AS m, stddev_pop({c}) AS sd FROM sp WHERE split_group = 'train')"
    for c in SCALED
) + ", scl AS (SELECT split_group, " + ", ".join(
    f"({c} - s_{c}.m) / s_{c}.sd AS {c}" for c in SCALED
) + " FROM sp, " + ", ".join(f"s_{c}" for c in SCALED) + ")"


TRAIN_ROWS = "FROM scl WHERE split_group = 'train'"


@registered(
    "check_scaled_train",
    with_pf(
        union_all(
            [
                part
                for c in SCALED
                for part in (
                    check("train mean", c, f"(SELECT CASE WHEN abs(avg({c})) < 5e-7 THEN 0 ELSE avg({c}) END {TRAIN_ROWS})",
                          f"(SELECT abs(avg({c})) < 1e-6 {TRAIN_ROWS})"),
                    check("train deviation", c, f"(SELECT stddev_pop({c}) {TRAIN_ROWS})",
                          f"(SELECT abs(stddev_pop({c}) - 1) < 1e-6 {TRAIN_ROWS})"),
                )
            ]
        ),
        LAB,
        split_ctes(),
        STANDARD_CTES,
    ),
)
def check_scaled_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, done = scaled(spark, sf_dir)
    found = rounded(validation.check_scaled_train(done.where("split_group = 'train'"), model.scalers))
    # A mean that rounds to minus zero is zero.
    return found.withColumn("value", F.col("value") + F.lit(0.0))


@registered(
    "check_scaler_leak",
    with_pf(
        union_all(
            [
                check("scaler leak hint", c, f"CASE WHEN {near} THEN 1 ELSE 0 END", f"NOT ({near})")
                for c in SCALED
                for near in [
                    f"(SELECT abs(avg({c})) <= 0.05 AND abs(stddev_samp({c}) - 1) <= 0.02001 "
                    "FROM scl WHERE split_group = 'test')"
                ]
            ]
        ),
        LAB,
        split_ctes(),
        STANDARD_CTES,
    ),
)
def check_scaler_leak(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, done = scaled(spark, sf_dir)
    return validation.check_scaler_leak(done.where("split_group = 'test'"), model.scalers)


def _scaled_lineitem(spark: SparkSession, sf_dir: str, method: str) -> tuple[FeatureScalerModel, DataFrame]:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    stage = FeatureScaler(method=method, label="none", split_col="none", preserve_cols=["l_orderkey"])
    model = stage.fit(rows.where("l_orderkey % 2 = 0"))
    return model, model.transform(rows)


SCALED_LINEITEM = {
    "minmax": ("min({0})", "max({0}) - min({0})"),
    "robust": ("quantile_cont({0}, 0.5)", "quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25)"),
}


def _lineitem_sql(method: str, *checks: tuple[str, str, str]) -> str:
    """``checks`` (name, value, passed) of both columns, scaled with what the even orders hold."""
    columns = ["l_extendedprice", "l_quantity"]
    centre, scale = SCALED_LINEITEM[method]
    fitted = ", ".join(f"{centre.format(c)} AS c_{c}, {scale.format(c)} AS s_{c}" for c in columns)
    scaled_columns = ", ".join(f"({c} - c_{c}) / s_{c} AS {c}" for c in columns)
    return (
        f"WITH f AS (SELECT {fitted} FROM lineitem WHERE l_orderkey % 2 = 0), "
        f"scl AS (SELECT l_orderkey, {scaled_columns} FROM lineitem, f)\n"
        + union_all([check(n, c, v.format(c), p.format(c)) for c in columns for n, v, p in checks])
    )


EVEN, ODD = "FROM scl WHERE l_orderkey % 2 = 0", "FROM scl WHERE l_orderkey % 2 = 1"


@registered(
    "check_scaled_minmax",
    _lineitem_sql(
        "minmax",
        ("train minimum", f"(SELECT min({{0}}) {EVEN})", f"(SELECT abs(min({{0}})) < 1e-6 {EVEN})"),
        ("train maximum", f"(SELECT max({{0}}) {EVEN})", f"(SELECT abs(max({{0}}) - 1) < 1e-6 {EVEN})"),
        ("scaler leak hint",
         f"(SELECT CASE WHEN abs(min({{0}})) <= 0.01 AND abs(max({{0}}) - 1) <= 0.01001 THEN 1 ELSE 0 END {ODD})",
         f"(SELECT NOT (abs(min({{0}})) <= 0.01 AND abs(max({{0}}) - 1) <= 0.01001) {ODD})"),
    ),
)
def check_scaled_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both checks of columns scaled by their range."""
    model, done = _scaled_lineitem(spark, sf_dir, "minmax")
    train = validation.check_scaled_train(done.where("l_orderkey % 2 = 0"), model.scalers)
    test = validation.check_scaler_leak(done.where("l_orderkey % 2 = 1"), model.scalers)
    return rounded(train.unionByName(test)).withColumn("value", F.col("value") + F.lit(0.0))


@registered(
    "check_scaled_robust",
    _lineitem_sql(
        "robust",
        ("train median", f"(SELECT quantile_cont({{0}}, 0.5) {EVEN})",
         f"(SELECT abs(quantile_cont({{0}}, 0.5)) < 1e-6 {EVEN})"),
    ),
)
def check_scaled_robust(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, done = _scaled_lineitem(spark, sf_dir, "robust")
    found = rounded(validation.check_scaled_train(done.where("l_orderkey % 2 = 0"), model.scalers))
    return found.withColumn("value", F.col("value") + F.lit(0.0))


@registered(
    "check_same_bounds",
    with_pf(
        union_all(
            [
                check("same bounds", c, "CASE WHEN (SELECT min({0}) = min({0}) FILTER (split_group = 'train')"
                      " AND min({0}) = min({0}) FILTER (split_group <> 'train')"
                      " AND max({0}) = max({0}) FILTER (split_group = 'train')"
                      " AND max({0}) = max({0}) FILTER (split_group <> 'train') FROM sp)"
                      " THEN 1 ELSE 0 END".format(c), "true")
                for c in SCALED
            ]
        ),
        LAB,
        split_ctes(),
    ),
)
def check_same_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.check_same_bounds(tagged(spark, sf_dir), SCALED, "split_group")


# ------------------------------------------------------------------ whole chains

# Filling makes ``unknown`` a category of its own.
FILLED_CATEGORIES = [*CATEGORIES, "unknown"]
FIXED_SCALED = [
    "carb", "sugar", "fat", "protein", "salt", "additives_n", "nation",
    *[f"seg_{c}" for c in FILLED_CATEGORIES], *DERIVED,
]


CHAIN = {
    "target_col": LABEL,
    "preserve_cols": [KEY],
    "feature_engineering_kwargs": ENGINEER,
    "valid_ranges": RANGES,
    "multilabel_cols": ["countries"],
    "onehot_cols": ["seg"],
    "target_encoded_cols": ["nation"],
}


def prepared(include_pca: bool, **settings) -> PreprocessingPipeline:
    return PreprocessingPipeline(include_pca=include_pca, **{**CHAIN, **settings})


def split_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged(spark, sf_dir)


TRAIN = "(SELECT * FROM sp WHERE split_group = 'train')"


def scaled_ctes(per_table: bool = False) -> list[str]:
    """CTEs up to ``scl``: impute, filter, encode, derive and scale with what train holds.

    Train rows are filled from train; with ``per_table`` the transformed rows are filled
    from the whole table instead, while everything fitted still comes from train.
    """
    onehot = ", ".join(
        f"CASE WHEN seg = '{c}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS seg_{c}"
        for c in FILLED_CATEGORIES
    )

    def chain(source: str, filled_from: str, tag: str) -> list[str]:
        return [
            impute_cte(f"imp{tag}", source, f"{filled_from} m"),
            f"cln{tag} AS (SELECT * FROM imp{tag} WHERE NOT ({VIOLATIONS}))",
        ]

    def encode(tag: str) -> list[str]:
        return [
            f"cat{tag} AS (SELECT cln{tag}.* EXCLUDE (nation), coalesce(encoding, mean) AS nation, "
            f"{onehot} FROM cln{tag} LEFT JOIN enc ON category IS NOT DISTINCT FROM cln{tag}.nation, "
            "enc_all)",
            DERIVED_CTE.replace("FROM imp", f"FROM cat{tag}").replace("eng AS", f"eng{tag} AS"),
        ]

    whole = "(SELECT * FROM sp)" if per_table else TRAIN
    ctes = [
        LAB,
        split_ctes(),
        *chain(f"{TRAIN} t", TRAIN, "_train"),
        *chain("sp", whole, ""),
        target_ctes("cln_train", "nation", IS_A),
        *encode("_train"),
        *encode(""),
    ]
    ctes += [
        f"s_{c} AS (SELECT avg({c}) AS mean, stddev_pop({c}) AS sd, min({c}) AS lo, max({c}) AS hi, "
        f"{skew_sql(c)} AS skew FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM eng_train) v)"
        for c in FIXED_SCALED
    ]
    out = ", ".join(
        f"CASE WHEN s_{c}.lo = s_{c}.hi THEN {c} - s_{c}.lo "
        f"WHEN abs(s_{c}.skew) > 1 THEN ({c} - s_{c}.lo) / (s_{c}.hi - s_{c}.lo) "
        f"ELSE ({c} - s_{c}.mean) / s_{c}.sd END AS {c}"
        for c in FIXED_SCALED
    )
    tables = ", ".join(["eng", *[f"s_{c}" for c in FIXED_SCALED]])
    return [*ctes, f"scl AS (SELECT code, grade, split_group, {out} FROM {tables})"]


def model_ready_sql(per_table: bool = False) -> str:
    columns = ", ".join(f"round({c}, 6) AS {c}" for c in FIXED_SCALED)
    return with_pf(f"SELECT code, grade, split_group, {columns} FROM scl", *scaled_ctes(per_table))


@registered("model_ready_table", model_ready_sql())
def model_ready_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = prepared(include_pca=False).fit_transform(split_landed(spark, sf_dir))
    return rounded(done.select("code", LABEL, "split_group", *[col(c) for c in FIXED_SCALED]))


@registered("model_ready_per_table", model_ready_sql(per_table=True))
def model_ready_per_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each transformed table is filled from itself, the rest is fitted on train."""
    chain = prepared(include_pca=False, stats_from="transform")
    done = chain.fit_transform(split_landed(spark, sf_dir))
    return rounded(done.select("code", LABEL, "split_group", *[col(c) for c in FIXED_SCALED]))


@registered(
    "model_ready_norms",
    with_pf(
        "SELECT code, grade, split_group, round("
        + " + ".join(f"pow({c} - m_{c}, 2)" for c in FIXED_SCALED)
        + ", 4) AS squared_norm FROM scl, (SELECT "
        + ", ".join(f"avg({c}) AS m_{c}" for c in FIXED_SCALED)
        + " FROM scl WHERE split_group = 'train') m",
        *scaled_ctes(),
    ),
)
def model_ready_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With all of the variance kept, components keep each row's distance from the train mean."""
    chain = prepared(include_pca=True, multilabel_cols=[], pca_variance_threshold=1.0)
    done = chain.fit_transform(split_landed(spark, sf_dir))
    norm = F.lit(0.0)
    for c in chain.get_transformer("pca").component_columns:
        norm = norm + col(c) * col(c)
    return done.select("code", LABEL, "split_group", F.round(norm, 4).alias("squared_norm"))


@registered(
    "check_first_component",
    with_pf(
        union_all(
            [
                check("train mean", "PC1", "0", "true"),
                check("train deviation", "PC1", "(SELECT sqrt(l1) FROM ax)", "true"),
                check("test mean", "PC1", "(SELECT avg(pc) FROM sc WHERE split_group = 'test')", "true"),
                check("test deviation", "PC1",
                      "(SELECT stddev_samp(pc) FROM sc WHERE split_group = 'test')", "true"),
            ]
        ),
        LAB,
        split_ctes(),
        """m AS (SELECT avg(fat) AS mx, avg(protein) AS my, var_samp(fat) AS a, var_samp(protein) AS c,
  covar_samp(fat, protein) AS b FROM sp WHERE split_group = 'train'),
e AS (SELECT *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS l1 FROM m),
n AS (SELECT *, b / sqrt(b * b + pow(l1 - a, 2)) AS ux, (l1 - a) / sqrt(b * b + pow(l1 - a, 2)) AS uy
  FROM e),
ax AS (SELECT *, CASE WHEN (abs(ux) >= abs(uy) AND ux < 0) OR (abs(ux) < abs(uy) AND uy < 0)
    THEN -1 ELSE 1 END AS s1 FROM n),
sc AS (SELECT split_group, s1 * ((fat - mx) * ux + (protein - my) * uy) AS pc FROM sp, ax)""",
    ),
)
def check_first_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns, whose first axis has a closed form, fitted on train."""
    df = tagged(spark, sf_dir).select("code", "grade", "split_group", "fat", "protein")
    model = FeatureReducer(n_components=1, **ROLES).fit(df.where("split_group = 'train'"))
    found = rounded(validation.check_first_component(model.transform(df), "split_group"))
    # A mean that rounds to minus zero is zero.
    return found.withColumn("value", F.col("value") + F.lit(0.0))


@registered("model_ready_components")
def model_ready_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(include_pca=True).fit_transform(split_landed(spark, sf_dir))


@registered("model_ready_reloaded", model_ready_sql())
def model_ready_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted chain, saved and loaded again."""
    df = split_landed(spark, sf_dir)
    path = run_path(spark, "chain")
    prepared(include_pca=False).fit(df).save(path)
    done = PreprocessingPipeline.load(path).transform(df)
    return rounded(done.select("code", LABEL, "split_group", *[col(c) for c in FIXED_SCALED]))


@registered("model_ready_stream", model_ready_sql())
def model_ready_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted chain applied to a stream of files in two runs into one output."""
    path, target, checkpoint = (run_path(spark, n) for n in ("split", "scored", "stream"))
    df = split_landed(spark, sf_dir)
    chain = prepared(include_pca=False).fit(df)
    for part in ("code % 2 = 0", "code % 2 = 1"):
        df.where(part).write.mode("append").parquet(path)
        rows = read_stream(spark, path, df.schema)
        prepare_stream(chain.model, rows, target, checkpoint).awaitTermination()
    done = spark.read.parquet(target)
    return rounded(done.select("code", LABEL, "split_group", *[col(c) for c in FIXED_SCALED]))


@registered("model_ready_job", model_ready_sql())
def model_ready_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end-to-end job: the table it writes, and the chain it saves applied to the rest of the rows."""
    path, target, saved = (run_path(spark, n) for n in ("split", "ready", "chain"))
    split_landed(spark, sf_dir).write.parquet(path)
    jobs.prepare_dataset(spark, path, target, saved, **CHAIN, include_pca=False)
    written = spark.read.parquet(target).where("code % 2 = 0")
    again = PreprocessingPipeline.load(saved).transform(spark.read.parquet(path).where("code % 2 = 1"))
    done = written.unionByName(again)
    return rounded(done.select("code", LABEL, "split_group", *[col(c) for c in FIXED_SCALED]))


@registered(
    "outlier_report_totals",
    with_pf(
        """SELECT (SELECT COUNT(*) FROM sp) AS rows_before, (SELECT COUNT(*) FROM cln) AS rows_after,
  (SELECT COUNT(*) FROM sp) - (SELECT COUNT(*) FROM cln) AS rows_removed""",
        LAB,
        split_ctes(),
        impute_cte("imp", "sp", "(SELECT * FROM sp WHERE split_group = 'train') m"),
        f"cln AS (SELECT * FROM imp WHERE NOT ({VIOLATIONS}))",
    ),
)
def outlier_report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = split_landed(spark, sf_dir)
    chain = prepared(include_pca=False).fit(df)
    filled = chain.get_transformer("missing_values").transform(df)
    totals = chain.get_transformer("outlier_removal").outlier_report(filled)["totals"]
    return totals.select("rows_before", "rows_after", "rows_removed")


@registered("check_reduction")
def check_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = split_landed(spark, sf_dir)
    chain = prepared(include_pca=True).fit(df)
    before = df
    for stage in chain.model.stages[:-1]:
        before = stage.transform(before)
    model = chain.get_transformer("pca")
    return validation.check_reduction(model, before, model.transform(before), LABEL, "split_group")


@registered(
    "check_columns",
    with_pf(
        union_all(
            [
                check("column present", c, f"CASE WHEN {some} THEN 1 ELSE 0 END", some)
                for c in (LABEL, "split_group", KEY)
                for some in [f"(SELECT COUNT({c}) > 0 FROM sp)"]
            ]
        ),
        LAB,
        split_ctes(),
    ),
)
def check_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = prepared(include_pca=True).fit_transform(split_landed(spark, sf_dir))
    return validation.check_columns(done, [LABEL, "split_group", KEY])


@registered("forest_accuracy")
def forest_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = split_landed(spark, sf_dir)
    chain = prepared(include_pca=True).fit(df)
    original = df
    for stage in chain.model.stages[:-1]:
        original = stage.transform(original)
    original = land(original, "encoded")
    reduced = land(chain.get_transformer("pca").transform(original), "components")
    return forest.compare_forests(original, reduced, LABEL, "split_group", exclude=[KEY])

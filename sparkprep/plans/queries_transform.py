"""Queries over imputation, filters, encodings, scaling and reduction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.functions import text
from sparkprep.functions.columns import col
from sparkprep.functions.countries import country_aliases, country_table
from sparkprep.operators import encoding, outliers, scaling
from sparkprep.operators.derived import FeatureEngineer
from sparkprep.operators.dictionary import resolve_tokens
from sparkprep.operators.encoding import FeatureEncoder
from sparkprep.operators.missing import MissingValueTransformer
from sparkprep.operators.outliers import OutlierRemovalTransformer
from sparkprep.operators.reduction import FeatureReducer
from sparkprep.operators.scaling import FeatureScaler
from sparkprep.plans import jobs
from sparkprep.plans.product_features import (
    CONTRIBUTIONS,
    DENSITIES,
    DERIVED,
    FLAGS,
    KEY,
    LABEL,
    RANGES,
    RATIOS,
    product_features,
    table,
)
from sparkprep.plans.registry import (
    LAB,
    bad,
    features,
    labelled,
    registered,
    rounded,
    split_ctes,
    tagged,
    union_all,
    with_pf,
)
from sparkprep.sources.reports import read_report
from sparkprep.workspace import run_path

ROLES = {"label": LABEL, "split_col": "split_group", "preserve_cols": [KEY]}
FILLED = {
    "seg": "'unknown'", "nation": "'unknown'", "countries": "'unknown'", "additives_n": "0",
}
MEDIAN_FILLED = ["carb", "sugar", "fat", "protein", "salt"]
CATEGORIES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


# ------------------------------------------------------------------ missing values


def impute_cte(name: str, source: str, fitted_on: str) -> str:
    fills = [f"coalesce({c}, {v}) AS {c}" for c, v in FILLED.items()]
    fills += [
        f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM {fitted_on})) AS {c}"
        for c in MEDIAN_FILLED
    ]
    return (
        f"{name} AS (SELECT * EXCLUDE (sparse_col) REPLACE ({', '.join(fills)}) "
        f"FROM {source} WHERE grade IS NOT NULL)"
    )


IMPUTED = impute_cte("imp", "pf", "(SELECT * FROM pf WHERE grade IS NOT NULL) m")
NUMBERS = ", ".join(f"round({c}, 6) AS {c}" for c in MEDIAN_FILLED)


def imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features(spark, sf_dir)
    return MissingValueTransformer(**ROLES).fit(df).transform(df)


@registered(
    "drop_sparse_columns",
    with_pf(
        "SELECT code, grade, seg, nation, countries, "
        + ", ".join(f"round({c}, 6) AS {c}" for c in MEDIAN_FILLED)
        + ", additives_n FROM pf WHERE grade IS NOT NULL"
    ),
)
def drop_sparse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features(spark, sf_dir)
    model = MissingValueTransformer(**ROLES).fit(df)
    return rounded(df.drop(*model.dropped_features).where(col(LABEL).isNotNull()))


@registered(
    "impute",
    with_pf(
        f"SELECT code, grade, seg, nation, countries, {NUMBERS}, additives_n FROM imp", IMPUTED
    ),
)
def impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(imputed(spark, sf_dir))


@registered(
    "impute_from_train",
    with_pf(
        f"SELECT code, grade, split_group, seg, nation, countries, {NUMBERS}, additives_n FROM imp",
        LAB,
        split_ctes(),
        impute_cte("imp", "sp", "(SELECT * FROM sp WHERE split_group = 'train') m"),
    ),
)
def impute_from_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = tagged(spark, sf_dir)
    model = MissingValueTransformer(stats_from="fit", **ROLES).fit(
        df.where("split_group = 'train'")
    )
    return rounded(model.transform(df))


@registered(
    "impute_per_table",
    with_pf(
        f"SELECT code, grade, split_group, seg, nation, countries, {NUMBERS}, additives_n FROM imp",
        LAB,
        split_ctes(),
        impute_cte("imp", "(SELECT * FROM sp WHERE split_group = 'test') s",
                   "(SELECT * FROM sp WHERE split_group = 'test') m"),
    ),
)
def impute_per_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on train, but each transformed table is filled from itself."""
    df = tagged(spark, sf_dir)
    model = MissingValueTransformer(stats_from="transform", **ROLES).fit(
        df.where("split_group = 'train'")
    )
    return rounded(model.transform(df.where("split_group = 'test'")))


def _report_sql() -> str:
    def percent(c: str) -> str:
        return (
            f"CAST(round_even((SELECT COUNT(*) - COUNT({c}) FROM pf) / CAST((SELECT COUNT(*) FROM pf)"
            " AS DOUBLE) * 100.0 * 100.0, 0) AS DOUBLE) / 100.0"
        )

    parts = [
        f"""SELECT 'sparse_col' AS "column", 'drop' AS method, CAST(NULL AS VARCHAR) AS value,
  (SELECT COUNT(*) - COUNT(sparse_col) FROM pf) AS missing_count,
  {percent('sparse_col')} AS missing_percentage, 'too sparse' AS rationale"""
    ]
    for c in ("carb", "sugar"):
        parts.append(
            f"""SELECT '{c}', 'median', CAST(quantile_cont({c}, 0.5) AS VARCHAR),
  COUNT(*) - COUNT({c}), {percent(c)}, 'median of the column' FROM lab"""
        )
    parts.append(
        f"""SELECT 'additives_n', 'constant', '0.0', COUNT(*) - COUNT(additives_n),
  {percent('additives_n')}, 'absent means none' FROM lab"""
    )
    for c in ("seg", "nation"):
        parts.append(
            f"""SELECT '{c}', 'constant', 'unknown', COUNT(*) - COUNT({c}), {percent(c)},
  'placeholder category' FROM lab"""
        )
    return union_all(parts)


@registered("imputation_report", with_pf(_report_sql(), LAB))
def imputation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MissingValueTransformer(**ROLES).fit(features(spark, sf_dir)).imputation_report(spark)


# ------------------------------------------------------------------ outliers

VIOLATIONS = " OR ".join(bad(c, *r) for c, r in RANGES.items())
KEPT = f"kept AS (SELECT * FROM pf WHERE NOT ({VIOLATIONS}))"
FENCES = "fences AS (SELECT " + ", ".join(
    f"least(quantile_cont({c}, 0.75) + 3 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)), "
    f"{high}) AS f_{c}"
    for c, (_, high) in RANGES.items()
) + " FROM kept)"
ABOVE = {c: f"coalesce({c} > f_{c}, false)" for c in RANGES}


@registered("domain_filter", with_pf("SELECT code, grade FROM kept", KEPT))
def domain_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.domain_filter(product_features(spark, sf_dir), RANGES).select("code", "grade")


@registered(
    "iqr_filter",
    with_pf(
        f"SELECT code, grade FROM kept, fences WHERE NOT ({' OR '.join(ABOVE.values())})",
        KEPT,
        FENCES,
    ),
)
def iqr_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features(spark, sf_dir)
    stage = OutlierRemovalTransformer(
        valid_ranges=RANGES, remove_statistical_outliers=True, stats_from="transform", **ROLES
    )
    return stage.fit(df).transform(df).select("code", "grade")


@registered(
    "iqr_filter_lineitem",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1,
  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem WHERE l_extendedprice <= 60000)
SELECT l_orderkey, l_linenumber, round(l_extendedprice, 6) AS l_extendedprice FROM lineitem, q
WHERE l_extendedprice >= 0 AND l_extendedprice <= 60000
  AND l_extendedprice <= least(q3 + 0.25 * (q3 - q1), 60000)""",
)
def iqr_filter_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem")
    stage = OutlierRemovalTransformer(
        valid_ranges={"l_extendedprice": (0, 60_000)},
        remove_statistical_outliers=True,
        iqr_factor=0.25,
    )
    return rounded(
        stage.fit(df).transform(df).select("l_orderkey", "l_linenumber", "l_extendedprice")
    )


def _reasons_sql(with_fences: bool) -> str:
    parts, earlier = [], []
    for c, r in RANGES.items():
        before = f" AND NOT ({' OR '.join(earlier)})" if earlier else ""
        domain = f"(SELECT COUNT(*) FROM pf WHERE {bad(c, *r)}{before})"
        fence = f"(SELECT COUNT(*) FROM kept, fences WHERE {ABOVE[c]})" if with_fences else "0"
        parts.append(
            f"""SELECT '{c}' AS "column", CASE WHEN {domain} = 0 THEN {fence} ELSE {domain} END AS count,
  CASE WHEN {domain} = 0 THEN 'above statistical fence' ELSE 'outside valid range' END AS reason"""
        )
        earlier.append(bad(c, *r))
    return f"SELECT * FROM ({union_all(parts)}) t WHERE count > 0"


@registered("outlier_reasons", with_pf(_reasons_sql(False), KEPT, FENCES))
def outlier_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.removal_reasons(product_features(spark, sf_dir), RANGES)


@registered("outlier_reasons_iqr", with_pf(_reasons_sql(True), KEPT, FENCES))
def outlier_reasons_iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features(spark, sf_dir)
    fences = outliers.upper_fences(outliers.domain_filter(df, RANGES), RANGES)
    return outliers.removal_reasons(df, RANGES, fences)


REMOVAL_TOTALS = with_pf(
    f"""SELECT n AS rows_before, k AS rows_after, n - k AS rows_removed,
  CAST(round_even((n - k) / CAST(n AS DOUBLE) * 100.0 * 100.0, 0) AS DOUBLE) / 100.0 AS removal_percentage
FROM (SELECT COUNT(*) AS n FROM pf) a,
     (SELECT COUNT(*) AS k FROM kept, fences WHERE NOT ({' OR '.join(ABOVE.values())})) b""",
    KEPT,
    FENCES,
)


@registered("removal_totals", REMOVAL_TOTALS)
def removal_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features(spark, sf_dir)
    stage = OutlierRemovalTransformer(
        valid_ranges=RANGES, remove_statistical_outliers=True, **ROLES
    )
    return stage.fit(df).outlier_report(df)["totals"]


@registered("outlier_report_files", REMOVAL_TOTALS)
def outlier_report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's written report, and the rows of its written table."""
    path, target, report = (run_path(spark, n) for n in ("features", "cleaned", "outliers"))
    features(spark, sf_dir).write.parquet(path)
    kept = jobs.remove_outliers(
        spark, path, target, report, valid_ranges=RANGES, remove_statistical_outliers=True, **ROLES
    )
    totals = read_report(spark, f"{report}/totals")
    return totals.select(
        "rows_before", F.lit(kept.count()).alias("rows_after"), "rows_removed", "removal_percentage"
    )


# ------------------------------------------------------------------ multi-valued text

# Spellings a raw cell may hold for each nation key, and the names they resolve to.
SPELLINGS = {
    0: ("\ten:france\n", "France"), 1: ("Deutschland", "Germany"), 2: (" USA ", "United States"),
    3: ("en:united-kingdom", "United Kingdom"), 4: ("Kingdom of Spain", "Spain"), 5: ("it", "Italy"),
    6: ("Nederland", "Netherlands"), 7: ("056", "Belgium"), 8: ("suisse", "Switzerland"),
    9: ("CZE", "Czechia"), 10: ("Republic of Poland\n", "Poland"), 11: ("Sverige", "Sweden"),
    12: ("norge", "Norway"), 13: ("russia", "Russian Federation"), 14: ("JP", "Japan"),
    15: ("\n en:china", "China"), 16: ("brasil", "Brazil"), 17: ("French Republic", "France"),
    18: ("250", "France"), 19: ("United States of America", "United States"), 20: ("vietnam", "Viet Nam"),
    21: ("narnia", None), 22: ("\tunknown", None), 23: ("", None), 24: ("en:en:south-africa", "South Africa"),
}


def raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw, comma-joined country cell per order, as its supplier nations are spelled."""
    pairs = [x for k, (raw, _) in SPELLINGS.items() for x in (F.lit(k), F.lit(raw))]
    spelled = F.try_element_at(F.create_map(*pairs), F.col("s_nationkey"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("l_orderkey").alias("code"))
        .agg(F.array_join(F.array_sort(F.collect_set(spelled)), ",").alias("cell"))
    )


def _values(rows: list[tuple]) -> str:
    def literal(x) -> str:
        return "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x + "'"

    return ", ".join("(" + ", ".join(literal(x) for x in r) + ")" for r in rows)


SPELLED = f"spelled(k, raw, name) AS (VALUES {_values([(k, r, n) for k, (r, n) in SPELLINGS.items()])})"
RAW = """raw AS (SELECT l_orderkey AS code, raw, any_value(name) AS name FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey JOIN spelled ON k = s_nationkey
  GROUP BY l_orderkey, raw)"""


@registered(
    "clean_multivalue",
    f"""WITH {SPELLED}, {RAW}
SELECT code, coalesce(string_agg(DISTINCT name, ',' ORDER BY name), 'unknown') AS countries
FROM raw GROUP BY code""",
)
def clean_multivalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = raw_cells(spark, sf_dir).withColumnRenamed("cell", "countries")
    return jobs.clean_countries(cells)


@registered(
    "country_lookup",
    f"""WITH {SPELLED}, {RAW}
SELECT raw, any_value(name) AS name, COUNT(*) AS n FROM raw GROUP BY raw""",
)
def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_cells(spark, sf_dir).select(F.explode(F.split("cell", ",")).alias("token"))
    counted = raw.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    known = resolve_tokens(counted, country_aliases(spark)).select("token", "name")
    return counted.join(known, "token", "left").select(F.col("token").alias("raw"), "name", "n")


# Numeric codes that some cells hold, of states and of territories, and the names they resolve to.
NUMERIC_CODES = {
    "004": "Afghanistan", "010": "Antarctica", "016": "American Samoa", "020": "Andorra", "060": "Bermuda",
    "090": "Solomon Islands", "136": "Cayman Islands", "162": "Christmas Island", "175": "Mayotte",
    "184": "Cook Islands", "234": "Faroe Islands", "254": "French Guiana", "258": "French Polynesia",
    "292": "Gibraltar", "304": "Greenland", "312": "Guadeloupe", "316": "Guam", "474": "Martinique",
    "500": "Montserrat", "533": "Aruba", "540": "New Caledonia", "548": "Vanuatu", "570": "Niue",
    "574": "Norfolk Island", "580": "Northern Mariana Islands", "584": "Marshall Islands", "585": "Palau",
    "630": "Puerto Rico", "660": "Anguilla", "732": "Western Sahara", "772": "Tokelau", "798": "Tuvalu",
    "831": "Guernsey", "832": "Jersey", "833": "Isle of Man", "894": "Zambia", "999": None, "000": None,
}


@registered(
    "country_numeric_codes",
    f"""WITH codes(raw, name) AS (VALUES {_values(list(NUMERIC_CODES.items()))}),
cells AS (SELECT l_orderkey, lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') AS raw FROM lineitem)
SELECT l_orderkey AS code, coalesce(string_agg(DISTINCT name, ',' ORDER BY name), 'unknown') AS countries
FROM cells JOIN codes USING (raw) GROUP BY l_orderkey""",
)
def country_numeric_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of numeric codes, one per order line, resolved by the alias table as it is kept between runs."""
    path = run_path(spark, "countries")
    country_table(spark).write.parquet(path)
    code = F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0")
    lines = table(spark, sf_dir, "lineitem").where(code.isin(list(NUMERIC_CODES)))
    cells = lines.groupBy(F.col("l_orderkey").alias("code")).agg(F.array_join(F.collect_list(code), ",").alias("countries"))
    return jobs.clean_countries(cells, aliases=spark.read.parquet(path))


@registered(
    "normal_form",
    f"""WITH {SPELLED}
SELECT s_suppkey, replace(replace(trim(lower(raw), ' ' || chr(9) || chr(10)), 'en:', ''), '-', ' ') AS name
FROM supplier JOIN spelled ON k = s_nationkey""",
)
def normal_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = [x for k, (raw, _) in SPELLINGS.items() for x in (F.lit(k), F.lit(raw))]
    spelled = F.try_element_at(F.create_map(*pairs), F.col("s_nationkey"))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", text.normal_form(spelled).alias("name")
    )


# ------------------------------------------------------------------ encodings

TOKENS = """tok AS (SELECT code, UNNEST(string_split(countries, ',')) AS token FROM pf),
top AS (SELECT token, COUNT(*) AS n FROM tok GROUP BY token ORDER BY n DESC, token LIMIT 15)"""


@registered("top_tokens", with_pf("SELECT token, n FROM top", TOKENS))
def top_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.top_tokens(product_features(spark, sf_dir), "countries", 15)


@registered(
    "frequent_tokens",
    """WITH t AS (SELECT lower(UNNEST(regexp_extract_all(text, '[^ ,\n]+'))) AS token FROM documents)
SELECT token, COUNT(*) AS n FROM t WHERE token <> 'unknown' GROUP BY token ORDER BY n DESC, token LIMIT 25""",
)
def frequent_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents as the tokens of a multi-valued column."""
    cells = table(spark, sf_dir, "documents").select(
        F.array_join(F.split(F.lower("text"), "[ ,\n]+"), ",").alias("cell")
    )
    return encoding.frequent_tokens(cells, "cell", 25)


@registered(
    "token_cells",
    """WITH cells AS (
  SELECT chr(9) || n_name || ', unknown,' || n_name || chr(10) || ',,' || r_name AS cell
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
t AS (SELECT trim(UNNEST(string_split(cell, ',')), ' ' || chr(9) || chr(10)) AS token FROM cells)
SELECT token, COUNT(*) AS n FROM t WHERE token NOT IN ('', 'unknown') GROUP BY token
ORDER BY n DESC, token LIMIT 20""",
)
def token_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that repeat a token and hold tabs, line breaks, empty and unknown tokens."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    cell = F.concat(F.lit("\t"), "n_name", F.lit(", unknown,"), "n_name", F.lit("\n,,"), "r_name")
    return encoding.top_tokens(rows.select(cell.alias("cell")), "cell", 20)


def _encoded_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_partkey") % 4 == 0, F.col("p_type"))
        .when(F.col("l_partkey") % 97 != 1, F.concat(F.lit("part"), F.col("l_partkey") % 1000))
        .alias("part"),
        "l_returnflag",
    )


@registered(
    "target_encode_skewed",
    """WITH d AS (
  SELECT l_orderkey, l_linenumber, l_returnflag,
         CASE WHEN l_partkey % 4 = 0 THEN p_type
              WHEN l_partkey % 97 <> 1 THEN 'part' || (l_partkey % 1000) END AS part
  FROM lineitem JOIN part ON l_partkey = p_partkey),
f AS (SELECT part, CASE WHEN l_returnflag = (SELECT min(l_returnflag) FROM d) THEN 1.0 ELSE 0.0 END AS y
      FROM d WHERE l_orderkey % 3 <> 0 AND (part IS NULL OR part NOT LIKE 'part1%')),
g AS (SELECT avg(y) AS m, var_pop(y) AS v FROM f),
e AS (SELECT part, COUNT(*) AS n, avg(y) AS m, var_pop(y) AS v FROM f GROUP BY part)
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN e.n IS NULL THEN g.m
                  ELSE g.v * e.n / (g.v * e.n + e.v) * e.m + (1 - g.v * e.n / (g.v * e.n + e.v)) * g.m END, 6) AS part
FROM d CROSS JOIN g LEFT JOIN e ON d.part IS NOT DISTINCT FROM e.part""",
)
def target_encode_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot, rare, missing and unseen categories by shuffle joins, fitted on some of the rows."""
    rows = _encoded_parts(spark, sf_dir)
    seen = F.coalesce(~F.col("part").startswith("part1"), F.lit(True))
    stage = FeatureEncoder(
        multilabel_cols=[], onehot_cols=[], target_cols=["part"], label="l_returnflag", preserve_cols=[]
    )
    model = stage.fit(rows.where((F.col("l_orderkey") % 3 != 0) & seen))
    model.tables = {c: t.hint("merge") for c, t in model.tables.items()}
    return rounded(model.transform(rows).select("l_orderkey", "l_linenumber", "part"))


@registered(
    "categories", with_pf("SELECT DISTINCT seg AS category FROM pf WHERE seg IS NOT NULL")
)
def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.categories(product_features(spark, sf_dir), "seg")


def _long(df: DataFrame, columns: list[str], prefix: str) -> DataFrame:
    """(code, feature, value) of the encoded columns, for a fixed schema."""
    pairs = [
        F.struct(F.lit(c[len(prefix):]).alias("feature"), col(c).alias("value")) for c in columns
    ]
    return df.select("code", F.inline(F.array(*pairs)))


@registered(
    "multilabel_encode",
    with_pf(
        """SELECT code, token AS feature,
  CAST(list_contains(string_split(countries, ','), token) AS INT) AS value FROM pf, top""",
        TOKENS,
    ),
)
def multilabel_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features(spark, sf_dir)
    model = FeatureEncoder(
        multilabel_cols=["countries"], onehot_cols=[], target_cols=[], **ROLES
    ).fit(df)
    done = model.transform(df)
    return _long(done, [c for c in done.columns if c.startswith("countries_")], "countries_")


@registered(
    "onehot_encode",
    with_pf(
        """SELECT code, cat AS feature, CASE WHEN seg = cat THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
FROM pf, (SELECT DISTINCT seg AS cat FROM pf WHERE seg IS NOT NULL) c"""
    ),
)
def onehot_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features(spark, sf_dir)
    model = FeatureEncoder(
        multilabel_cols=[], onehot_cols=["seg"], target_cols=[], **ROLES
    ).fit(df)
    done = model.transform(df)
    return _long(done, [c for c in done.columns if c.startswith("seg_")], "seg_")


def target_ctes(source: str, category: str, y: str, out: str = "enc") -> str:
    """CTE ``out`` (category, encoding) and ``out_all`` (mean) for a numeric target."""
    return f"""{out}_y AS (SELECT {category} AS category, CAST({y} AS DOUBLE) AS y FROM {source}),
{out}_all AS (SELECT avg(y) AS mean, var_pop(y) AS v FROM {out}_y),
{out}_stats AS (SELECT category, COUNT(*) AS n, avg(y) AS m, var_pop(y) AS cv FROM {out}_y GROUP BY category),
{out} AS (SELECT category, CASE WHEN v * n + cv = 0 THEN mean
    ELSE v * n / (v * n + cv) * m + (1 - v * n / (v * n + cv)) * mean END AS encoding
  FROM {out}_stats, {out}_all)"""


IS_A = "CASE WHEN grade = 'a' THEN 1 ELSE 0 END"


@registered(
    "target_statistics",
    with_pf(
        f"""SELECT category, COUNT(*) AS n, round(avg(y), 6) AS mean, round(var_pop(y), 6) AS variance
FROM (SELECT nation AS category, CAST({IS_A} AS DOUBLE) AS y FROM lab) t GROUP BY category""",
        LAB,
    ),
)
def target_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = labelled(spark, sf_dir)
    return rounded(
        encoding.target_statistics(df, "nation", encoding.label_target(df, LABEL))
    )


@registered(
    "target_encode",
    with_pf(
        """SELECT code, split_group, round(coalesce(encoding, mean), 6) AS nation
FROM sp LEFT JOIN enc ON category IS NOT DISTINCT FROM nation, enc_all""",
        LAB,
        split_ctes(),
        target_ctes("(SELECT * FROM sp WHERE split_group = 'train') t", "nation", IS_A),
    ),
)
def target_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five classes: the first one counts as 1. Fitted on train."""
    df = tagged(spark, sf_dir)
    model = FeatureEncoder(
        multilabel_cols=[], onehot_cols=[], target_cols=["nation"], **ROLES
    ).fit(df.where("split_group = 'train'"))
    return rounded(model.transform(df).select("code", "split_group", "nation"))


@registered(
    "target_encode_binary",
    f"""WITH d AS (SELECT d.doc_id, d.source, d.lang, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
{target_ctes("(SELECT * FROM d WHERE quality IS NOT NULL) t", "source", "quality")}
SELECT doc_id, lang, round(coalesce(encoding, mean), 6) AS source
FROM d LEFT JOIN enc ON category = source, enc_all""",
)
def target_encode_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two classes: the second one counts as 1. Documents without label are only encoded."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    df = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    model = FeatureEncoder(
        multilabel_cols=[], onehot_cols=[], target_cols=["source"], label="quality",
        preserve_cols=["doc_id"],
    ).fit(df.where("quality IS NOT NULL"))
    return rounded(model.transform(df).select("doc_id", "lang", "source"))


@registered(
    "target_encode_continuous",
    f"""WITH {target_ctes("orders", "o_custkey", "o_totalprice")}
SELECT o_orderkey, round(encoding, 4) AS customer
FROM orders JOIN enc ON category = o_custkey""",
)
def target_encode_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A continuous label over many categories: each customer by the order price."""
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer"), "o_totalprice"
    )
    model = FeatureEncoder(
        multilabel_cols=[], onehot_cols=[], target_cols=["customer"], label="o_totalprice",
        preserve_cols=["o_orderkey"],
    ).fit(df)
    done = model.transform(df)
    return done.select("o_orderkey", F.round("customer", 4).alias("customer"))


# ------------------------------------------------------------------ derived columns

DERIVED_CTE = "eng AS (SELECT *, " + ", ".join(
    [
        f"coalesce(CASE WHEN {d} <> 0 THEN {n} / {d} END, 0.0) AS {name}" for name, n, d in RATIOS
    ]
    + [f"coalesce({c} / {d}, 0.0) AS {name}" for name, c, d in DENSITIES]
    + [f"coalesce({c} * {f}, 0.0) AS {name}" for name, c, f in CONTRIBUTIONS]
    + [f"CAST(coalesce({c} > {t}, false) AS INT) AS {name}" for name, c, t in FLAGS]
) + " FROM imp)"

ENGINEER = {
    "ratios": RATIOS, "densities": DENSITIES, "contributions": CONTRIBUTIONS, "flags": FLAGS,
}


def derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FeatureEngineer(**ENGINEER).transform(imputed(spark, sf_dir))


DERIVED_OUT = ", ".join(
    d if d in [f[0] for f in FLAGS] else f"round({d}, 6) AS {d}" for d in DERIVED
)


@registered(
    "derived_features", with_pf(f"SELECT code, {DERIVED_OUT} FROM eng", IMPUTED, DERIVED_CTE)
)
def derived_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(derived(spark, sf_dir).select("code", *DERIVED))


@registered(
    "derived_from_nulls",
    with_pf(
        f"SELECT code, {DERIVED_OUT} FROM eng",
        "imp AS (SELECT * FROM pf)",
        DERIVED_CTE,
    ),
)
def derived_from_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without imputation: missing sources give 0."""
    done = FeatureEngineer(**ENGINEER).transform(product_features(spark, sf_dir))
    return rounded(done.select("code", *DERIVED))


# ------------------------------------------------------------------ scaling

SCALED = ["carb", "sugar", "fat", "protein", "salt", "additives_n"]


def skew_sql(c: str) -> str:
    return (
        f"(avg({c} * {c} * {c}) - 3 * avg({c}) * var_pop({c}) - pow(avg({c}), 3))"
        f" / pow(stddev_pop({c}), 3)"
    )


def _scaled_sql(c: str, method: str, source: str) -> str:
    """Scaled value of one column as an SQL scalar over the statistics row ``s_<c>``."""
    standard = f"({c} - s_{c}.mean) / s_{c}.sd"
    minmax = f"({c} - s_{c}.lo) / (s_{c}.hi - s_{c}.lo)"
    robust = f"({c} - s_{c}.q2) / CASE WHEN s_{c}.q3 = s_{c}.q1 THEN 1 ELSE s_{c}.q3 - s_{c}.q1 END"
    auto = f"CASE WHEN abs(s_{c}.skew) > 1 THEN {minmax} ELSE {standard} END"
    chosen = {"standard": standard, "minmax": minmax, "robust": robust, "auto": auto}[method]
    return f"round({chosen}, 6) AS {c}"


def _statistics_sql(c: str, source: str) -> str:
    return (
        f"(SELECT avg({c}) AS mean, stddev_pop({c}) AS sd, min({c}) AS lo, max({c}) AS hi, "
        f"quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, "
        f"quantile_cont({c}, 0.75) AS q3, {skew_sql(c)} AS skew "
        f"FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM {source}) v) s_{c}"
    )


def scale_sql(source: str, key: str, columns: list[str], method: str) -> str:
    return (
        f"SELECT {key}, " + ", ".join(_scaled_sql(c, method, source) for c in columns)
        + f" FROM {source}, " + ", ".join(_statistics_sql(c, source) for c in columns)
    )


def _scale(method: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = features(spark, sf_dir).select("code", *SCALED)
        return rounded(FeatureScaler(method=method, **ROLES).fit(df).transform(df))

    return run


for _method in scaling.METHODS:
    registered(f"scale_{_method}", with_pf(scale_sql("pf", "code", SCALED, _method)))(
        _scale(_method)
    )


@registered("scale_events", scale_sql("events", "event_id", ["value"], "auto"))
def scale_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A skewed column, which takes min-max."""
    df = table(spark, sf_dir, "events").select("event_id", "value")
    return rounded(FeatureScaler(preserve_cols=["event_id"]).fit(df).transform(df))


@registered(
    "scaler_choice",
    union_all(
        [
            f"""SELECT '{c}' AS "column", CASE WHEN abs(skew) > 1 THEN 'minmax' ELSE 'standard' END AS method,
  round(CASE WHEN abs(skew) > 1 THEN lo ELSE mean END, 6) AS centre,
  round(CASE WHEN abs(skew) > 1 THEN hi - lo ELSE sd END, 6) AS scale, round(skew, 6) AS skewness
FROM {_statistics_sql(c, t)}"""
            for c, t in (("value", "events"), ("user_id", "events"))
        ]
    ),
)
def scaler_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").select("event_id", "value", "user_id")
    return rounded(FeatureScaler(preserve_cols=["event_id"]).fit(df).scaler_report(spark))


@registered(
    "scale_lineitem",
    scale_sql("lineitem", "l_orderkey, l_linenumber", ["l_quantity", "l_extendedprice"], "auto"),
)
def scale_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    stage = FeatureScaler(preserve_cols=["l_orderkey", "l_linenumber"])
    return rounded(stage.fit(df).transform(df))


# ------------------------------------------------------------------ reduction

REDUCED = ["carb", "sugar", "fat", "protein", "salt"]


@registered(
    "pca_totals",
    with_pf(
        "SELECT CAST(5 AS INT) AS columns, round("
        + " + ".join(f"var_samp({c})" for c in REDUCED)
        + ", 4) AS total_variance, round("
        + " + ".join(f"pow(covar_samp({a}, {b}), 2)" for a in REDUCED for b in REDUCED)
        + ", 2) AS squared_eigenvalues FROM imp",
        IMPUTED,
    ),
)
def pca_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eigenvalues are the variances of all components: their sum is the total variance of
    the columns, the sum of their squares that of the squared covariances."""
    df = imputed(spark, sf_dir).select("code", *REDUCED)
    model = FeatureReducer(n_components=len(REDUCED), **ROLES).fit(df)
    scores = model.transform(df)
    variances = [F.var_samp(c) for c in model.component_columns]
    total, squares = F.lit(0.0), F.lit(0.0)
    for v in variances:
        total, squares = total + v, squares + v * v
    return scores.agg(
        F.lit(len(variances)).alias("columns"),
        F.round(total, 4).alias("total_variance"),
        F.round(squares, 2).alias("squared_eigenvalues"),
    )


@registered(
    "pca_norms",
    with_pf(
        "SELECT code, round("
        + " + ".join(f"pow({c} - (SELECT avg({c}) FROM imp), 2)" for c in REDUCED)
        + ", 4) AS squared_norm FROM imp",
        IMPUTED,
    ),
)
def pca_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All components keep the length of every centred row."""
    df = imputed(spark, sf_dir).select("code", *REDUCED)
    model = FeatureReducer(n_components=len(REDUCED), **ROLES).fit(df)
    norm = F.lit(0.0)
    for c in model.component_columns:
        norm = norm + F.col(c) * F.col(c)
    return model.transform(df).select("code", F.round(norm, 4).alias("squared_norm"))


def embedding_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    size = len(vectors.select("embedding").first()["embedding"])
    columns = [F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(size)]
    return vectors.select("vec_id", *columns)


@registered(
    "pca_embedding_norms",
    """WITH e AS (SELECT vec_id, UNNEST(range(64)) AS i, UNNEST(CAST(embedding AS DOUBLE[])) AS x
  FROM embeddings),
m AS (SELECT i, avg(x) AS m FROM e GROUP BY i)
SELECT vec_id, round(sum(pow(x - m, 2)), 5) AS squared_norm FROM e JOIN m USING (i) GROUP BY vec_id""",
)
def pca_embedding_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = embedding_columns(spark, sf_dir)
    model = FeatureReducer(n_components=64, preserve_cols=["vec_id"]).fit(df)
    norm = F.lit(0.0)
    for c in model.component_columns:
        norm = norm + F.col(c) * F.col(c)
    return model.transform(df).select("vec_id", F.round(norm, 5).alias("squared_norm"))


PAIR = """m AS (SELECT avg(carb) AS mx, avg(salt) AS my, var_samp(carb) AS a, var_samp(salt) AS c,
  covar_samp(carb, salt) AS b FROM imp),
e AS (SELECT *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS l1,
  (a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b) AS l2 FROM m),
n AS (SELECT *, b / sqrt(b * b + pow(l1 - a, 2)) AS ux, (l1 - a) / sqrt(b * b + pow(l1 - a, 2)) AS uy
  FROM e),
ax AS (SELECT *, CASE WHEN (abs(ux) >= abs(uy) AND ux < 0) OR (abs(ux) < abs(uy) AND uy < 0)
    THEN -1 ELSE 1 END AS s1,
  CASE WHEN (abs(uy) >= abs(ux) AND -uy < 0) OR (abs(uy) < abs(ux) AND ux < 0)
    THEN -1 ELSE 1 END AS s2 FROM n)"""


@registered(
    "pca_pair_project",
    with_pf(
        """SELECT code, grade, round(s1 * ((carb - mx) * ux + (salt - my) * uy), 4) AS "PC1",
  round(s2 * (-(carb - mx) * uy + (salt - my) * ux), 4) AS "PC2" FROM imp, ax""",
        IMPUTED,
        PAIR,
    ),
)
def pca_pair_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns, whose axes have a closed form."""
    df = imputed(spark, sf_dir).select("code", "grade", "carb", "salt")
    done = FeatureReducer(n_components=2, **ROLES).fit(df).transform(df)
    return done.select(
        "code", "grade", F.round("PC1", 4).alias("PC1"), F.round("PC2", 4).alias("PC2")
    )


@registered(
    "pca_pair_variance",
    with_pf(
        """SELECT CAST(1 AS INT) AS position, 'PC1' AS component, round(l1 / (l1 + l2), 6) AS ratio,
  round(l1 / (l1 + l2), 6) AS cumulative FROM ax
UNION ALL SELECT CAST(2 AS INT), 'PC2', round(l2 / (l1 + l2), 6), 1.0::DOUBLE FROM ax""",
        IMPUTED,
        PAIR,
    ),
)
def pca_pair_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = imputed(spark, sf_dir).select("code", "grade", "carb", "salt")
    model = FeatureReducer(variance_threshold=0.999, **ROLES).fit(df)
    return rounded(model.variance_report(spark))


@registered("pca_variance")
def pca_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = embedding_columns(spark, sf_dir)
    return FeatureReducer(preserve_cols=["vec_id"]).fit(df).variance_report(spark)


@registered("pca_project")
def pca_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = embedding_columns(spark, sf_dir)
    return FeatureReducer(preserve_cols=["vec_id"]).fit(df).transform(df)


# ------------------------------------------------------------------ whole tables


@registered(
    "drop_wide_text",
    "SELECT doc_id, lang, source, n_chars FROM documents",
)
def drop_wide_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text column has far more distinct values than allowed, the others fewer."""
    df = table(spark, sf_dir, "documents")
    return jobs.drop_wide_text(df, ["text", "source", "lang"], bound=100)


@registered(
    "preprocessed_table",
    f"""WITH {SPELLED}, {RAW},
cells AS (SELECT code, coalesce(string_agg(DISTINCT name, ',' ORDER BY name), 'unknown') AS countries
          FROM raw GROUP BY code),
t AS (SELECT o_orderkey AS code, o_orderstatus AS status, cells.countries,
        CASE WHEN o_totalprice > 300000 THEN NULL ELSE o_totalprice END AS price,
        CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority
      FROM orders JOIN cells ON code = o_orderkey)
SELECT code, status, countries, coalesce(priority, 'unknown') AS priority,
  round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM t)), 6) AS price FROM t""",
)
def preprocessed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read a landed table, fill, clean the country lists, drop redundant and wide columns."""
    cells = raw_cells(spark, sf_dir).withColumnRenamed("cell", "countries")
    orders = table(spark, sf_dir, "orders").join(cells, F.col("code") == F.col("o_orderkey"))
    df = orders.select(
        "code",
        F.col("o_orderstatus").alias("status"),
        "countries",
        F.when(F.col("o_totalprice") <= 300_000, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        (F.col("o_totalprice") * 4.184).alias("price_again"),
        F.concat(F.lit("order "), F.col("o_orderkey")).alias("note"),
    )
    source, target = run_path(spark, "table"), run_path(spark, "table")
    df.write.parquet(source)
    jobs.preprocess_dataset(
        spark, source, target, label="status", key=["code"],
        redundant=["price_again"], wide_text=["note", "priority"], wide_text_bound=1_000,
        report_path=f"{target}-report",
    )
    return rounded(spark.read.parquet(target))

"""Queries over profiles, comparisons and plots' data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.functions.columns import col, nan_to_null
from sparkprep.operators import outliers, profile, state
from sparkprep.operators.quantiles import exact_quantiles, exact_quantiles_by
from sparkprep.plans.product_features import (
    DERIVED,
    LABEL,
    NUMERIC,
    ORDER,
    RANGES,
    product_features,
    table,
)
from sparkprep.plans.queries_transform import (
    DERIVED_CTE,
    IMPUTED,
    derived,
    imputed,
)
from sparkprep.plans.registry import (
    LAB,
    bad,
    features,
    r6,
    registered,
    rounded,
    split_ctes,
    tagged,
    union_all,
    with_pf,
)
from sparkprep.workspace import run_path

TYPES = {
    "code": "bigint", "grade": "string", "seg": "string", "nation": "string",
    "countries": "string", "carb": "double", "sugar": "double", "fat": "double",
    "protein": "double", "salt": "double", "additives_n": "bigint", "sparse_col": "double",
}


def _missing_sql() -> str:
    return union_all(
        [
            f"""SELECT '{c}' AS "column", CAST({i} AS INT) AS position,
  COUNT(*) - COUNT({c}) AS missing_count,
  CAST(round_even((COUNT(*) - COUNT({c})) / CAST(COUNT(*) AS DOUBLE) * 100.0 * 100.0, 0) AS DOUBLE)
    / 100.0 AS missing_percentage,
  '{t}' AS dtype, COUNT(DISTINCT {c}) AS unique_values FROM pf"""
            for i, (c, t) in enumerate(TYPES.items())
        ]
    )


@registered("missing_profile", with_pf(_missing_sql()))
def missing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_profile(product_features(spark, sf_dir))


@registered(
    "top_missing",
    with_pf(
        f"""SELECT * FROM ({_missing_sql()}) t WHERE missing_percentage > 0
ORDER BY missing_percentage DESC, position LIMIT 5"""
    ),
)
def top_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_missing(profile.missing_profile(product_features(spark, sf_dir)))


@registered(
    "remaining_nulls",
    with_pf(
        "SELECT 'before' AS stage, CAST("
        + " + ".join(f"SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in TYPES)
        + " AS BIGINT) AS remaining FROM pf UNION ALL SELECT 'after', CAST(0 AS BIGINT)"
    ),
)
def remaining_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = profile.remaining_nulls(product_features(spark, sf_dir))
    after = profile.remaining_nulls(imputed(spark, sf_dir))
    return before.select(F.lit("before").alias("stage"), "remaining").unionByName(
        after.select(F.lit("after").alias("stage"), "remaining")
    )


def _outlier_sql(source: str) -> str:
    parts = []
    for c, (low, high) in RANGES.items():
        parts.append(
            f"""SELECT '{c}' AS "column", SUM(CASE WHEN {c} < 0 THEN 1 ELSE 0 END)::BIGINT AS negative_count,
  SUM(CASE WHEN {c} < {low} THEN 1 ELSE 0 END)::BIGINT AS below_min,
  SUM(CASE WHEN {c} > {high} THEN 1 ELSE 0 END)::BIGINT AS above_max,
  CAST({low} AS DOUBLE) AS valid_min, CAST({high} AS DOUBLE) AS valid_max,
  SUM(CASE WHEN {c} < lo OR {c} > hi THEN 1 ELSE 0 END)::BIGINT AS statistical_outliers,
  round(any_value(lo), 6) AS iqr_lower, round(any_value(hi), 6) AS iqr_upper,
  round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(any_value(med), 6) AS median
FROM {source}, (SELECT q1 - 3 * (q3 - q1) AS lo, q3 + 3 * (q3 - q1) AS hi, med FROM (
  SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3,
         quantile_cont({c}, 0.5) AS med FROM {source}) q) b"""
        )
    return union_all(parts)


CLEAN = "clean AS (SELECT * FROM pf WHERE NOT (" + " OR ".join(
    bad(c, *r) for c, r in RANGES.items()
) + "))"


@registered("outlier_profile", with_pf(_outlier_sql("pf")))
def outlier_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.outlier_profile(features(spark, sf_dir), RANGES))


@registered("outlier_profile_after", with_pf(_outlier_sql("clean"), CLEAN))
def outlier_profile_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = outliers.domain_filter(features(spark, sf_dir), RANGES)
    return rounded(profile.outlier_profile(clean, RANGES))


LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(source: str, columns: list[str]) -> str:
    return union_all(
        [
            f"""SELECT '{c}' AS "column", COUNT({c}) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max
FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM {source}) t"""
            for c in columns
        ]
    )


@registered("describe", with_pf(_describe_sql("pf", NUMERIC)))
def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.describe(features(spark, sf_dir), NUMERIC))


@registered("describe_lineitem", _describe_sql("lineitem", LINE_COLUMNS))
def describe_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.describe(table(spark, sf_dir, "lineitem"), LINE_COLUMNS))


HISTOGRAM_COLUMNS = ["carb", "sugar", "salt"]


def _histogram_sql(source: str, columns: list[str], bins: int = 50) -> str:
    return union_all(
        [
            f"""SELECT '{c}' AS "column", CAST(b AS INT) AS bin, round(lo + b * (hi - lo) / {bins}, 6) AS lower,
  round(lo + (b + 1) * (hi - lo) / {bins}, 6) AS upper, coalesce(f.n, 0) AS n,
  round(coalesce(f.n, 0) / (total * ((hi - lo) / {bins})), 6) AS density
FROM (SELECT min({c}) AS lo, max({c}) AS hi, COUNT({c}) AS total FROM {source}) e
CROSS JOIN (SELECT UNNEST(range({bins})) AS b) bins
LEFT JOIN (SELECT least(CAST(floor(({c} - lo) / (hi - lo) * {bins}) AS INT), {bins - 1}) AS bin,
             COUNT(*) AS n
           FROM {source}, (SELECT min({c}) AS lo, max({c}) AS hi FROM {source}) e2
           WHERE {c} IS NOT NULL GROUP BY 1) f ON f.bin = b"""
            for c in columns
        ]
    )


@registered("histogram", with_pf(_histogram_sql("pf", HISTOGRAM_COLUMNS)))
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.histogram(features(spark, sf_dir), HISTOGRAM_COLUMNS))


@registered("histogram_events", _histogram_sql("events", ["value"]))
def histogram_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.histogram(table(spark, sf_dir, "events"), ["value"]))


@registered(
    "box_statistics",
    with_pf(
        union_all(
            [
                f"""SELECT grade AS label, '{c}' AS "column", round(min({c}), 6) AS low,
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS high FROM pf GROUP BY grade"""
                for c in ("carb", "sugar", "fat", "salt")
            ]
        )
    ),
)
def box_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.box_statistics(
        features(spark, sf_dir), LABEL, ["carb", "sugar", "fat", "salt"]
    )
    return rounded(found)


@registered(
    "clip_to_quantile",
    """SELECT event_id, round(value, 6) AS value FROM events
WHERE value <= (SELECT quantile_cont(value, 0.99) FROM events)""",
)
def clip_to_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return rounded(profile.clip_to_quantile(events, "value").select("event_id", "value"))


RANK = "CASE grade WHEN 'a' THEN 1.0 WHEN 'b' THEN 2.0 WHEN 'c' THEN 3.0 WHEN 'd' THEN 4.0 WHEN 'e' THEN 5.0 END"


def _correlation_sql(columns: list[str], source: str) -> str:
    return union_all(
        [
            f"""SELECT '{c}' AS "column", round(r, 6) AS correlation, round(abs(r), 6) AS strength,
  coalesce(abs(r) >= 0.1, false) AS strong
FROM (SELECT corr(CAST({c} AS DOUBLE), CAST({RANK} AS DOUBLE)) AS r FROM {source}) t"""
            for c in columns
        ]
    )


@registered("correlations", with_pf(_correlation_sql(DERIVED, "eng"), IMPUTED, DERIVED_CTE))
def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.correlations(derived(spark, sf_dir), DERIVED, LABEL, ORDER))


@registered(
    "strongest_correlations",
    with_pf(
        f"SELECT * FROM ({_correlation_sql(NUMERIC, 'pf')}) t ORDER BY strength DESC, \"column\" LIMIT 5"
    ),
)
def strongest_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.correlations(product_features(spark, sf_dir), NUMERIC, LABEL, ORDER)
    return rounded(profile.strongest(found))


@registered(
    "compare_extremes",
    with_pf(
        union_all(
            [
                f"""SELECT '{c}' AS "column", round(mb, 6) AS max_before, round(ma, 6) AS max_after,
  round(db, 6) AS median_before, round(da, 6) AS median_after,
  CAST(round_even((mb - ma) / mb * 100.0 * 100.0, 0) AS DOUBLE) / 100.0 AS max_reduction_pct
FROM (SELECT max({c}) AS mb, quantile_cont({c}, 0.5) AS db FROM pf) b,
     (SELECT max({c}) AS ma, quantile_cont({c}, 0.5) AS da FROM clean) a"""
                for c in RANGES
            ]
        ),
        CLEAN,
    ),
)
def compare_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = features(spark, sf_dir)
    after = outliers.domain_filter(before, RANGES)
    return rounded(profile.compare_extremes(before, after, list(RANGES)))


@registered(
    "compare_missing",
    with_pf(
        "SELECT * FROM ("
        + union_all(
            [
                f"""SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS missing_before,
  round((COUNT(*) - COUNT({c})) / CAST(COUNT(*) AS DOUBLE) * 100, 6) AS pct_before,
  {'CAST(NULL AS BIGINT)' if c == 'sparse_col' else 'CAST(0 AS BIGINT)'} AS missing_after,
  {'CAST(NULL AS DOUBLE)' if c == 'sparse_col' else 'CAST(0 AS DOUBLE)'} AS pct_after FROM pf"""
                for c in TYPES
            ]
        )
        + ") t WHERE missing_before > 0"
    ),
)
def compare_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = features(spark, sf_dir)
    return rounded(profile.compare_missing(before, imputed(spark, sf_dir)))


@registered(
    "split_statistics",
    with_pf(
        union_all(
            [
                f"""SELECT split_group AS split, '{c}' AS "column", round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std FROM sp GROUP BY split_group"""
                for c in RANGES
            ]
        ),
        LAB,
        split_ctes(),
    ),
)
def split_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.split_statistics(tagged(spark, sf_dir), list(RANGES)))


@registered(
    "null_and_infinite",
    with_pf(
        union_all(
            [
                f"""SELECT '{c}' AS "column", COUNT(*) - COUNT(r) AS null_count,
  SUM(CASE WHEN isinf(r) THEN 1 ELSE 0 END)::BIGINT AS infinite_count
FROM (SELECT {e} AS r FROM pf) t"""
                for c, e in (
                    ("plain", "CASE WHEN carb IS NULL OR sugar IS NULL THEN NULL ELSE sugar / carb END"),
                    ("unguarded", "CASE WHEN protein = 0 THEN CASE WHEN fat = 0 THEN NULL "
                     "ELSE CAST('Infinity' AS DOUBLE) END ELSE fat / protein END"),
                )
            ]
        )
    ),
)
def null_and_infinite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A guarded ratio and one that divides by zero as floating-point numbers do."""
    infinite = F.when(F.col("fat") != 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    ratios = product_features(spark, sf_dir).select(
        F.try_divide("sugar", "carb").alias("plain"),
        F.when(F.col("protein") == 0, infinite)
        .otherwise(F.try_divide("fat", "protein"))
        .alias("unguarded"),
    )
    return profile.null_and_infinite(nan_to_null(ratios), ["plain", "unguarded"])


MEANS = ["carb", "sugar", "fat", "protein", "salt", *DERIVED]


@registered(
    "prepared_means",
    with_pf(
        "SELECT grade, COUNT(*) AS n, "
        + ", ".join(f"round(avg({c}), 6) AS {c}" for c in MEANS)
        + " FROM eng WHERE NOT ("
        + " OR ".join(bad(c, *r) for c, r in RANGES.items())
        + ") GROUP BY grade",
        IMPUTED,
        DERIVED_CTE,
    ),
)
def prepared_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impute, remove out-of-range rows, derive, and average per class."""
    done = outliers.domain_filter(derived(spark, sf_dir), RANGES)
    means = [r6(F.avg(c)).alias(c) for c in MEANS]
    return done.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"), *means)


PLACES = [0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0]


def _order_statistics_sql(cells: str, group: str) -> str:
    """Linear-interpolated quantiles by row number, one row per ``group`` and place."""
    return f"""
r AS (SELECT {group}, v, row_number() OVER (PARTITION BY {group} ORDER BY v) - 1 AS k,
             COUNT(*) OVER (PARTITION BY {group}) AS n FROM {cells} WHERE v IS NOT NULL),
p AS (SELECT CAST(UNNEST({PLACES}) AS DOUBLE) AS p),
w AS (SELECT DISTINCT {group}, p, p * (n - 1) AS x FROM r, p),
q AS (SELECT {group}, p, x, max(v) FILTER (WHERE k = floor(x)) AS low, max(v) FILTER (WHERE k = ceil(x)) AS high
      FROM w JOIN r USING ({group}) WHERE k = floor(x) OR k = ceil(x) GROUP BY ALL)
SELECT {group}, p, round(CASE WHEN low = high THEN low
                              ELSE (floor(x) + 1 - x) * low + (x - floor(x)) * high END, 6) AS quantile
FROM q"""


@registered(
    "quantiles_with_infinities",
    """WITH d AS (
  SELECT CASE WHEN l_tax = 0 THEN CAST('Infinity' AS DOUBLE) ELSE l_extendedprice / l_tax END AS gain,
         CASE WHEN l_discount = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE -l_quantity / l_discount END AS loss,
         CASE WHEN l_quantity > 10 THEN l_quantity END AS quantity
  FROM lineitem),
c AS (UNPIVOT d ON gain, loss, quantity INTO NAME "column" VALUE v),"""
    + _order_statistics_sql("c", '"column"'),
)
def quantiles_with_infinities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratios that divide by zero, and a column with missing values."""
    inf = F.lit(float("inf"))
    rows = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_tax") == 0, inf).otherwise(F.try_divide("l_extendedprice", "l_tax")).alias("gain"),
        F.when(F.col("l_discount") == 0, -inf).otherwise(F.try_divide(-F.col("l_quantity"), "l_discount")).alias("loss"),
        F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("quantity"),
    )
    found = exact_quantiles(rows, rows.columns, PLACES)
    flat = [(c, p, v) for c, vs in found.items() for p, v in zip(PLACES, vs)]
    return rounded(spark.createDataFrame(flat, "column string, p double, quantile double"))


@registered(
    "quantiles_by_supplier",
    """WITH c AS (SELECT l_suppkey, l_extendedprice AS v FROM lineitem),"""
    + _order_statistics_sql("c", "l_suppkey"),
)
def quantiles_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All groups by the rounds of one search."""
    found = exact_quantiles_by(table(spark, sf_dir, "lineitem"), "l_suppkey", ["l_extendedprice"], PLACES)
    places = F.array(*[F.lit(p) for p in PLACES])
    return rounded(
        found.select("l_suppkey", F.inline(F.arrays_zip(places.alias("p"), F.col("quantiles").alias("quantile"))))
    )


@registered(
    "quantiles_by_order",
    """SELECT l_orderkey, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
  round(quantile_cont(l_extendedprice, 0.75), 6) AS q3 FROM lineitem GROUP BY l_orderkey""",
)
def quantiles_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many groups as orders."""
    found = exact_quantiles_by(table(spark, sf_dir, "lineitem"), "l_orderkey", ["l_extendedprice"], [0.25, 0.5, 0.75])
    names = ["q1", "median", "q3"]
    return rounded(found.select("l_orderkey", *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(names)]))


MERGED = ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag"]
# Means of numbers with two decimals may lie half-way between two rounded values; so many places leave no tie.
PLACES_OF = {"l_quantity": 9, "l_discount": 9}


@registered(
    "merged_profile",
    union_all(
        [
            f"""SELECT '{c}' AS "column", COUNT(*) AS "rows", COUNT(*) - COUNT({c}) AS missing, {n} AS n,
  round({f'avg({c})' if n != '0' else 'NULL'}, {PLACES_OF.get(c, 6)}) AS mean,
  round({f'stddev_pop({c})' if n != '0' else 'NULL'}, 6) AS std,
  {f'CAST(min({c}) AS DOUBLE)' if n != '0' else 'NULL'} AS min, {f'CAST(max({c}) AS DOUBLE)' if n != '0' else 'NULL'} AS max,
  true AS distinct_near, true AS median_near FROM lineitem"""
            for c, n in [(c, "0" if c == "l_returnflag" else f"COUNT({c})") for c in MERGED]
        ]
    ),
)
def merged_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines profiled in four chunks, merged from their stored states; sketches within their errors."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *MERGED)
    store = state.ProfileStore(spark, run_path(spark, "profile"))
    for k in range(4):
        store.add(lines.where(F.col("l_orderkey") % 4 == k).drop("l_orderkey"), str(k))
    report = state.state_report(store.state(), [0.5])
    small = F.col("column").isin(list(PLACES_OF))
    report = report.withColumns(
        {"mean": F.when(small, F.round("mean", 9)).otherwise(F.round("mean", 6)), "std": r6("std")}
    )
    medians = {r["column"]: r["quantiles"][0] for r in report.where("quantiles IS NOT NULL").collect()}
    # A median may have many equals: the middle lies between the rows below it and those up to it.
    checks = []
    for c in MERGED:
        median = F.lit(medians.get(c))
        below, upto = F.avg((col(c) < median).cast("double")), F.avg((col(c) <= median).cast("double"))
        near = (below <= 0.5 + 2 * state.rank_error()) & (upto >= 0.5 - 2 * state.rank_error())
        checks.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count_distinct(col(c)).alias("exact"),
                (near if c in medians else F.lit(True)).alias("median_near"),
            )
        )
    checked = lines.agg(F.array(*checks).alias("all")).select(F.inline("all"))
    near = F.abs(F.col("distinct") - F.col("exact")) <= F.col("exact") * 0.05
    return report.join(checked, "column").select(
        "column", "rows", "missing", "n", "mean", "std", "min", "max", near.alias("distinct_near"), "median_near"
    )


@registered(
    "approximate_quantiles",
    union_all([f"""SELECT '{c}' AS "column", COUNT(*) > 0 AS near FROM lineitem""" for c in MERGED[:3]]),
)
def approximate_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every approximate quantile lies at its rank, within the stated error."""
    lines, places = table(spark, sf_dir, "lineitem"), [0.05, 0.25, 0.5, 0.75, 0.95]
    found = state.approximate_quantiles(lines, MERGED[:3], places)
    checks, most = [], F.lit(2 * state.rank_error())
    for c in MERGED[:3]:
        near = F.lit(True)
        for p, v in zip(places, found[c]):
            below, upto = F.avg((col(c) < v).cast("double")), F.avg((col(c) <= v).cast("double"))
            near = near & (below <= F.lit(p) + most) & (upto >= F.lit(p) - most)
        checks.append(F.struct(F.lit(c).alias("column"), near.alias("near")))
    return lines.agg(F.array(*checks).alias("all")).select(F.inline("all"))

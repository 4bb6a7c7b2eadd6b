"""Registered queries with the SQL that gives the same rows, and shared SQL texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.functions.columns import col
from sparkprep.operators.splitting import split_data
from sparkprep.plans.product_features import KEY, LABEL, product_features
from sparkprep.workspace import land

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows are checked."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def rounded(df: DataFrame) -> DataFrame:
    """Every double column rounded to six places, for comparison."""
    doubles = {n for n, t in df.dtypes if t == "double"}
    return df.select(*[r6(col(c)).alias(c) if c in doubles else col(c) for c in df.columns])


_landed: dict[tuple, DataFrame] = {}


def input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, size and time of every file of the input tables."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def landed_once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table that several queries start from, landed once for each session and state of the input."""
    place = (spark.sparkContext.applicationId, input_state(spark, sf_dir), name)
    if place not in _landed:
        _landed[place] = land(make(), name)
    return _landed[place]


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived table."""
    return landed_once(spark, sf_dir, "product-features", lambda: product_features(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).where(col(LABEL).isNotNull())


def split_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_data(labelled(spark, sf_dir), LABEL, key=[KEY])


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows with their split tag."""
    return landed_once(spark, sf_dir, "split", lambda: split_labelled(spark, sf_dir))


# ---------------------------------------------------------------- SQL building blocks

PF = """pf AS (
  SELECT o.o_orderkey AS code,
         CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
              ELSE substr('abcde', CAST(substr(o.o_orderpriority,1,1) AS INT), 1) END AS grade,
         CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE c.c_mktsegment END AS seg,
         CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE n.n_name END AS nation,
         a.countries,
         CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE a.qty / 3 END AS carb,
         CASE WHEN o.o_orderkey % 7 = 1 THEN NULL ELSE a.qty_min END AS sugar,
         a.disc * 1000 AS fat,
         a.tax_min * 1000 AS protein,
         c.c_acctbal / 180 AS salt,
         CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE a.n_lines END AS additives_n,
         CASE WHEN o.o_orderkey % 25 = 0 THEN o.o_totalprice ELSE NULL END AS sparse_col
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN (SELECT l.l_orderkey, SUM(l.l_quantity) AS qty, MIN(l.l_quantity) AS qty_min,
               MAX(l.l_discount) AS disc, MIN(l.l_tax) AS tax_min, COUNT(*) AS n_lines,
               string_agg(DISTINCT sn.n_name, ',' ORDER BY sn.n_name) AS countries
        FROM lineitem l
        JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN nation sn ON s.s_nationkey = sn.n_nationkey
        GROUP BY l.l_orderkey) a ON a.l_orderkey = o.o_orderkey)"""

LAB = "lab AS (SELECT * FROM pf WHERE grade IS NOT NULL)"


def split_ctes(
    source: str = "lab", label: str = "grade", key: str = "code", out: str = "sp", tie: str = "0"
) -> str:
    """CTEs that tag ``source`` with split_group: exact sizes, quotas, hash order, ties by ``tie``."""
    return f"""
{out}_counts AS (SELECT {label} AS cls, COUNT(*) AS n FROM {source} GROUP BY {label}),
{out}_sizes AS (
  SELECT n, n - held AS n_train, held, held - CAST(ceil((1 - CAST(0.15 AS DOUBLE)
           / CAST(0.3 AS DOUBLE)) * held) AS BIGINT) AS n_val
  FROM (SELECT SUM(n) AS n, CAST(ceil(CAST(0.3 AS DOUBLE) * SUM(n)) AS BIGINT) AS held
        FROM {out}_counts) t),
{out}_ideal AS (
  SELECT cls, c.n, CAST(c.n AS DOUBLE) / s.n * s.n_train AS ideal, s.n_train, s.n_val, s.held
  FROM {out}_counts c, {out}_sizes s),
{out}_train AS (
  SELECT cls, n, n_val, held, CAST(floor(ideal) AS BIGINT)
         + CASE WHEN row_number() OVER (ORDER BY ideal - floor(ideal) DESC, cls)
                     <= n_train - SUM(CAST(floor(ideal) AS BIGINT)) OVER () THEN 1 ELSE 0 END AS q_train
  FROM {out}_ideal),
{out}_held AS (
  SELECT cls, n, q_train, n_val, CAST(n - q_train AS DOUBLE) / held * n_val AS ideal
  FROM {out}_train),
{out}_quota AS (
  SELECT cls, q_train, CAST(floor(ideal) AS BIGINT)
         + CASE WHEN row_number() OVER (ORDER BY ideal - floor(ideal) DESC, cls)
                     <= n_val - SUM(CAST(floor(ideal) AS BIGINT)) OVER () THEN 1 ELSE 0 END AS q_val
  FROM {out}_held),
{out} AS (
  SELECT r.* EXCLUDE (rn), CASE WHEN rn <= q_train THEN 'train'
              WHEN rn <= q_train + q_val THEN 'val' ELSE 'test' END AS split_group
  FROM (SELECT *, row_number() OVER (PARTITION BY {label}
                  ORDER BY md5('42|' || CAST({key} AS VARCHAR)), {tie}) AS rn FROM {source}) r
  JOIN {out}_quota q ON q.cls = r.{label})"""


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def with_pf(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([PF, *ctes]) + "\n" + body


def bad(c: str, low: float, high: float) -> str:
    return f"coalesce({c} < {low} OR {c} > {high}, false)"

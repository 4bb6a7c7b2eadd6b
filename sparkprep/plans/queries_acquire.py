"""Queries over sources, sampling, splitting and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.functions.columns import col
from sparkprep.operators import profile, sampling, splitting
from sparkprep.plans import jobs
from sparkprep.plans.product_features import CLASSES, KEY, LABEL, NUMERIC, product_features, table
from sparkprep.plans.registry import (
    LAB,
    features,
    labelled,
    registered,
    rounded,
    split_ctes,
    split_labelled,
    tagged,
    with_pf,
)
from sparkprep.sources import splits, tables
from sparkprep.workspace import run_path

COLUMNS = [
    "code", "grade", "seg", "nation", "countries", "carb", "sugar", "fat", "protein", "salt",
    "additives_n", "sparse_col",
]

ROUNDED = """SELECT code, grade, seg, nation, countries, round(carb, 6) AS carb,
  round(sugar, 6) AS sugar, round(fat, 6) AS fat, round(protein, 6) AS protein,
  round(salt, 6) AS salt, additives_n, round(sparse_col, 6) AS sparse_col"""


@registered("product_features", with_pf(f"{ROUNDED} FROM pf"))
def product_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(product_features(spark, sf_dir))


def raw_dump(spark: SparkSession, sf_dir: str) -> str:
    """The derived table as a gzip dump with all the trouble a dump has.

    Missing cells are written as different null tokens, some labels in upper case, an
    unneeded column is added, and rows with a negative salt value get one field too many.
    """
    path = run_path(spark, "dump")
    token = {"seg": "null", "nation": "N/A", "carb": "NaN", "sugar": "", "additives_n": "NA"}
    label = F.when(F.col("fat") > 50, F.upper("grade")).otherwise(F.col("grade"))
    cells = [F.coalesce(label, F.lit("n/a")), F.lit("unneeded")] + [
        F.coalesce(col(c).cast("string"), F.lit(token.get(c, "None")))
        for c in COLUMNS
        if c != "grade"
    ]
    header = "\t".join(["grade", "extra"] + [c for c in COLUMNS if c != "grade"])
    line = F.concat_ws("\t", *cells)
    long_line = F.when(F.col("salt") < 0, F.concat(line, F.lit("\tsurplus"))).otherwise(line)
    # The lower 33 bits of this id number the rows of one task, so each file gets a header.
    first = F.monotonically_increasing_id() % F.lit(1 << 33) == 0
    rows = product_features(spark, sf_dir).select(long_line.alias("line"), first.alias("first"))
    texts = F.when(F.col("first"), F.array(F.lit(header), F.col("line"))).otherwise(
        F.array(F.col("line"))
    )
    rows.select(F.explode(texts).alias("value")).write.option("compression", "gzip").text(path)
    return path


def acquired(spark: SparkSession, sf_dir: str, **settings) -> jobs.Acquired:
    return jobs.acquire(
        spark,
        raw_dump(spark, sf_dir),
        label=LABEL,
        columns=[*COLUMNS, "absent"],
        numeric=NUMERIC,
        valid=CLASSES,
        key=[KEY],
        **settings,
    )


DUMP = """dump AS (SELECT * REPLACE (CASE WHEN fat > 50 THEN upper(grade) ELSE grade END AS grade)
  FROM pf WHERE salt >= 0)"""


@registered(
    "acquire_rows",
    with_pf(
        """SELECT CAST(code AS VARCHAR) AS code, grade, seg, nation, countries,
  round(carb, 6) AS carb, round(sugar, 6) AS sugar, round(fat, 6) AS fat,
  round(protein, 6) AS protein, round(salt, 6) AS salt,
  CAST(additives_n AS DOUBLE) AS additives_n, round(sparse_col, 6) AS sparse_col
FROM dump WHERE grade IS NOT NULL""",
        DUMP,
    ),
)
def acquire_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(acquired(spark, sf_dir).table)


@registered(
    "acquire_metadata",
    with_pf(
        """SELECT COUNT(*) AS total_products, COUNT(grade) AS labelled_products,
  COUNT(grade) AS filtered_products, COUNT(grade) AS kept_products,
  CAST(12 AS INT) AS columns, 'absent' AS missing_columns FROM dump""",
        DUMP,
    ),
)
def acquire_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquired(spark, sf_dir).metadata.drop(
        "grade_distribution", "data_source", "acquired_at"
    )


@registered(
    "acquire_sample",
    with_pf(
        """SELECT CAST(code AS VARCHAR) AS code, grade FROM (
  SELECT code, grade, row_number() OVER (ORDER BY md5('42|' || CAST(code AS VARCHAR))) AS rn
  FROM dump WHERE grade IS NOT NULL) t WHERE rn <= 5000""",
        DUMP,
    ),
)
def acquire_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquired(spark, sf_dir, sample_size=5_000).table.select("code", "grade")


@registered(
    "class_distribution",
    with_pf(
        """SELECT upper(grade) AS label, COUNT(*) AS n,
  round(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (), 6) AS share
FROM pf WHERE lower(grade) IN ('a', 'b', 'c', 'd', 'e') GROUP BY upper(grade)"""
    ),
)
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.class_distribution(product_features(spark, sf_dir), LABEL, CLASSES))


@registered(
    "exact_sample",
    """SELECT event_id, user_id, event_type, round(value, 6) AS value FROM (
  SELECT *, row_number() OVER (ORDER BY md5('7|' || CAST(event_id AS VARCHAR))) AS rn
  FROM events) t WHERE rn <= 5000""",
)
def exact_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = sampling.exact_sample(table(spark, sf_dir, "events"), 5_000, ["event_id"], seed=7)
    return rounded(drawn.select("event_id", "user_id", "event_type", "value"))


@registered(
    "csv_round_trip",
    with_pf(
        "SELECT * REPLACE (CAST(code AS VARCHAR) AS code, CAST(additives_n AS DOUBLE) AS "
        f"additives_n) FROM ({ROUNDED} FROM pf) t"
    ),
)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_path(spark, "csv")
    tables.write_table(product_features(spark, sf_dir), path, "csv")
    return rounded(tables.read_csv(spark, path, numeric=NUMERIC))


@registered(
    "dump_with_line_breaks",
    """SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5,
  length(text) - length(replace(text, chr(10), '')) AS n_breaks FROM documents""",
)
def dump_with_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a plain dump whose quoted texts hold line breaks, read back by many tasks."""
    path = run_path(spark, "line-breaks")
    quoted = F.concat(F.lit('"'), F.replace(F.col("text"), F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws("\t", "doc_id", quoted, "lang", "source", "n_chars")
    header = "doc_id\ttext\tlang\tsource\tn_chars"
    # The lower 33 bits of this id number the rows of one task, so each file gets a header.
    first = F.monotonically_increasing_id() % F.lit(1 << 33) == 0
    rows = table(spark, sf_dir, "documents").select(line.alias("line"), first.alias("first"))
    texts = F.when(F.col("first"), F.array(F.lit(header), F.col("line"))).otherwise(F.array("line"))
    rows.select(F.explode(texts).alias("value")).write.text(path)
    read = tables.read_delimited(spark, path, null_tokens=[""])
    return read.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "lang",
        "source",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.md5("text").alias("text_md5"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("long").alias("n_breaks"),
    )


@registered(
    "split_rows", with_pf("SELECT code, grade, split_group FROM sp", LAB, split_ctes())
)
def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_labelled(spark, sf_dir).select("code", "grade", "split_group")


@registered(
    "split_again", with_pf("SELECT code, grade, split_group FROM sp", LAB, split_ctes())
)
def split_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that carry the tag of another split, which is dropped before they are split anew."""
    other = splitting.split_data(labelled(spark, sf_dir), LABEL, random_state=7, key=[KEY])
    return splitting.split_data(other, LABEL, key=[KEY]).select("code", "grade", "split_group")


@registered(
    "split_repeated_keys",
    "WITH ord AS (SELECT o_custkey, o_orderkey, o_orderpriority FROM orders),"
    + split_ctes(
        "ord",
        "o_orderpriority",
        "o_custkey",
        tie="md5('42|' || o_custkey || '|' || o_orderkey || '|' || o_orderpriority)",
    )
    + " SELECT * FROM sp",
)
def split_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders split by customer: rows that share a key are told apart within it."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return splitting.split_data(rows, "o_orderpriority", key=["o_custkey"])


@registered(
    "split_rows_unstratified",
    """WITH sizes AS (
  SELECT n - held AS q_train,
         held - CAST(ceil((1 - CAST(0.15 AS DOUBLE) / CAST(0.3 AS DOUBLE)) * held) AS BIGINT) AS q_val
  FROM (SELECT COUNT(*) AS n, CAST(ceil(CAST(0.3 AS DOUBLE) * COUNT(*)) AS BIGINT) AS held
        FROM documents) t),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || CAST(doc_id AS VARCHAR))) AS rn
           FROM documents)
SELECT doc_id, CASE WHEN rn <= q_train THEN 'train' WHEN rn <= q_train + q_val THEN 'val'
       ELSE 'test' END AS split_group FROM ranked, sizes""",
)
def split_rows_unstratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    done = splitting.split_data(docs, "lang", stratify=False, key=["doc_id"])
    return done.select("doc_id", "split_group")


@registered(
    "split_distribution",
    with_pf(
        """SELECT split_group AS split, grade AS label, COUNT(*) AS n,
  round(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY split_group), 6) AS share
FROM sp GROUP BY split_group, grade""",
        LAB,
        split_ctes(),
    ),
)
def split_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(splitting.split_distribution(tagged(spark, sf_dir), LABEL))


SHARES = """shares AS (
  SELECT grade AS label,
    SUM(CASE WHEN split_group = 'train' THEN 1 ELSE 0 END) AS n_train,
    SUM(CASE WHEN split_group = 'val' THEN 1 ELSE 0 END) AS n_val,
    SUM(CASE WHEN split_group = 'test' THEN 1 ELSE 0 END) AS n_test
  FROM sp GROUP BY grade),
shared AS (
  SELECT label, CAST(n_train AS BIGINT) AS n_train, CAST(n_val AS BIGINT) AS n_val,
    CAST(n_test AS BIGINT) AS n_test,
    CAST(n_train AS DOUBLE) / SUM(n_train) OVER () AS share_train,
    CAST(n_val AS DOUBLE) / SUM(n_val) OVER () AS share_val,
    CAST(n_test AS DOUBLE) / SUM(n_test) OVER () AS share_test
  FROM shares),
deviating AS (
  SELECT *, greatest(abs(share_val - share_train), abs(share_test - share_train)) AS deviation
  FROM shared)"""


@registered(
    "split_table",
    with_pf(
        """SELECT label, n_train, n_val, n_test, round(share_train, 6) AS share_train,
  round(share_val, 6) AS share_val, round(share_test, 6) AS share_test,
  round(deviation, 6) AS deviation FROM deviating""",
        LAB,
        split_ctes(),
        SHARES,
    ),
)
def split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(splitting.split_table(tagged(spark, sf_dir), LABEL))


@registered(
    "split_balance",
    with_pf(
        "SELECT round(max(deviation), 6) AS max_deviation, max(deviation) < 0.05 AS is_balanced"
        " FROM deviating",
        LAB,
        split_ctes(),
        SHARES,
    ),
)
def split_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(splitting.split_balance(tagged(spark, sf_dir), LABEL))


@registered(
    "split_metadata",
    with_pf(
        """SELECT d.split_group AS split, d.grade AS label, d.n, round(d.share, 6) AS share,
  round(b.max_deviation, 6) AS max_deviation, b.is_balanced, '0.7' AS train_ratio,
  '42' AS random_state
FROM (SELECT split_group, grade, COUNT(*) AS n,
        CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY split_group) AS share
      FROM sp GROUP BY split_group, grade) d,
     (SELECT max(deviation) AS max_deviation, max(deviation) < 0.05 AS is_balanced
      FROM deviating) b""",
        LAB,
        split_ctes(),
        SHARES,
    ),
)
def split_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = {"train_ratio": 0.7, "random_state": 42}
    return rounded(splits.split_metadata(tagged(spark, sf_dir), config, LABEL))


@registered(
    "split_files",
    with_pf(
        """SELECT 'train' AS part, code, grade FROM sp WHERE split_group = 'train'
UNION ALL SELECT 'val', code, grade FROM sp WHERE split_group = 'val'
UNION ALL SELECT 'test', code, grade FROM sp WHERE split_group = 'test'""",
        LAB,
        split_ctes(),
    ),
)
def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved by part, read back part by part and put together again."""
    path = run_path(spark, "splits")
    splits.save_splits(tagged(spark, sf_dir).select("code", "grade", "split_group"), path)
    saved = spark.read.parquet(path)
    parts = [
        splitting.take_part(saved, p).select(F.lit(p).alias("part"), "code", "grade")
        for p in splitting.PARTS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@registered(
    "train_features",
    with_pf(
        "SELECT code, seg, nation FROM sp WHERE split_group = 'train'", LAB, split_ctes()
    ),
)
def train_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_path(spark, "splits")
    rows = tagged(spark, sf_dir).select("code", "grade", "seg", "nation", "split_group")
    splits.save_splits(rows, path)
    features_only, _ = splits.load_train_data(spark, path, label=LABEL)
    return features_only


@registered(
    "compare_counts",
    with_pf(
        """SELECT coalesce(b.grade, a.grade) AS value, coalesce(b.n, 0) AS n_before,
  coalesce(a.n, 0) AS n_after, b.n IS NOT DISTINCT FROM a.n AS match
FROM (SELECT grade, COUNT(*) AS n FROM pf GROUP BY grade) b
FULL JOIN (SELECT grade, COUNT(*) AS n FROM pf WHERE coalesce(salt >= 0, true) GROUP BY grade) a
  ON b.grade IS NOT DISTINCT FROM a.grade"""
    ),
)
def compare_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = features(spark, sf_dir)
    return profile.compare_counts(before, before.where("coalesce(salt >= 0, true)"), LABEL)

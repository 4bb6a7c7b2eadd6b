"""A product-like table derived from the order tables.

One row per order: a five-class label, categories, a multi-valued cell, measured numbers
with missing and out-of-range values, zero denominators and a sparse column. The source
tables hold no nulls, so some cells are blanked by rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "code"
LABEL = "grade"
CLASSES = ["a", "b", "c", "d", "e"]
ORDER = {c: i + 1 for i, c in enumerate(CLASSES)}
NUMERIC = ["carb", "sugar", "fat", "protein", "salt", "additives_n", "sparse_col"]
RANGES = {
    "fat": (0.0, 100.0),
    "carb": (0.0, 100.0),
    "sugar": (0.0, 100.0),
    "protein": (0.0, 100.0),
    "salt": (0.0, 50.0),
}
RATIOS = [("fat_to_protein", "fat", "protein"), ("sugar_to_carb", "sugar", "carb")]
DENSITIES = [("salt_density", "salt", 100.0)]
CONTRIBUTIONS = [
    ("calories_from_fat", "fat", 9.0),
    ("calories_from_carb", "carb", 4.0),
    ("calories_from_protein", "protein", 4.0),
]
FLAGS = [("high_fat", "fat", 20.0), ("high_sugar", "sugar", 15.0), ("high_salt", "salt", 1.5)]
DERIVED = [r[0] for r in [*RATIOS, *DENSITIES, *CONTRIBUTIONS, *FLAGS]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _blank(key: str, modulus: int, remainder: int, c: Column) -> Column:
    return F.when(F.col(key) % modulus != remainder, c)


def product_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    # Table by table: a join's size is overestimated, so one with a joined table would shuffle the lines.
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").alias("qty"),
            F.min("l_quantity").alias("qty_min"),
            F.max("l_discount").alias("disc"),
            F.min("l_tax").alias("tax_min"),
            F.count(F.lit(1)).alias("n_lines"),
            F.array_join(F.array_sort(F.collect_set("n_name")), ",").alias("countries"),
        )
    )
    orders = table(spark, sf_dir, "orders")
    grade = F.substring(F.lit("".join(CLASSES)), F.substring("o_orderpriority", 1, 1).cast("int"), 1)
    return (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("code"),
            _blank("o_orderkey", 97, 0, grade).alias("grade"),
            _blank("c_custkey", 11, 0, F.col("c_mktsegment")).alias("seg"),
            _blank("c_custkey", 13, 0, F.col("n_name")).alias("nation"),
            F.col("countries"),
            _blank("o_orderkey", 7, 0, F.col("qty") / 3).alias("carb"),
            _blank("o_orderkey", 7, 1, F.col("qty_min")).alias("sugar"),
            (F.col("disc") * 1000).alias("fat"),
            (F.col("tax_min") * 1000).alias("protein"),
            (F.col("c_acctbal") / 180).alias("salt"),
            _blank("o_orderkey", 5, 0, F.col("n_lines")).alias("additives_n"),
            F.when(F.col("o_orderkey") % 25 == 0, F.col("o_totalprice")).alias("sparse_col"),
        )
    )

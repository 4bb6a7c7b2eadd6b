"""Multi-valued cells resolved against an alias table: every distinct token once, by hash joins.

The alias table is a DataFrame (alias, name) of any size. Distinct cells are counted, their distinct tokens are joined with
the table, cells are rebuilt from the tokens that it knows, and rows take the result by their cell. Work grows
with the distinct cells and tokens; cells and tokens that most rows hold are never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.functions.columns import col, small_frame
from sparkprep.functions.text import UNKNOWN, form_pattern, normal_form
from sparkprep.operators.lookup import FOUND, attach
from sparkprep.workspace import land

Aliases = Mapping[str, str] | DataFrame


def alias_table(spark: SparkSession, aliases: Aliases) -> DataFrame:
    """(key, name) from aliases (alias, name): keys in normal form; of a key with several names the smallest counts."""
    if not isinstance(aliases, DataFrame):
        if not aliases:
            raise ValueError("alias table is empty")
        aliases = small_frame(spark, list(aliases.items()), "alias string, name string")
    keyed = aliases.select(normal_form(F.col("alias")).alias("key"), "name").where("key <> '' AND name IS NOT NULL")
    return keyed.groupBy("key").agg(F.min("name").alias("name"))


def resolve_tokens(tokens: DataFrame, aliases: Aliases) -> DataFrame:
    """(token, n, name) of the rows of ``tokens`` (token, n; distinct) that the aliases know.

    A token that they do not know as it stands is looked up without its form of state ("Kingdom of").
    """
    key = normal_form(F.col("token"))
    keys = F.array_distinct(F.array(key, F.regexp_replace(key, form_pattern(), "")))
    asked = tokens.select("token", "n", F.posexplode(keys).alias("turn", "key"))
    met = asked.join(alias_table(tokens.sparkSession, aliases), "key")
    return met.groupBy("token", "n").agg(F.min_by("name", "turn").alias("name"))


def clean_lists(df: DataFrame, column: str, aliases: Aliases) -> DataFrame:
    """``df`` with each comma-joined cell of ``column`` resolved, unresolved tokens dropped, deduped, sorted, joined.

    NULL, ``unknown`` and cells without any resolved token give ``unknown``. Rows keep their other columns.
    """
    cell = col(column).cast("string")
    cells = df.select(cell.alias("cell")).where(F.col("cell").isNotNull() & (F.col("cell") != UNKNOWN))
    cells = land(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "cells")
    pairs = cells.select("cell", F.explode(F.array_distinct(F.split("cell", ","))).alias("token"))
    tokens = pairs.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    known = land(resolve_tokens(tokens, aliases), "dictionary")
    rows, distinct = cells.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    named = attach(
        pairs, F.col("token"), known.select(F.col("token").alias("key"), "n", F.col("name").alias("value")), distinct
    )
    rebuilt = named.where(F.col(FOUND).isNotNull()).groupBy("cell").agg(
        F.array_join(F.array_sort(F.collect_set(FOUND)), ",").alias("value")
    )
    table = land(rebuilt.join(cells, "cell").select(F.col("cell").alias("key"), "n", "value"), "clean-cells")
    found = attach(df, cell, table, rows)
    clean = F.coalesce(F.col(FOUND), F.lit(UNKNOWN)).alias(column)
    return found.select(*[clean if c == column else col(c) for c in df.columns])

"""Values attached to rows by a key that may be very frequent, without a shuffle of hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.columns import col

# A key above this share of the counted rows is hot; there are at most 1/share of them.
HOT_SHARE = 0.001
# Parts that the rows of one key are dealt to in a shuffle join.
SALTS = 8
FOUND = "__found"


def attach(df: DataFrame, key: Column, table: DataFrame, rows: int) -> DataFrame:
    """``df`` with :data:`FOUND`, the value that ``table`` (key, n, value) has for the text ``key``; else null.

    ``n`` is how many of ``rows`` rows hold the key. Keys are joined by a 128-bit hash. The hot ones, whose
    number and so whose bytes are bounded by their share, are broadcast. Spark joins the others by shuffle or, where it knows
    them to be small, by broadcast. Rows already answered are spread over keys that match nothing, and the rows of
    any other key, known or not, over several parts, so a key that is hot in ``df`` alone does not meet in one task.
    """

    def hashed(c: Column) -> Column:
        return F.unhex(F.md5(c))

    bound = F.lit(rows * HOT_SHARE)
    hot = table.where(F.col("n") > bound).select(
        hashed(F.col("key")).alias("__key"), F.col("value").alias("__hot")
    )
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)]))
    cold = table.where(F.col("n") <= bound).select(
        hashed(F.col("key")).alias("__cold_key"), F.col("value").alias("__cold"), salts.alias("__salt")
    )
    row = F.xxhash64(*[col(c) for c in df.columns])
    is_open = F.col("__hot").isNull() & F.col("__key").isNotNull()
    joined = (
        df.withColumn("__key", hashed(key))
        .join(F.broadcast(hot), "__key", "left")
        .withColumn("__cold_key", F.when(is_open, F.col("__key")).otherwise(F.unhex(F.hex(row))))
        .withColumn("__salt", F.pmod(row, F.lit(SALTS)).cast("int"))
        .join(cold, ["__cold_key", "__salt"], "left")
    )
    return joined.select(*[col(c) for c in df.columns], F.coalesce("__hot", "__cold").alias(FOUND))

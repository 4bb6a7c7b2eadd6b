"""Mixing sources to target weights: repetition rates per source, whole copies and one drawn copy.

DataFrame functions only. Sizes are summed per source, the targets filled by weight, and each
document is emitted floor(rate) times, plus once more where a uniform number hashed from seed and
doc_id lies below the fraction of the rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkprep.llm.common import Scratch

WEIGHTS = (3, 1, 2)
SEED = "mix-1"


def n_words(text: Column | str) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _ranked(scratch: Scratch, sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, 0 for the first by code point, null last.

    The rows are sorted across tasks; a row's place is its number in its task plus the rows of
    the tasks before. Only the counts per task meet in one place.
    """
    row = F.monotonically_increasing_id()
    ordered = scratch.keep(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("__row", row), "sorted")
    task, number = F.shiftright("__row", 33), F.col("__row").bitwiseAND((1 << 33) - 1)
    counts = ordered.groupBy(task.alias("__task")).agg(F.count("*").alias("__n"))
    before = F.coalesce(
        F.sum("__n").over(Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    counts = counts.select("__task", before.alias("__before"))
    return (
        ordered.withColumn("__task", task)
        .join(F.broadcast(counts), "__task")  # a row for each task of one sort
        .withColumn("place", F.col("__before") + number)
        .drop("__row", "__task", "__before")
    )


def source_targets(
    docs: DataFrame, size: Column, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: int = 2
) -> DataFrame:
    """(source, source_size, weight, target) of every source of ``docs``.

    Sources in order of code point, null last, take ``weights`` in turn and share ``share`` of
    all sizes by weight; a target stops at ``most`` times its source's size, and what is
    over goes to the others by weight until none is above.
    """
    scratch = Scratch(docs.sparkSession, "source-targets")
    sums = docs.groupBy("source").agg(F.sum(size).alias("source_size"))
    cases = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        cases = F.when(F.pmod("place", F.lit(len(weights))) == i, F.lit(float(w))).otherwise(cases)
    table = scratch.keep(_ranked(scratch, sums).withColumn("weight", cases).drop("place"), "weights")

    cap = F.col("source_size") * F.lit(most)
    level, capped = None, None
    while True:
        full = F.lit(False) if level is None else cap < F.col("weight") * F.lit(level)
        row = table.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("caps"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if row["n"] == capped or not row["open"]:
            break
        capped, level = row["n"], (share * row["all"] - row["caps"]) / row["open"]
    level = level or 0.0
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    return table.withColumn("target", target)


def uniform(seed: str, *columns: str) -> Column:
    """A number in [0, 1) from the MD5 of seed and columns, the same in every run."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def with_copies(
    docs: DataFrame,
    size: Column,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.5,
    most: int = 2,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with __size, __source_size, __target and __copies, the times the mix takes the row.

    A null source is a source of its own. Null and empty texts have size 0 and are copied like
    any other of their source; a source of size 0 has target 0 and rate 0. Rows with equal
    doc_id get the same draw. An empty table gives no rows. Further columns are kept.
    """
    targets = source_targets(docs, size, weights, share, most).select(
        F.col("source").alias("__source"),
        F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"),
    )
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(F.lit(0.0))
    drawn = (uniform(seed, "doc_id") < F.col("__rate") - F.floor("__rate")).cast("int")
    return (
        docs.withColumn("__size", size)
        .join(targets, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("__rate", rate)
        .withColumn("__copies", (F.floor("__rate") + drawn).cast("int"))
        .drop("__source", "__rate")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix: every row of ``docs`` as often as its rate says, columns unchanged."""
    counted = with_copies(docs, n_words("text"), **options)
    times = F.explode(F.sequence(F.lit(1), F.col("__copies")))
    taken = counted.where("__copies > 0").withColumn("__time", times)
    return taken.select(*docs.columns)

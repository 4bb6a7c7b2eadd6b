"""Exact stratified train, validation and test split, and its balance."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkprep import presets
from sparkprep.functions.columns import col, require
from sparkprep.operators.sampling import assign_parts, class_counts

PARTS = ("train", "val", "test")


def split_sizes(n: int, train: float, val: float, test: float) -> tuple[int, int, int]:
    """Rows per part: the held-out share is rounded up, then its test share is."""
    held_share = val + test
    held = math.ceil(held_share * n)
    tested = math.ceil((1 - val / held_share) * held)
    return n - held, held - tested, tested


def largest_remainder(counts: Mapping, draws: int) -> dict:
    """Divide ``draws`` over the classes in proportion; equal remainders by class order."""
    total = sum(counts.values())
    ideal = {k: c / total * draws for k, c in counts.items()}
    quota = {k: math.floor(x) for k, x in ideal.items()}
    order = sorted(counts, key=lambda k: (-(ideal[k] - quota[k]), k))
    for k in order[: draws - sum(quota.values())]:
        quota[k] += 1
    return quota


def stratified_quotas(counts: Mapping, train: float, val: float, test: float) -> dict:
    """Class -> rows in train, val and test.

    Raises when a class has one member to divide, or a part has fewer rows than classes, as
    then no stratified split exists.
    """
    train_size, val_size, test_size = split_sizes(sum(counts.values()), train, val, test)
    _require_divisible(counts, train_size, val_size + test_size)
    in_train = largest_remainder(counts, train_size)
    held = {k: counts[k] - in_train[k] for k in counts}
    _require_divisible({k: n for k, n in held.items() if n}, val_size, test_size)
    in_val = largest_remainder(held, val_size)
    return {k: [in_train[k], in_val[k], held[k] - in_val[k]] for k in sorted(counts)}


def _require_divisible(counts: Mapping, first: int, second: int) -> None:
    if min(counts.values()) < 2:
        raise ValueError("every class needs at least two rows to be divided")
    if min(first, second) < len(counts):
        raise ValueError("a part would have fewer rows than there are classes")


def split_data(
    df: DataFrame,
    target_col: str = presets.LABEL,
    train_ratio: float = 0.7,
    val_ratio: float = 0.15,
    test_ratio: float = 0.15,
    random_state: int = 42,
    stratify: bool = True,
    key: Sequence[str] | None = ("code",),
    split_col: str = presets.SPLIT,
) -> DataFrame:
    """The table with ``split_col``; an existing split column is replaced.

    Sizes are exact and do not depend on partitioning. ``key`` names the columns that
    identify a row; None takes all columns.
    """
    total = train_ratio + val_ratio + test_ratio
    if abs(total - 1.0) > 1e-6:
        raise ValueError(f"ratios must sum to 1, got {total}")
    if target_col not in df.columns:
        raise ValueError(f"label column {target_col} not found")
    rows = df.drop(split_col) if split_col in df.columns else df
    stratum = col(target_col) if stratify else F.lit("all")
    counts = class_counts(rows.select(stratum.alias("__class")))
    if not counts:
        return rows.withColumn(split_col, F.lit(None).cast("string"))
    if stratify:
        if None in counts:
            raise ValueError(f"label column {target_col} has missing values")
        quotas = stratified_quotas(counts, train_ratio, val_ratio, test_ratio)
    else:
        quotas = {"all": split_sizes(counts["all"], train_ratio, val_ratio, test_ratio)}
    label = target_col if stratify else None
    return assign_parts(rows, PARTS, quotas, split_col, key, random_state, label)


def take_part(df: DataFrame, part: str, split_col: str = presets.SPLIT) -> DataFrame:
    return df.where(col(split_col) == part)


def split_distribution(
    df: DataFrame, label: str = presets.LABEL, split_col: str = presets.SPLIT
) -> DataFrame:
    """Rows and share of each class within each part."""
    counts = df.groupBy(col(split_col).alias("split"), col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # The window runs over one row per class and part.
    whole = F.sum("n").over(Window.partitionBy("split"))
    return counts.select("split", "label", "n", (F.col("n") / whole).alias("share")).orderBy(
        "split", "label"
    )


def split_table(
    df: DataFrame, label: str = presets.LABEL, split_col: str = presets.SPLIT
) -> DataFrame:
    """One row per class: rows and share per part, and the largest deviation from train."""
    counts = (
        df.groupBy(col(label).alias("label"))
        .agg(*[F.count_if(col(split_col) == p).alias(f"n_{p}") for p in PARTS])
    )
    everything = Window.partitionBy()
    shares = {
        p: F.coalesce(
            F.try_divide(F.col(f"n_{p}"), F.sum(f"n_{p}").over(everything)), F.lit(0.0)
        ).alias(f"share_{p}")
        for p in PARTS
    }
    table = counts.select("label", *[f"n_{p}" for p in PARTS], *shares.values())
    deviation = F.greatest(
        F.abs(F.col("share_val") - F.col("share_train")),
        F.abs(F.col("share_test") - F.col("share_train")),
    )
    return table.withColumn("deviation", deviation).orderBy("label")


def split_balance(
    df: DataFrame,
    label: str = presets.LABEL,
    split_col: str = presets.SPLIT,
    tolerance: float = 0.05,
) -> DataFrame:
    """One row: the largest deviation of any class share from train, and whether it is small."""
    return (
        split_table(df, label, split_col)
        .agg(F.coalesce(F.max("deviation"), F.lit(0.0)).alias("max_deviation"))
        .withColumn("is_balanced", F.col("max_deviation") < tolerance)
    )


def verify_stratification(
    df: DataFrame, label: str = presets.LABEL, split_col: str = presets.SPLIT
) -> dict:
    """Counts and shares per part with the largest deviation, as one dictionary."""
    require(df, [label, split_col])
    rows = split_table(df, label, split_col).collect()
    stats: dict = {}
    for p in PARTS:
        present = [r for r in rows if r[f"n_{p}"]]
        stats[f"{p}_counts"] = {r["label"]: r[f"n_{p}"] for r in present}
        stats[f"{p}_distribution"] = {r["label"]: r[f"share_{p}"] for r in present}
    stats["max_deviation"] = max((r["deviation"] for r in rows), default=0.0)
    stats["is_balanced"] = stats["max_deviation"] < 0.05
    return stats

"""Accuracy of a random forest on prepared features, with and without reduction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame

from sparkprep import presets
from sparkprep.functions.columns import col, numeric_columns, small_frame


def forest_accuracy(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    label: str = presets.LABEL,
    split_col: str = presets.SPLIT,
    trees: int = 100,
    seed: int = 42,
) -> float:
    """Accuracy on the held-out rows of a forest grown on the training rows."""
    features = list(columns or numeric_columns(df, {label, split_col}))
    assembled = VectorAssembler(inputCols=features, outputCol="__features").transform(df)
    train = assembled.where(col(split_col) == "train")
    indexer = StringIndexer(inputCol=label, outputCol="__y", handleInvalid="keep").fit(train)
    forest = RandomForestClassifier(
        numTrees=trees, seed=seed, featuresCol="__features", labelCol="__y"
    ).fit(indexer.transform(train))
    held_out = indexer.transform(assembled.where(col(split_col) != "train"))
    judge = MulticlassClassificationEvaluator(labelCol="__y", metricName="accuracy")
    return judge.evaluate(forest.transform(held_out))


def compare_forests(
    original: DataFrame,
    reduced: DataFrame,
    label: str = presets.LABEL,
    split_col: str = presets.SPLIT,
    exclude: Sequence[str] = (),
    trees: int = 100,
    seed: int = 42,
) -> DataFrame:
    """Accuracy on both feature sets; ``kept`` when reduction loses at most 5 percent."""
    skip = {label, split_col, *exclude}
    scores = [
        forest_accuracy(df, numeric_columns(df, skip), label, split_col, trees, seed)
        for df in (original, reduced)
    ]
    rows = [
        (
            len(numeric_columns(original, skip)),
            len(numeric_columns(reduced, skip)),
            scores[0],
            scores[1],
            scores[1] >= 0.95 * scores[0],
        )
    ]
    return small_frame(
        original.sparkSession,
        rows,
        "features int, components int, accuracy double, accuracy_reduced double, kept boolean",
    )

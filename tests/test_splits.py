"""Exact sampling and splitting: sizes, membership, ties and independence of partitioning."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkprep.operators import sampling, splitting


def labelled(spark, n, parts=5):
    return spark.range(0, n, 1, parts).select(
        F.col("id").alias("code"), F.element_at(F.array(*map(F.lit, "abcde")), (F.col("id") % 5 + 1).cast("int")).alias("y")
    )


def tags(df):
    return {r["code"]: r["split_group"] for r in df.select("code", "split_group").collect()}


def test_published_sizes():
    assert splitting.split_sizes(98_468, 0.7, 0.15, 0.15) == (68_927, 14_770, 14_771)


def test_quotas_sum_to_sizes():
    quotas = splitting.stratified_quotas({"a": 2901, "b": 13, "c": 777}, 0.7, 0.15, 0.15)
    sizes = splitting.split_sizes(3691, 0.7, 0.15, 0.15)
    assert tuple(map(sum, zip(*quotas.values()))) == sizes
    assert [sum(q) for q in quotas.values()] == [2901, 13, 777]


def test_split_is_complete_stratified_and_independent_of_partitioning(spark):
    df = labelled(spark, 1003)
    first = tags(splitting.split_data(df, "y", key=["code"]))
    again = tags(splitting.split_data(df.repartition(13), "y", key=["code"]))
    other = tags(splitting.split_data(df, "y", key=["code"], random_state=7))
    assert first == again != other
    assert len(first) == 1003
    expected = splitting.split_sizes(1003, 0.7, 0.15, 0.15)
    count = Counter(first.values())
    assert (count["train"], count["val"], count["test"]) == expected


def test_narrowing_rounds_give_the_same_rows(spark, monkeypatch):
    df = labelled(spark, 2000)
    expected = tags(splitting.split_data(df, "y", key=["code"]))
    monkeypatch.setattr(sampling, "PREFIX_DIGITS", 1)
    monkeypatch.setattr(sampling, "SLOT_ROWS", 1)
    assert tags(splitting.split_data(df, "y", key=["code"])) == expected


def test_hot_class(spark):
    df = spark.range(3000).select(
        F.col("id").alias("code"), F.when(F.col("id") < 2900, "a").otherwise("b").alias("y")
    )
    done = splitting.split_data(df, "y", key=["code"])
    table = {r["label"]: r for r in splitting.split_table(done, "y").collect()}
    assert table["a"]["n_train"] == 2030 and table["b"]["n_train"] == 70


def test_rows_sharing_a_key_are_told_apart(spark):
    df = spark.range(1000).select(
        F.lit(1).alias("code"), F.col("id").alias("x"), F.lit("a").alias("y")
    )
    done = splitting.split_data(df, "y", key=["code"])
    count = Counter(r["split_group"] for r in done.collect())
    assert count == {"train": 700, "val": 150, "test": 150}
    assert done.select("x").distinct().count() == 1000


def test_equal_rows_are_shared_out_by_number(spark, monkeypatch):
    monkeypatch.setattr(sampling, "CHUNK_ROWS", 64)
    df = spark.range(1000).select(
        F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("code"), F.lit("a").alias("y")
    )
    done = splitting.split_data(df, "y", key=["code"])
    count = Counter(r["split_group"] for r in done.collect())
    assert count == {"train": 700, "val": 150, "test": 150}
    before = Counter(r["code"] for r in df.collect())
    assert Counter(r["code"] for r in done.collect()) == before


def test_unstratified_and_resplit(spark):
    df = labelled(spark, 100).withColumn("split_group", F.lit("old"))
    done = splitting.split_data(df, "y", key=["code"], stratify=False)
    assert Counter(tags(done).values()) == {"train": 70, "val": 15, "test": 15}
    assert done.columns.count("split_group") == 1


def test_split_errors(spark):
    df = labelled(spark, 100)
    with pytest.raises(ValueError, match="sum to 1"):
        splitting.split_data(df, "y", 0.5, 0.1, 0.1)
    with pytest.raises(ValueError, match="not found"):
        splitting.split_data(df, "absent")
    with pytest.raises(ValueError, match="at least two"):
        splitting.split_data(df.withColumn("y", F.when(F.col("code") == 0, "z").otherwise("a")), "y")
    with pytest.raises(ValueError, match="missing values"):
        splitting.split_data(df.withColumn("y", F.when(F.col("code") > 5, F.col("y"))), "y")
    with pytest.raises(ValueError, match="fewer rows"):
        splitting.split_data(labelled(spark, 20), "y", 0.9, 0.05, 0.05)


def test_empty_table(spark):
    done = splitting.split_data(labelled(spark, 10).limit(0), "y", key=["code"])
    assert done.count() == 0 and "split_group" in done.columns


def test_exact_sample(spark):
    df = labelled(spark, 500)
    drawn = {r["code"] for r in sampling.exact_sample(df, 123, ["code"]).collect()}
    assert len(drawn) == 123
    assert drawn == {r["code"] for r in sampling.exact_sample(df.repartition(3), 123, ["code"]).collect()}
    assert sampling.exact_sample(df, 500, ["code"]).count() == 500
    assert sampling.exact_sample(df.select("y"), 37).count() == 37


def test_balance(spark):
    rows = [("train", "a")] * 2 + [("train", "b")] * 2 + [("val", "a")] + [("test", "a"), ("test", "b")]
    df = spark.createDataFrame(rows, "split_group string, y string")
    stats = splitting.verify_stratification(df, "y")
    assert stats["max_deviation"] == 0.5 and stats["is_balanced"] is False
    assert stats["val_counts"] == {"a": 1}
    row = splitting.split_balance(df, "y").first()
    assert (row["max_deviation"], row["is_balanced"]) == (0.5, False)


def test_one_more_row_on_a_cut_moves_no_other_key(spark):
    """Rows that share a key are told apart within it, whatever key the cut falls on."""
    rows = [(f"k{i % 50}", i, "ab"[i % 2]) for i in range(400)]
    schema = "key string, n int, label string"

    def parts(given):
        tagged = splitting.split_data(spark.createDataFrame(given, schema), "label", key=["key"])
        return {(r["key"], r["n"]): r["split_group"] for r in tagged.collect()}

    before = parts(rows)
    on_cut = {k for k, _ in before if len({before[x] for x in before if x[0] == k}) > 1}
    assert on_cut
    after = parts([*rows, (sorted(on_cut)[0], 1000, "a")])
    moved = {k for k in before if before[k] != after[k]}
    # The sizes of the parts grow by a row at most, so one row per class and cut may change.
    assert len(moved) <= 4

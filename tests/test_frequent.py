"""The most frequent tokens against a full count, and what is shuffled for them."""

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkprep.operators import frequent
from sparkprep.operators.frequent import Summary, most_frequent


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdefgh"), max_size=12), max_size=8), st.integers(1, 4))
def test_counters_are_bounds(batches, size):
    summary, counts = Summary(size), {}
    for batch in batches:
        summary.add(pa.array(batch, pa.string()))
        for t in batch:
            counts[t] = counts.get(t, 0) + 1
    held = dict(zip(summary.tokens.to_pylist(), summary.counts.tolist()))
    assert len(held) <= size
    for t, n in counts.items():
        assert held.get(t, 0) <= n <= held.get(t, 0) + summary.taken


def skewed(spark, rows=60_000):
    """A few frequent tokens, one of them null, among very many rare ones."""
    token = F.when(F.col("id") % 3 == 0, F.concat(F.lit("hot"), F.col("id") % 12)).when(
        F.col("id") % 50 != 1, F.concat(F.lit("rare"), F.col("id"))
    )
    return spark.range(rows).repartition(6).select(token.alias("token"))


def full(df, n):
    return df.where("token IS NOT NULL").groupBy("token").count().orderBy(F.desc("count"), "token").limit(n).collect()


@pytest.mark.parametrize("n", [1, 3, 4, 5, 10])
def test_first_tokens_are_exact(spark, n):
    df = skewed(spark, 6_000)
    found = [tuple(r) for r in most_frequent(df, n, counters=50).collect()]
    assert found == [tuple(r) for r in full(df, n)]


def test_ties_and_empty_tables(spark):
    df = spark.createDataFrame([(t,) for t in "ccbbaad"], "token string")
    assert [tuple(r) for r in most_frequent(df, 2, counters=2).collect()] == [("a", 2), ("b", 2)]
    assert most_frequent(df.limit(0), 3).count() == 0 and most_frequent(df, 0).count() == 0


def test_rare_tokens_are_not_shuffled(spark, monkeypatch):
    df, sent = skewed(spark), []
    monkeypatch.setattr(frequent, "land", lambda d, name: sent.append(d.count()) or d.cache())
    found = [tuple(r) for r in most_frequent(df, 4, counters=100).collect()]
    assert found == [tuple(r) for r in full(df, 4)]
    assert sent[0] <= 6 * 100 + 1 < df.distinct().count() / 50

"""The most frequent tokens, exactly, without a shuffle of all tokens.

Each task keeps a summary of a fixed number of counters (space saving by common decrements): a token's counter is at most
its count and falls short of it by the task's decrements at most. Summed over tasks, a counter is a lower bound and, with
the sum of all decrements, an upper one. Only tokens that can still be among the first are then
counted, in a second pass. Where the bounds leave open whether a token without a counter belongs to them, all
tokens are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.workspace import land

COUNTERS = 20_000  #: of one task
CANDIDATES = 200_000  #: tokens sent to the tasks for the second pass; with more, all are counted


class Summary:
    """Counters of the tokens of one task."""

    def __init__(self, size: int):
        self.size, self.taken = size, 0
        self.tokens: pa.Array = pa.array([], pa.string())
        self.counts = np.empty(0, dtype=np.int64)

    def add(self, tokens: pa.Array) -> None:
        seen = tokens.drop_null().value_counts()
        both = pa.table(
            {
                "t": pa.concat_arrays([self.tokens, seen.field("values").cast(pa.string())]),
                "n": np.concatenate([self.counts, seen.field("counts").to_numpy()]),
            }
        )
        merged = both.group_by("t").aggregate([("n", "sum")])
        names, counts = merged["t"].combine_chunks(), merged["n_sum"].to_numpy()
        if len(counts) > self.size:
            # The largest counter that must go is taken off all of them.
            least = int(np.partition(counts, len(counts) - self.size - 1)[len(counts) - self.size - 1])
            self.taken += least
            left = counts > least
            names, counts = names.filter(pa.array(left)), counts[left] - least
        self.tokens, self.counts = names, counts


def _summaries(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(size)
        for batch in batches:
            summary.add(batch.column("token"))
        # The decrements come as a row without a token.
        tokens = pa.concat_arrays([summary.tokens, pa.array([None], pa.string())])
        counts = np.append(summary.counts, summary.taken)
        yield pa.RecordBatch.from_arrays([tokens, pa.array(counts)], ["token", "n"])

    return run


def _counted(tokens: DataFrame, n: int) -> DataFrame:
    counts = tokens.where("token IS NOT NULL").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "token").limit(n)


def most_frequent(tokens: DataFrame, n: int, counters: int = COUNTERS) -> DataFrame:
    """(token, n) of the ``n`` most frequent values of ``tokens`` (token), equal counts by token; nulls do not count.

    Exact. ``tokens`` is read twice; what is shuffled is bounded by tasks times counters.
    """
    partial = tokens.select(F.col("token").cast("string").alias("token")).mapInArrow(
        _summaries(counters), "token string, n long"
    )
    bounds = land(partial.groupBy("token").agg(F.sum("n").alias("low")), "frequent-tokens")
    taken = bounds.where("token IS NULL").agg(F.coalesce(F.sum("low"), F.lit(0))).first()[0]
    held = bounds.where("token IS NOT NULL")
    first = held.orderBy(F.desc("low")).limit(n).select("low").collect()
    least = first[-1]["low"] if len(first) == n and n else 0
    # A token without a counter occurs ``taken`` times at most.
    if taken and taken >= least:
        return _counted(tokens, n)
    wanted = held.where(F.col("low") + taken >= least).select("token")
    if wanted.limit(CANDIDATES + 1).count() > CANDIDATES:
        return _counted(tokens, n)
    return _counted(tokens.join(F.broadcast(wanted), "token", "left_semi"), n)

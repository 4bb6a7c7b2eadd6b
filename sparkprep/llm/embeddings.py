"""Embedding near-dedup with spherical-cap filters from random product codes.

A filter is a direction put together from one code word per block of a rotated vector. Each
vector is list-decoded to the ``CAPS`` filter directions it comes closest to, in each of ``CODES`` codes: the
best sums of two halves are found without visiting all directions. Vectors are joined on common
filters and every pair of a filter is verified by its cosine in double precision.

A filter with many vectors is dealt to blocks of bounded size. A pair counts at the smallest filter
the two have in common, so each counts once and no list of pairs is written: a block hands on a
number of links per vector and a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.common import Forest, Scratch, block_pairs, blocks_of, by_group, components
from sparkprep.llm.words import mix

BLOCKS = 4
#: Words per block (64 ** 4 directions), codes and directions per vector and code. Found at cosine 0.9 in 64 dimensions:
#: every one of 400 drawn pairs; random vectors share a direction once in about 10 vectors at 50 000.
WORDS, CODES, CAPS = 64, 2, 32
PART = 384  #: vectors of one part of a filter


@cache
def _code(dimensions: int, words: int, number: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A rotation and the code words of each block, the same on every machine."""
    rng = np.random.Generator(np.random.PCG64([dimensions, words, number]))
    rotation, _ = np.linalg.qr(rng.standard_normal((dimensions, dimensions)))
    books = []
    for _ in range(BLOCKS):
        book = rng.standard_normal((words, dimensions // BLOCKS))
        books.append(book / np.linalg.norm(book, axis=1, keepdims=True))
    return rotation, books


def list_decode(unit: np.ndarray, words: int = WORDS, codes: int = CODES, caps: int = CAPS) -> np.ndarray:
    """Sorted keys of the directions that ``unit`` is closest to."""
    d = max(2 * BLOCKS, -(-len(unit) // BLOCKS) * BLOCKS)
    padded = np.zeros(d)
    padded[: len(unit)] = unit
    found = []
    for number in range(codes):
        rotation, books = _code(d, words, number)
        turned = (padded @ rotation).reshape(BLOCKS, -1)
        scores = [book @ part for book, part in zip(books, turned)]
        left = (scores[0][:, None] + scores[1][None, :]).ravel()
        right = (scores[2][:, None] + scores[3][None, :]).ravel()
        # A sum among the best ``caps`` has both its halves among the best ``caps``.
        n = min(caps, len(left))
        a, b = np.argpartition(-left, n - 1)[:n], np.argpartition(-right, n - 1)[:n]
        sums = (left[a][:, None] + right[b][None, :]).ravel()
        best = np.argpartition(-sums, n - 1)[:n]
        direction = a[best // n] * words * words + b[best % n]
        found.append(mix(direction.astype(np.uint64) + np.uint64((len(unit) << 40) + (number << 32))))
    return np.unique(np.concatenate(found).view(np.int64))


def _decoded(words: int, codes: int, caps: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, filters = [], []
            for cell in batch.column("embedding"):
                x = np.array(cell.values.to_numpy(zero_copy_only=False), dtype=np.float64)
                x = x / np.abs(x).max()  # so that no square overflows
                x /= np.linalg.norm(x)
                units.append(x)
                filters.append(list_decode(x, words, codes, caps))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("kind"),
                    batch.column("times"),
                    pa.array(units, pa.list_(pa.float64())),
                    pa.array(filters, pa.list_(pa.int64())),
                ],
                ["kind", "times", "unit", "filters"],
            )

    return run


def _first_common(near: np.ndarray, filters: list[np.ndarray], own: int) -> np.ndarray:
    """``near`` without the pairs that have a smaller filter in common than ``own``."""
    lower = [f[: np.searchsorted(f, own)] for f in filters]
    if near.sum() <= 50:
        for x, y in zip(*np.nonzero(near)):
            near[x, y] = not len(np.intersect1d(lower[x], lower[y], assume_unique=True))
        return near
    owner = np.repeat(np.arange(len(lower)), [len(f) for f in lower])
    _, column = np.unique(np.concatenate(lower), return_inverse=True)
    many = np.bincount(column, minlength=1)[column] > 1
    owner, column = owner[many], np.unique(column[many], return_inverse=True)[1]
    for at in range(0, int(column.max()) + 1 if len(column) else 0, 2048):
        inside = (column >= at) & (column < at + 2048)
        has = np.zeros((len(lower), 2048), dtype=np.float32)
        has[owner[inside], column[inside] - at] = 1
        near &= has @ has.T < 0.5
    return near


def _verify(least: float):
    def run(table: pa.Table, bounds: np.ndarray) -> dict[str, object]:
        kind, times, own, parts, low_part, high_part = (
            table.column(c).to_numpy() for c in ("kind", "times", "filter", "part", "low", "high")
        )
        units = table.column("unit").combine_chunks()
        unit_at, unit_values = units.offsets.to_numpy(), units.values.to_numpy()
        lists = table.column("filters").combine_chunks()
        list_at, list_values = lists.offsets.to_numpy(), lists.values.to_numpy()
        a, b, n = [], [], []
        for at, end in zip(bounds[:-1], bounds[1:]):
            if end - at < 2:
                continue
            x = unit_values[unit_at[at] : unit_at[end]].reshape(end - at, -1)
            near = (x @ x.T >= least) & block_pairs(parts[at:end], low_part[at], high_part[at])
            if not near.any():
                continue
            filters = [list_values[list_at[i] : list_at[i + 1]] for i in range(at, end)]
            near = _first_common(near, filters, int(own[at]))
            weight = times[at:end]
            links = (near | near.T) @ weight
            some = np.flatnonzero(links)
            a += kind[at + some].tolist()
            b += [None] * len(some)
            n += links[some].tolist()
            forest = Forest(end - at)
            for i, j in zip(*np.nonzero(near)):
                if forest.join(int(i), int(j)):
                    a.append(int(kind[at + i]))
                    b.append(int(kind[at + j]))
                    n.append(0)
        return {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())}

    return run


def near_embeddings(
    vectors: DataFrame, least: float = 0.9, words: int = WORDS, codes: int = CODES, caps: int = CAPS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors`` (vec_id, embedding).

    Pairs that share a filter and have a cosine of at least ``least`` are linked; equal vectors always are.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest vec_id
    reachable by links.

    Vectors that are null, empty, zero or hold null, NaN or infinite components link with nothing and are their own
    component. Vectors of different lengths are never linked. Rows that repeat a vec_id are vectors of
    their own; a null vec_id counts as component only where its whole group has no other. Further
    columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession, "near-embeddings")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    wrong = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    zero = F.forall("embedding", lambda v: v == 0.0)
    usable = F.coalesce(~wrong & ~zero, F.lit(False))
    rows = rows.withColumn("kind", F.when(usable, F.xxhash64("embedding")))
    kinds = rows.where("kind is not null").groupBy("kind").agg(
        F.count("*").alias("times"), F.min("vec_id").alias("first_id"), F.first("embedding").alias("embedding")
    )
    kinds = scratch.keep(kinds, "kinds")
    decoded = kinds.select("kind", "times", "embedding").mapInArrow(
        _decoded(words, codes, caps), "kind long, times long, unit array<double>, filters array<long>"
    )
    decoded = scratch.keep(decoded, "decoded")
    filters = decoded.select("kind", F.explode("filters").alias("filter"))
    shared = filters.groupBy("filter").agg(F.count("*").alias("members")).where("members > 1")
    shared = scratch.keep(shared, "filters")
    chunks = F.ceil(F.col("members") / F.lit(PART)).cast("long")
    met = filters.join(shared.select("filter", chunks.alias("chunks")), "filter").join(decoded, "kind")
    blocks = blocks_of(met, "filter", "chunks", "kind").select(
        "block", "filter", "kind", "times", "part", "low", "high", "unit", "filters"
    )
    judged = scratch.keep(by_group(blocks, "block", _verify(least), "a long, b long, n long"), "judged")
    groups = components(scratch, judged.where("b is not null").select("a", "b"))

    links = judged.groupBy(F.col("a").alias("kind")).agg(F.sum("n").alias("n"))
    named = kinds.join(links, "kind", "left").join(groups.withColumnRenamed("node", "kind"), "kind", "left").select(
        "kind",
        "first_id",
        (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"),
        F.coalesce("root", "kind").alias("root"),
    )
    named = scratch.keep(named, "links")
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = scratch.keep(named.join(smallest, "root").select("kind", "n_links", "component_id"), "components")
    out = rows.select("vec_id", "kind").join(named, "kind", "left")
    component = F.when(F.col("kind").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )

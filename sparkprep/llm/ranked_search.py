"""Ranked lexical search: the best documents of every query item, by dual-tree search.

A document is a sparse vector of the values of its terms, an item one of weights; the score is
their product. Documents of a batch and items each form a binary hierarchy whose nodes hold, for
every term, the largest value (coordinate maxima) below them. The product of a document node and an item node
bounds every score between them, so a pair of nodes whose bound is below the weakest kth score of
the node's items is left out with all it holds. Bounds are exact upper bounds: nothing is lost.

Items are searched in blocks with a bounded number of terms; what is broadcast of a block (terms,
weights, hierarchy) has that bound. Texts are read once per block and only narrow vectors are
written. Each task keeps the k best per item; these are merged in two steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkprep.llm.common import Scratch
from sparkprep.llm.words import MARKS, words

BLOCK_TERMS = 1 << 17  #: distinct terms of one block of items, about
LEAF_ITEMS, LEAF_DOCS = 1, 2
WAVE = 256  #: documents scored before thresholds are looked at again
BATCH = 8192  #: documents of one hierarchy
SEED_DOCS = 20_000  #: documents whose scores give the first thresholds
_NO_ID = np.iinfo(np.int64).max  #: stands for a null id: last among equal scores
_PARTS = 16
_DIMENSIONS = 16  #: of the projection that sorts rows into hierarchies


class Sparse(NamedTuple):
    """Rows of (term, value), in order of row and term."""

    row: np.ndarray
    term: np.ndarray
    value: np.ndarray

    def folded(self, up: np.ndarray) -> Sparse:
        """Rows brought together by ``up`` (row -> node), each term with its largest value."""
        row = up[self.row]
        order = np.lexsort((self.term, row))
        row, term, value = row[order], self.term[order], self.value[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
        starts = np.flatnonzero(new)
        if not len(starts):
            return Sparse(row, term, value)
        return Sparse(row[starts], term[starts], np.maximum.reduceat(value, starts))


def _halves(leaves: int) -> int:
    return max(0, math.ceil(math.log2(max(leaves, 1))))


def hierarchy(vectors: Sparse, n: int, leaf: int, scale: np.ndarray) -> tuple[np.ndarray, list[Sparse]]:
    """(leaf of each row, maxima per level from the root to the leaves) of ``n`` rows.

    Nodes are halved along the direction in which their rows, projected to few dimensions, differ
    most, so that rows with like terms stay together and the maxima are tight. ``scale`` says how much a term matters.
    """
    drawn = np.random.Generator(np.random.PCG64(1301)).standard_normal((len(scale), _DIMENSIONS))
    weight = vectors.value * scale[vectors.term]
    flat = np.stack(
        [np.bincount(vectors.row, weight * drawn[vectors.term, j], minlength=n) for j in range(_DIMENSIONS)], axis=1
    ).astype(np.float64)
    flat /= np.maximum(np.linalg.norm(flat, axis=1, keepdims=True), 1e-300)
    height = _halves(-(-n // leaf))
    own = np.empty(n, dtype=np.int64)

    def part(rows: np.ndarray, first: int, height: int) -> None:
        if not height:
            own[rows] = first
            return
        half = 1 << (height - 1)
        if len(rows) > half * leaf:
            about = flat[rows] - flat[rows].mean(axis=0)
            axis = np.linalg.eigh(about.T @ about)[1][:, -1]
            rows = rows[np.argsort(about @ axis, kind="stable")]
            part(rows[half * leaf :], first + half, height - 1)
        part(rows[: half * leaf], first, height - 1)

    part(np.arange(n), 0, height)
    levels = [vectors.folded(own)]
    for _ in range(height):
        below = levels[-1]
        levels.append(below.folded(np.arange((int(below.row.max()) if len(below.row) else 0) + 1) // 2))
    return own, levels[::-1]


class Items(NamedTuple):
    """One block of items; its size is bounded by its number of terms."""

    ids: np.ndarray  #: item numbers
    hashes: np.ndarray  #: of the block's terms, sorted
    vectors: Sparse  #: weight of each term (index into ``hashes``) times its occurrences in the item
    leaves: np.ndarray  #: leaf of each item
    levels: list[Sparse]  #: coordinate maxima, root first
    members: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  #: per leaf: items, terms, weights by term and item
    scale: np.ndarray  #: weight of each term


def with_hierarchy(ids: np.ndarray, hashes: np.ndarray, vectors: Sparse, scale: np.ndarray) -> Items:
    n = len(ids)
    leaves, levels = hierarchy(vectors, n, LEAF_ITEMS, np.ones(len(scale)))
    members = []
    for leaf in range(-(-n // LEAF_ITEMS)):
        own = np.flatnonzero(leaves == leaf)
        entries = np.flatnonzero(leaves[vectors.row] == leaf)
        terms = np.unique(vectors.term[entries])
        weights = np.zeros((len(terms), len(own)), dtype=np.int64)
        at = np.searchsorted(own, vectors.row[entries])
        weights[np.searchsorted(terms, vectors.term[entries]), at] = vectors.value[entries]
        members.append((own, terms, weights))
    return Items(ids, hashes, vectors, leaves, levels, members, scale)


def products(docs: Sparse, n_docs: int, items: Sparse, n_items: int, alive: np.ndarray) -> np.ndarray:
    """Upper bounds of the products of all node pairs that are ``alive``; 0 elsewhere."""
    out = np.zeros(n_docs * n_items)
    use = alive.any(axis=1)[docs.row]
    row, term, value = docs.row[use], docs.term[use], docs.value[use].astype(np.float64)
    order = np.argsort(items.term, kind="stable")
    by_term = items.term[order]
    low, high = np.searchsorted(by_term, term), np.searchsorted(by_term, term, side="right")
    step = max(1, (1 << 20) // max(n_items, 1))
    for s in range(0, len(term), step):  # bounded pieces of the expansion
        count = (high - low)[s : s + step]
        entry = np.repeat(np.arange(s, s + len(count)), count)
        if not len(entry):
            continue
        at = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count) + low[entry]
        pick = order[at]
        cell = row[entry] * n_items + items.row[pick]
        out += np.bincount(cell, weights=value[entry] * items.value[pick], minlength=len(out))
    # Sums in doubles may fall short of the exact sum by rounding; a bound may not.
    return (out * (1 + 1e-9) + 1).reshape(n_docs, n_items) * alive


class Best:
    """The k best documents of each item so far, by score and then by id."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))] * n
        self.kth = floor.copy()

    def add(self, item: int, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= max(self.kth[item], 1)
        if not good.any():
            return
        ids = np.concatenate([self.found[item][0], ids[good]])
        scores = np.concatenate([self.found[item][1], scores[good]])
        keep = np.lexsort((ids, -scores))[: self.k]
        self.found[item] = ids[keep], scores[keep]
        if len(keep) == self.k:
            self.kth[item] = max(self.floor[item], scores[keep[-1]])


def dual_tree(items: Items, vectors: Sparse, ids: np.ndarray, best: Best) -> tuple[int, int]:
    """Bring the k best documents of a batch into ``best``; (pairs scored, pairs there are)."""
    n, n_items = len(ids), len(items.ids)
    if not len(vectors.row) or not n_items:
        return 0, n * n_items
    own, levels = hierarchy(vectors, n, LEAF_DOCS, items.scale)
    leaves_d, leaves_i = -(-n // LEAF_DOCS), -(-n_items // LEAF_ITEMS)
    weakest = _weakest(items, best)
    depth = max(len(levels), len(items.levels))
    alive = np.ones((1, 1), dtype=bool)
    bound = alive.astype(float)
    down_d = down_i = 0
    for step in range(depth):
        # The shorter hierarchy waits at its root until both have as many levels left.
        to_d, to_i = max(0, step + len(levels) - depth), max(0, step + len(items.levels) - depth)
        alive = np.repeat(np.repeat(alive, 1 + to_d - down_d, axis=0), 1 + to_i - down_i, axis=1)
        down_d, down_i = to_d, to_i
        n_d = -(-leaves_d // (1 << (len(levels) - 1 - down_d)))
        n_i = -(-leaves_i // (1 << (len(items.levels) - 1 - down_i)))
        alive = alive[:n_d, :n_i]
        bound = products(levels[down_d], n_d, items.levels[down_i], n_i, alive)
        alive = alive & (bound >= np.maximum(weakest[down_i], 1))
    scored = 0
    starts = np.searchsorted(vectors.row, np.arange(n + 1))
    by_leaf = [np.flatnonzero(own == leaf) for leaf in range(leaves_d)]
    for leaf, (members, terms, weights) in enumerate(items.members):
        order = np.flatnonzero(alive[:, leaf])
        order = order[np.argsort(-bound[order, leaf])]
        size = max(1, WAVE // LEAF_DOCS)
        while len(order):
            # The most promising leaves first: they raise the weakest kth score for the others.
            order = order[bound[order, leaf] >= best.kth[members].min()]
            docs = np.concatenate([by_leaf[d] for d in order[:size]]) if len(order) else np.empty(0, np.int64)
            order, size = order[size:], size * 2
            if not len(docs):
                break
            scores = _exact(vectors, starts, docs, terms, weights)
            scored += scores.size
            for j, item in enumerate(members):
                best.add(int(item), ids[docs], scores[:, j])
    return scored, n * n_items


def _exact(vectors: Sparse, starts: np.ndarray, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores of ``docs`` by the items of one leaf, in whole numbers."""
    count = starts[docs + 1] - starts[docs]
    entry = np.repeat(starts[docs] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    owner = np.repeat(np.arange(len(docs)), count)
    at = np.minimum(np.searchsorted(terms, vectors.term[entry]), len(terms) - 1)
    hit = terms[at] == vectors.term[entry]
    owner, at, value = owner[hit], at[hit], vectors.value[entry[hit]]
    out = np.zeros((len(docs), weights.shape[1]), dtype=np.int64)
    new = np.flatnonzero(np.diff(owner, prepend=-1))
    if len(new):
        out[owner[new]] = np.add.reduceat(value[:, None] * weights[at], new, axis=0)
    return out


def _weakest(items: Items, best: Best) -> list[np.ndarray]:
    """Per level, root first: the weakest kth score of each node's items."""
    low = np.full(-(-len(items.ids) // LEAF_ITEMS), np.iinfo(np.int64).max)
    np.minimum.at(low, items.leaves, best.kth)
    out = [low]
    while len(out) < len(items.levels):
        below = out[-1]
        if len(below) % 2:
            below = np.append(below, np.iinfo(np.int64).max)
        out.append(below.reshape(-1, 2).min(axis=1))
    return out[::-1]


def values(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """(1e9 * tf) div (1000 * tf + 8 * m) with m = 25 + (75 * n * docs) div terms."""
    safe = n < (1 << 62) // (75 * max(docs, 1))
    m = 25 + (75 * np.where(safe, n, 0) * docs) // max(terms, 1)
    for i in np.flatnonzero(~safe):  # beyond 64 bits
        m[i] = 25 + 75 * int(n[i]) * docs // terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _counted(block, k: int, row: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(terms, indices into ``hashes``, occurrences) of each of the ``k`` texts of a block of words."""
    at = np.searchsorted(hashes, block.hashes)
    at = np.minimum(at, max(len(hashes) - 1, 0))
    hit = hashes[at] == block.hashes if len(hashes) else np.zeros(len(at), dtype=bool)
    found, times = np.unique(row[hit] * max(len(hashes), 1) + at[hit], return_counts=True)
    cut = np.searchsorted(found, np.arange(k + 1) * max(len(hashes), 1))
    found = found % max(len(hashes), 1)
    sizes = np.diff(block.offsets)
    for i in range(k):
        yield int(sizes[i]), found[cut[i] : cut[i + 1]], times[cut[i] : cut[i + 1]]


def _vectors(hashes):
    """Tasks that turn whole texts into (n, terms, tfs) over the block's terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hashes.value
        for batch in batches:
            for block in words(batch.column("text"), lower=True, space=MARKS):
                k = len(block.offsets) - 1
                row = np.repeat(np.arange(k), np.diff(block.offsets))
                at, size, terms, tfs = [], [], [], []
                for i, (n, found, times) in enumerate(_counted(block, k, row, known)):
                    if n:
                        at.append(block.first + i)
                        size.append(n)
                        terms.append(found.astype(np.int32))
                        tfs.append(times.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(at, pa.int64())),
                        pa.array(size, pa.int64()),
                        pa.array(terms, pa.list_(pa.int32())),
                        pa.array(tfs, pa.list_(pa.int32())),
                    ],
                    ["doc_id", "n", "terms", "tfs"],
                )

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in words(batch.column("text"), lower=True, space=MARKS):
            k = len(block.offsets) - 1
            found = []
            for s, e in zip(block.offsets[:-1], block.offsets[1:]):
                found.append(np.unique(block.hashes[s:e].view(np.int64), return_counts=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item").slice(block.first, k),
                    pa.array([t for t, _ in found], pa.list_(pa.int64())),
                    pa.array([c for _, c in found], pa.list_(pa.int64())),
                ],
                ["item", "terms", "times"],
            )


def _searched(items, floor, docs: int, total: int, k: int):
    """Tasks that search batches of document vectors and hand on the k best per item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = items.value
        best = Best(len(block.ids), k, floor.value)

        def search(part: pa.Table) -> None:
            ids = part.column("doc_id").fill_null(_NO_ID).to_numpy()
            n = part.column("n").to_numpy()
            lists = part.column("terms").combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(ids)), sizes)
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = part.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
            dual_tree(block, Sparse(row, term, values(tf, n[row], docs, total)), ids, best)

        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held) >= BATCH:
                search(pa.concat_tables(held))
                held = []
        if held:
            search(pa.concat_tables(held))
        for number, (ids, scores) in zip(block.ids, best.found):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), number)),
                        pa.array(ids, mask=ids == _NO_ID),
                        pa.array(scores),
                    ],
                    ["item", "doc_id", "score"],
                )

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best per item: first within parts of the documents, then over what these leave."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(_PARTS))
    near = found.withColumn("part", part)
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
    near = near.where(F.col("rank") <= k).drop("rank", "part")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def _block_of(rows: list, df: dict[int, int], docs: int, hashes: np.ndarray) -> Items:
    index = {int(h): i for i, h in enumerate(hashes.view(np.int64))}
    weight = np.zeros(len(hashes), dtype=np.int64)
    for i in range(len(hashes)):
        weight[i] = math.floor(1000 * math.log((2 * docs + 2) / (2 * df.get(i, 0) + 1)))
    row, term, value = [], [], []
    for number, r in enumerate(rows):
        for h, times in zip(r["terms"], r["times"]):
            if weight[index[h]] > 0:
                row.append(number)
                term.append(index[h])
                value.append(int(weight[index[h]]) * times)
    vectors = Sparse(*(np.array(x, dtype=np.int64) for x in (row, term, value)))
    order = np.lexsort((vectors.term, vectors.row))
    vectors = Sparse(*(x[order] for x in vectors))
    return with_hierarchy(np.array([r["item"] for r in rows], dtype=np.int64), hashes, vectors, weight)


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents (doc_id, text) of each item (item_id, text).

    Scores are whole numbers: the sum of w * ((1e9 * tf) div (1000 * tf + 8 * m)) over an item's terms, repeats
    included, with w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 25 + (75 n N) div L. Terms are runs
    of letters and digits of ASCII and of all other characters, with A-Z lowered; they are told apart
    by a 64-bit hash. Only scores above 0 count; equal ones are ranked by ascending doc_id, a null doc_id last.

    Null and empty texts have no terms: such documents count in no statistic and such items give no
    row. Every row is a document or an item of its own, also one that repeats another or has a null id. Further columns
    are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ranked-search")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = scratch.keep(
        items.select("item_id", F.col("text").cast("string").alias("text")).withColumn(
            "item", F.monotonically_increasing_id()
        ),
        "items",
    )
    listed = scratch.keep(
        named.select("item", "text").mapInArrow(_item_terms, "item long, terms array<long>, times array<long>"),
        "item-terms",
    ).where(F.size("terms") > 0)
    total = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-total // block_terms))
    results = None
    for b in range(blocks):
        block = listed.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b) if blocks > 1 else listed
        rows = sorted(block.collect(), key=lambda r: r["item"])  # about block_terms numbers
        found = _search_block(scratch, docs, rows, k)
        results = found if results is None else results.unionByName(found)
    ranked = _ranked(results, k).join(named.select("item", "item_id"), "item")
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _search_block(scratch: Scratch, docs: DataFrame, rows: list, k: int) -> DataFrame:
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    hashes = np.unique(np.array([t for r in rows for t in r["terms"]], dtype=np.int64).view(np.uint64))
    schema = "doc_id long, n long, terms array<int>, tfs array<int>"
    vectors = scratch.keep(docs.mapInArrow(_vectors(share(hashes)), schema), "vectors")
    n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = vectors.select(F.explode("terms").alias("term")).groupBy("term").count()
    df = {r["term"]: r["count"] for r in holding.collect()}  # at most one row per term of the block
    block = share(_block_of(rows, df, n_docs, hashes))
    matched = vectors.where(F.size("terms") > 0)
    out = "item long, doc_id long, score long"

    def best(part: DataFrame, floor: np.ndarray) -> DataFrame:
        return part.mapInArrow(_searched(block, share(floor), n_docs, n_terms, k), out)

    # Any k documents give a lower bound of an item's kth score, so that all tasks start pruning at once.
    floor = np.zeros(len(rows), dtype=np.int64)
    place = {r["item"]: i for i, r in enumerate(rows)}
    if n_docs > SEED_DOCS:
        few = matched.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(-(-n_docs // SEED_DOCS))) == 0)
        for r in _ranked(best(few, floor), k).where(F.col("rank") == k).select("item", "score").collect():
            floor[place[r["item"]]] = r["score"]
    return scratch.keep(best(matched, floor), "found")

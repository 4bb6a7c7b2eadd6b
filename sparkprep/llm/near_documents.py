"""MinHash near-dedup: SuperMinHash signatures, banding, verification on full sets, grouping.

Each shingle walks through the registers in an order of its own; its j-th register is offered
the rank ``j + r``, so that one register is never hit twice early by the same shingle. Walks stop as
soon as every register holds a rank below the next step. All shingles of a text take a step
together as arrays.

Bands of equal ranks give candidates. Candidates are gathered to candidate groups by linking
each text of a band to the band's smallest; every pair of a group is then verified on the full
shingle sets, in blocks of bounded size. A block hands on a spanning forest of its links, so a group of
n near copies gives no n * n rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.common import BitMap, Forest, Scratch, block_pairs, blocks_of, by_group, components
from sparkprep.llm.words import mix, shingles, words

#: Registers and registers per band: a pair at 0.85 is missed with probability 3e-7.
REGISTERS, ROWS = 192, 6
#: Shingles of the members of one part of a candidate group.
PART = 60_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 8192


def super_minhash(elements: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """SuperMinHash ranks (step in the top 16 bits) of a set of 64-bit elements."""
    low = np.full(registers, np.iinfo(np.uint64).max, dtype=np.uint64)
    places = np.arange(registers, dtype=np.uint16)
    for at in range(0, len(elements), _CHUNK):
        part = elements[at : at + _CHUNK]
        rows = np.arange(len(part))
        order = np.tile(places, (len(part), 1))
        state = part.copy()
        for j in range(registers):
            if int(low.max()) < j << 48:
                break
            state += _STEP
            drawn = mix(state)
            pick = j + ((mix(drawn) >> np.uint64(40)) * np.uint64(registers - j) >> np.uint64(24)).astype(np.int64)
            hit = order[rows, pick]
            order[rows, pick] = order[:, j]
            np.minimum.at(low, hit, (drawn >> np.uint64(16)) | np.uint64(j << 48))
    return low


def _set_hash(elements: np.ndarray) -> int:
    """64-bit identity of a sorted set."""
    scrambled = mix(elements ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    total = np.array([np.add.reduce(scrambled) ^ np.uint64(len(elements) * 0x9E3779B1)], dtype=np.uint64)
    return int(mix(total).view(np.int64)[0])


def _signatures(k: int, registers: int, rows: int):
    salts = mix(np.arange(1, registers // rows + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, kinds, bands = [], [], []
            for block in words(batch.column("text"), lower=True):
                for i in range(len(block.offsets) - 1):
                    found = shingles(block.hashes[block.offsets[i] : block.offsets[i + 1]], k)
                    sizes.append(len(found))
                    if not len(found):
                        kinds.append(0)
                        bands.append(None)
                        continue
                    kinds.append(_set_hash(found))
                    ranks = mix(super_minhash(found, registers)).reshape(-1, rows)
                    key = salts.copy()
                    for c in range(rows):
                        key = mix(key ^ ranks[:, c])
                    bands.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("row"),
                    pa.array(sizes, pa.int64()),
                    pa.array(kinds, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "row", "n_shingles", "kind", "bands"],
            )

    return run


def _sets(k: int):
    """The shingle set of each text, kept where it is the wanted one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("kind").to_numpy()
            at, found = [], []
            for block in words(batch.column("text"), lower=True):
                for i in range(len(block.offsets) - 1):
                    s = shingles(block.hashes[block.offsets[i] : block.offsets[i + 1]], k)
                    if _set_hash(s) == wanted[block.first + i]:
                        at.append(block.first + i)
                        found.append(s.view(np.int64))
            kept = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [kept.column("kind"), kept.column("grp"), kept.column("chunks"), pa.array(found, pa.list_(pa.int64()))],
                ["kind", "grp", "chunks", "shingles"],
            )

    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sorted sets."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1  # the others are in no intersection
    owner, column = owner[shared], column[shared]
    counts = np.zeros((n, n), dtype=np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        lo, hi = np.searchsorted(column, [at, at + 4096])
        if hi > lo:
            part = np.zeros((n, 4096), dtype=np.float32)
            part[owner[lo:hi], column[lo:hi] - at] = 1
            counts += part @ part.T
    np.fill_diagonal(counts, [len(s) for s in sets])
    return counts.astype(np.int64)


def _verify(percent: int):
    def run(table: pa.Table, bounds: np.ndarray) -> dict[str, object]:
        kinds, parts, low_part, high_part = (table.column(c).to_numpy() for c in ("kind", "part", "low", "high"))
        column = table.column("shingles").combine_chunks()
        values = column.values.to_numpy()
        offsets = column.offsets.to_numpy()
        low, high = [], []
        for at, end in zip(bounds[:-1], bounds[1:]):
            if end - at < 2:
                continue
            sets = [values[offsets[i] : offsets[i + 1]] for i in range(at, end)]
            both = shared_counts(sets)
            sizes = np.diag(both)
            linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
            forest = Forest(end - at)
            linked &= block_pairs(parts[at:end], low_part[at], high_part[at])
            for x, y in zip(*np.nonzero(linked)):
                if forest.join(int(x), int(y)):
                    low.append(kinds[at + x])
                    high.append(kinds[at + y])
        return {"a": np.array(low, np.int64), "b": np.array(high, np.int64)}

    return run


def near_documents(
    docs: DataFrame, percent: int = 85, k: int = 5, registers: int = REGISTERS, rows: int = ROWS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs`` (doc_id, text).

    Words are lower-cased (A-Z); a text's set holds its distinct runs of ``k`` words, or all its words
    as one run where it has fewer. Texts are linked where the intersection of their sets is at
    least ``percent`` of the union. ``component_id`` is the smallest doc_id of a group.

    Null and empty texts have an empty set, are linked with nothing and are their own
    component. Rows that repeat a doc_id or a text are rows of their own and belong to one
    group where their sets are near; a null doc_id counts only where its whole group has no
    other. Further columns of ``docs`` are ignored.
    """
    return _grouped(docs, percent, k, registers, rows).drop("row", "root")


def drop_near_documents(
    docs: DataFrame, percent: int = 85, k: int = 5, registers: int = REGISTERS, rows: int = ROWS
) -> DataFrame:
    """``docs`` with one document of each group of near copies, the one with the smallest doc_id.

    Columns and order of columns are kept. A document is told by doc_id and text; of rows equal in both one stays,
    the smallest by the other columns. Null and empty texts all stay.
    """
    scratch = Scratch(docs.sparkSession, "near-documents")
    found = _grouped(docs, percent, k, registers, rows).where("n_shingles > 0")
    found = scratch.keep(found.select("doc_id", "row", "root"), "groups")
    place = F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    first = found.groupBy("root").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    several = found.join(first.where("n > 1").select("root", "first"), "root").withColumn("stays", place == F.col("first"))
    marks = several.groupBy("doc_id", "row").agg(F.max("stays").alias("stays"), F.count("*").alias("n"))
    marks = marks.where("NOT stays OR n > 1").select(
        F.col("doc_id").alias("__doc_id"), F.col("row").alias("__row"), F.col("stays").alias("__stays")
    )
    marks = scratch.keep(marks, "marks")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__doc_id"))
    same = same & (F.xxhash64(F.col("text").cast("string")) == F.col("__row"))
    out = docs.join(marks.hint("merge"), same, "left_anti")
    if marks.where("__stays").isEmpty():
        return out
    # Repeated rows, of which one stays: merged in each task before they meet.
    again = docs.join(marks.where("__stays").hint("merge"), same, "left_semi")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    others = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(0).alias("none"))
    one = again.groupBy("doc_id", "text").agg(F.min(others).alias("__rest"))
    return out.unionByName(
        one.select(*[F.col("__rest")[c].alias(c) if c in rest else F.col(c) for c in docs.columns])
    )


def _grouped(docs: DataFrame, percent: int, k: int, registers: int, rows: int) -> DataFrame:
    """``near_documents`` with a hash of each text and the key of its group."""
    scratch = Scratch(docs.sparkSession, "near-documents")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = scratch.keep(
        texts.withColumn("row", F.xxhash64("text")).mapInArrow(
            _signatures(k, registers, rows), "doc_id long, row long, n_shingles long, kind long, bands array<long>"
        ),
        "signatures",
    )
    banded = signed.where("n_shingles > 0").select("kind", F.explode("bands").alias("band"))
    met = banded.groupBy("band").agg(F.min("kind").alias("low"), F.max("kind").alias("high"))
    met = scratch.keep(met.where("low <> high").select("band", "low"), "bands")
    near = banded.join(met, "band").select(F.col("low").alias("a"), F.col("kind").alias("b"))
    candidates = components(scratch, near)

    kinds = scratch.keep(
        signed.where("n_shingles > 0").groupBy("kind").agg(
            F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("size")
        ),
        "kinds",
    )
    members = kinds.join(candidates.select(F.col("node").alias("kind"), F.col("root").alias("grp")), "kind")
    members = scratch.keep(members, "members")
    chunks = members.groupBy("grp").agg(F.ceil(F.sum("size") / F.lit(PART)).cast("long").alias("chunks"))
    members = members.join(chunks, "grp").select(F.col("first_id").alias("doc_id"), "kind", "grp", "chunks")
    # Only texts that stand for a candidate are moved; one plan at every size.
    wanted = BitMap.of(members.select(F.xxhash64("doc_id").alias("key")), "key")
    sets = wanted.sift(texts.withColumn("key", F.xxhash64("doc_id")), "key")
    members = members.withColumnRenamed("doc_id", "first_id").hint("merge")
    sets = sets.join(members, F.col("doc_id").eqNullSafe(F.col("first_id"))).select("text", "kind", "grp", "chunks")
    sets = sets.mapInArrow(_sets(k), "kind long, grp long, chunks long, shingles array<long>")
    blocks = blocks_of(sets, "grp", "chunks", "kind").select(
        "block", "kind", "part", "low", "high", "shingles"
    )
    links = by_group(blocks, "block", _verify(percent), "a long, b long")
    groups = components(scratch, links)

    rooted = kinds.join(groups.withColumnRenamed("node", "kind"), "kind", "left").select(
        "kind", "first_id", F.coalesce("root", "kind").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = scratch.keep(rooted.join(smallest, "root").select("kind", "root", "component_id"), "components")
    out = signed.select("doc_id", "row", "n_shingles", "kind").join(named, "kind", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        "row",
        "root",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )

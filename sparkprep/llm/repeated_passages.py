"""Substring dedup: suffix automata of reference shards, matching statistics, maximal spans removed.

The reference is the corpus itself, which has no size bound and so is not broadcast: passages that may
repeat are brought to their shard, where an automaton of the shard's distinct passages is built and
every passage is streamed through it.

1. A window is ``length`` consecutive words. Its anchor is the run of ``ANCHOR`` words in it with the smallest
   hash (the first of equal ones), so equal windows have equal anchors. Consecutive windows with one
   anchor place are a passage; every window lies in exactly one passage.
2. Anchors are counted. A window under an anchor seen once repeats nowhere. Where all passages of an
   anchor are equal, all their windows repeat. Only the rest needs its words.
3. These passages are dealt to shards by anchor. A state of the automaton counts how often its
   substrings occur, so the longest repeated match that ends at each word is known; windows it covers repeat.
   An anchor with very many different passages is dealt by window instead, of which only those go on that
   have been counted more than once.
4. Repeated windows are told to their documents, which drop the covered words.

Which anchors repeat is told to the scanning tasks by bit maps of a fixed size. A bit that
is set wrongly costs time, not rightness.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.common import BitMap, Scratch, by_group
from sparkprep.llm.words import mix, windows, words

LENGTH = 35
ANCHOR = 12
_SEEN = 120_000  #: passages a task holds back, to send equal ones once
_PLACE = np.uint64(24)
_PLACES = np.uint64((1 << 24) - 1)


class Passages(NamedTuple):
    """Passages of one block of texts, in order."""

    text: np.ndarray  #: place of the text in the block
    start: np.ndarray  #: first word, counted from the block's first
    windows: np.ndarray  #: number of windows
    anchor: np.ndarray  #: hash of the anchor
    key: np.ndarray  #: hash of the passage's words
    window_hashes: np.ndarray  #: hash of the window that starts at each word of the block


def _sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def passages(block, length: int = LENGTH) -> Passages:
    anchor = min(ANCHOR, length)
    full = windows(block.hashes, length)
    grams = windows(block.hashes, anchor)
    n = len(full)
    if not n:
        none = np.empty(0, np.int64)
        return Passages(none, none, none, none, none, full)
    # Smallest hash first, then the first place; places count from the block's start.
    ranked = (grams >> _PLACE << _PLACE) | (np.arange(len(grams), dtype=np.uint64) & _PLACES)
    least = _sliding_minimum(ranked, length - anchor + 1)[:n]
    base = np.arange(n, dtype=np.uint64)
    place = (base + (((least & _PLACES) - base) & _PLACES)).astype(np.int64)
    text = np.repeat(np.arange(len(block.offsets) - 1), np.diff(block.offsets))
    inside = np.flatnonzero(text[:n] == text[length - 1 : length - 1 + n])
    if not len(inside):
        none = np.empty(0, np.int64)
        return Passages(none, none, none, none, none, full)
    new = np.ones(len(inside), dtype=bool)
    new[1:] = (place[inside[1:]] != place[inside[:-1]]) | (text[inside[1:]] != text[inside[:-1]])
    start = inside[new]
    count = np.diff(np.append(np.flatnonzero(new), len(inside)))
    shape = ((place[start] - start) * 4096 + count).astype(np.uint64)
    key = mix(mix(full[start] ^ shape) ^ full[start + count - 1])
    return Passages(text[start], start, count, grams[place[start]].view(np.int64), key.view(np.int64), full)


def _window_keys(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes + np.uint64(0x51ED270B)).view(np.int64)


def _kinds(length: int):
    """Anchors of each block with the passages below them, summed by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in words(batch.column("text")):
                found = passages(block, length)
                if not len(found.anchor):
                    continue
                order = np.argsort(found.anchor, kind="stable")
                anchor, key = found.anchor[order], found.key[order]
                first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
                bit = np.uint64(1) << (mix(key.view(np.uint64)) >> np.uint64(58))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[first]),
                        pa.array(np.diff(np.append(first, len(anchor)))),
                        pa.array(np.minimum.reduceat(key, first)),
                        pa.array(np.maximum.reduceat(key, first)),
                        pa.array(np.bitwise_or.reduceat(bit, first).view(np.int64)),
                    ],
                    ["anchor", "n", "low", "high", "sketch"],
                )

    return run


def _hot_windows(length: int, several, many):
    """(key, n) of the windows of passages under anchors with very many kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in words(batch.column("text")):
                found = passages(block, length)
                hot = np.flatnonzero(several.value.holds(found.anchor) & many.value.holds(found.anchor))
                if len(hot):
                    count = found.windows[hot]
                    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    start = np.repeat(found.start[hot], count) + step
                    key, n = np.unique(_window_keys(found.window_hashes[start]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    return run


def _to_shards(length: int, several, many, again):
    """Passages under anchors with several kinds: shard, key, times seen here, words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}

        def sent() -> pa.RecordBatch:
            rows = list(seen.items())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[1][0] for r in rows], pa.int64()),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1][1] for r in rows], pa.int64()),
                    pa.array([r[1][2] for r in rows], pa.list_(pa.int64())),
                ],
                ["shard", "key", "n", "words"],
            )

        for batch in batches:
            for block in words(batch.column("text")):
                found = passages(block, length)
                if not len(found.anchor):
                    continue
                wanted = np.flatnonzero(several.value.holds(found.anchor))
                hot = many.value.holds(found.anchor[wanted])
                own = block.hashes.view(np.int64)
                hot_keys = [
                    _window_keys(found.window_hashes[found.start[i] : found.start[i] + found.windows[i]])
                    for i in wanted[hot]
                ]
                wanted_windows = again.value.holds(np.concatenate([*hot_keys, np.empty(0, np.int64)]))
                at_window = 0
                for i, by_window in zip(wanted.tolist(), hot.tolist()):
                    start, count = int(found.start[i]), int(found.windows[i])
                    if by_window:
                        keys = _window_keys(found.window_hashes[start : start + count]).tolist()
                        rows = [(k, k, start + j, length) for j, k in enumerate(keys) if wanted_windows[at_window + j]]
                        at_window += count
                    else:
                        rows = [(int(found.key[i]), int(found.anchor[i]), start, count + length - 1)]
                    for key, shard, at, size in rows:
                        held = seen.get(key)
                        if held is None:
                            seen[key] = [shard, 1, own[at : at + size].copy()]
                        else:
                            held[1] += 1
                if len(seen) > _SEEN:
                    yield sent()
                    seen.clear()
        if seen:
            yield sent()

    return run


class SuffixAutomaton:
    """Suffix automaton of several word sequences with weights."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.weight = [0]

    def _state(self, length: int, link: int, after: dict[int, int]) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.weight.append(0)
        return len(self.link) - 1

    def _divided(self, at: int, word: int, to: int) -> int:
        """The state for ``at`` + ``word`` when its class holds longer substrings as well."""
        nexts, link = self.next, self.link
        copy = self._state(self.length[at] + 1, link[to], dict(nexts[to]))
        link[to] = copy
        while at >= 0 and nexts[at].get(word) == to:
            nexts[at][word] = copy
            at = link[at]
        return copy

    def add(self, sequence: list[int], weight: int) -> None:
        nexts, link, length = self.next, self.link, self.length
        last = 0
        for word in sequence:
            to = nexts[last].get(word)
            if to is not None:
                last = to if length[to] == length[last] + 1 else self._divided(last, word, to)
            else:
                new = self._state(length[last] + 1, 0, {})
                at = last
                while at >= 0 and word not in nexts[at]:
                    nexts[at][word] = new
                    at = link[at]
                if at >= 0:
                    to = nexts[at][word]
                    link[new] = to if length[to] == length[at] + 1 else self._divided(at, word, to)
                last = new
            self.weight[last] += weight

    def finish(self) -> None:
        """Sum the weights of all places where a state's substrings end."""
        for at in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[at] > 0:
                self.weight[self.link[at]] += self.weight[at]

    def repeated(self, sequence: list[int], length: int) -> int:
        """Bit i: the ``length`` words from word i on occur at least twice."""
        state, bits = 0, 0
        for i, word in enumerate(sequence):
            state = self.next[state][word]
            while self.length[self.link[state]] >= length:
                state = self.link[state]
            if i >= length - 1 and self.weight[state] > 1:
                bits |= 1 << (i - length + 1)
        return bits


def _judge(length: int):
    def run(table: pa.Table, bounds: np.ndarray) -> dict[str, object]:
        keys, times = table.column("key").to_pylist(), table.column("n").to_pylist()
        column = table.column("words").combine_chunks()
        values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
        key, bits = [], []
        for at, end in zip(bounds[:-1], bounds[1:]):
            total: dict[int, int] = {}
            place: dict[int, int] = {}
            for i in range(at, end):
                total[keys[i]] = total.get(keys[i], 0) + times[i]
                place.setdefault(keys[i], i)
            if len(place) == 1:
                (k, i), n = *place.items(), next(iter(total.values()))
                found = [(k, (1 << (int(offsets[i + 1] - offsets[i]) - length + 1)) - 1 if n > 1 else 0)]
            else:
                automaton = SuffixAutomaton()
                texts = {k: values[offsets[i] : offsets[i + 1]].tolist() for k, i in place.items()}
                for k, text in texts.items():
                    automaton.add(text, total[k])
                automaton.finish()
                found = [(k, automaton.repeated(text, length)) for k, text in texts.items()]
            for k, b in found:
                if b:
                    key.append(k)
                    bits.append(b)
        return {"key": np.array(key, np.int64), "bits": np.array(bits, np.int64)}

    return run


def _places(length: int, repeated, several, many, again):
    """(key, doc_id, row, start, windows) of the passages, or single windows, that may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row").to_numpy()
            doc = batch.column("doc_id").fill_null(0).to_numpy()
            null = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            for block in words(batch.column("text")):
                found = passages(block, length)
                if not len(found.anchor):
                    continue
                wanted = repeated.value.holds(found.anchor)
                hot = wanted & several.value.holds(found.anchor) & many.value.holds(found.anchor)
                plain = np.flatnonzero(wanted & ~hot)
                hot = np.flatnonzero(hot)
                count = found.windows[hot]
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                single, of = np.repeat(found.start[hot], count) + step, np.repeat(found.text[hot], count)
                own = _window_keys(found.window_hashes[single])
                kept = again.value.holds(own)
                single, of, own = single[kept], of[kept], own[kept]
                start, text = np.concatenate([found.start[plain], single]), np.concatenate([found.text[plain], of])
                at = block.first + text
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([found.key[plain], own])),
                        pa.array(doc[at], pa.int64(), mask=null[at]),
                        pa.array(row[at]),
                        pa.array((start - block.offsets[text]).astype(np.int32)),
                        pa.array(np.concatenate([found.windows[plain], np.ones(len(own), np.int64)]).astype(np.int32)),
                    ],
                    ["key", "doc_id", "row", "start", "windows"],
                )

    return run


def _cut(length: int, touched=None):
    """Words and text without the covered words; given a map, of the texts it does not hold, which lose none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if touched is None:
                spans = batch.column("spans").to_pylist()
            else:
                batch = batch.filter(pa.array(~touched.value.holds(batch.column("key").to_numpy())))
                spans = [None] * batch.num_rows
            total, removed, kept = [], [], []
            for block in words(batch.column("text")):
                cover = np.zeros(len(block.hashes) + 1, dtype=np.int64)
                for i in range(len(block.offsets) - 1):
                    for span in spans[block.first + i] or ():
                        at = int(block.offsets[i]) + span["start"]
                        bits = span["bits"] & ((1 << span["windows"]) - 1)
                        while bits:
                            step = (bits & -bits).bit_length() - 1
                            run_length = (~(bits >> step) & ((bits >> step) + 1)).bit_length() - 1
                            cover[at + step] += 1
                            cover[at + step + run_length - 1 + length] -= 1
                            bits &= ~(((1 << run_length) - 1) << step)
                gone = np.cumsum(cover[:-1]) > 0
                sizes = (block.ends - block.starts + 1)[~gone]
                before = np.concatenate([[0], np.cumsum(sizes)])
                out = np.full(before[-1], 0x20, dtype=np.uint8)
                place = np.arange(before[-1]) - np.repeat(before[:-1], sizes)
                source = np.repeat(block.starts[~gone], sizes) + place
                real = place < np.repeat(sizes - 1, sizes)
                out[real] = block.data[source[real]]
                kept_before = np.concatenate([[0], np.cumsum(~gone)])[block.offsets]
                for i in range(len(block.offsets) - 1):
                    n, k = int(block.offsets[i + 1] - block.offsets[i]), int(kept_before[i + 1] - kept_before[i])
                    total.append(n)
                    removed.append(n - k)
                    text = out[before[kept_before[i]] : before[kept_before[i + 1]]]
                    kept.append(text[:-1].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeated_passages(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept), one row per row of ``docs`` (doc_id, text).

    Every word is dropped that lies in a window of ``length`` (at most 63) words whose sequence also starts at
    another place of any row, its own included. ``kept`` joins the other words by one space. Windows are
    judged on the input: no copy is spared, and what is left is not judged again.

    Null and empty texts have no words; a text shorter than a window keeps all. Repeated rows are
    places of their own, so both lose what they share. Rows are told apart by doc_id and text, so a null
    or repeated doc_id does no harm. Further columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeated-passages")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = texts.select("text").mapInArrow(_kinds(length), "anchor long, n long, low long, high long, sketch long")
    kinds = kinds.groupBy("anchor").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.bit_or("sketch").alias("sketch")
    )
    kinds = scratch.keep(
        kinds.where("n > 1").select(
            "anchor", "low", (F.col("low") != F.col("high")).alias("several"), (F.bit_count("sketch") >= 62).alias("many")
        ),
        "anchors",
    )
    several = spark.sparkContext.broadcast(BitMap.of(kinds.where("several"), "anchor"))
    many = spark.sparkContext.broadcast(BitMap.of(kinds.where("several and many"), "anchor"))
    repeated = spark.sparkContext.broadcast(BitMap.of(kinds, "anchor"))

    hot = texts.select("text").mapInArrow(_hot_windows(length, several, many), "key long, n long")
    hot = hot.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
    again = spark.sparkContext.broadcast(BitMap.of(hot, "key"))

    shards = texts.select("text").mapInArrow(
        _to_shards(length, several, many, again), "shard long, key long, n long, words array<long>"
    )
    judged = by_group(shards, "shard", _judge(length), "key long, bits long")
    # All windows of the only kind under an anchor repeat. The maps may have sent it to a shard as well.
    plain = kinds.where("not several").select(F.col("low").alias("key"), F.lit(-1).cast("long").alias("bits"))
    found = scratch.keep(judged.unionByName(plain).groupBy("key").agg(F.max("bits").alias("bits")), "found")

    keyed = texts.withColumn("row", F.xxhash64("text"))
    places = keyed.mapInArrow(
        _places(length, repeated, several, many, again), "key long, doc_id long, row long, start int, windows int"
    )
    spans = places.join(found, "key").groupBy("doc_id", "row")
    spans = scratch.keep(
        spans.agg(F.collect_list(F.struct("start", "windows", "bits")).alias("spans")).withColumnsRenamed(
            {"doc_id": "__doc_id", "row": "__row"}
        ),
        "spans",
    )
    # Texts without a repeated window stay where they are; only the others are moved to their spans.
    place = F.xxhash64("doc_id", "row")
    touched = BitMap.of(spans.select(F.xxhash64("__doc_id", "__row").alias("key")), "key")
    keyed = keyed.withColumn("key", place)
    same = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & F.col("row").eqNullSafe(F.col("__row"))
    joined = touched.sift(keyed, "key").join(spans.hint("merge"), same, "left")
    schema = "doc_id long, n_words long, n_removed long, kept string"
    shared = spark.sparkContext.broadcast(touched)
    whole = keyed.select("doc_id", "text", "key").mapInArrow(_cut(length, shared), schema)
    return whole.unionByName(joined.select("doc_id", "text", "spans").mapInArrow(_cut(length), schema))

"""Best-fit packing by the sum of squares: tokenised documents into sequences of fixed length.

A document's pieces are placed, longest first, where the sum over all gaps of the squared number of open
sequences with that gap becomes smallest; equal places go to the smallest gap.

Documents are tokenised once, in the tasks that read them; from then on only lengths are
moved. Pieces are dealt to groups by hash and packed there. Sequences that stay poorly filled are taken
apart and packed again with those of other groups, in fewer groups each round.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.common import Scratch, by_group
from sparkprep.llm.words import blocks, joined_words, words_of

LENGTH = 4096
END_ID = 1
GROUP = 40_000  #: pieces of one group
KEEP_GAP = 0.01  #: a sequence with a larger share unfilled is packed again
#: Share of sequences that a further round must save, and the rounds that sequence_id has room for.
LEAST_GAIN, MOST_ROUNDS = 0.02, 60
_CACHED = 2_000_000  #: words whose ids a worker keeps

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in ".,;:!?$%&#*()"]] = True

_caches: dict[str, _Ids] = {}


def _units(block_bytes: np.ndarray) -> np.ndarray:
    """Places where a letter meets plain punctuation, which the tokenizer always parts.

    Only ASCII letters and those of the bytes C3 80 to C3 BF count as letters, and only marks that
    are in no contraction as punctuation, so every cut is one the tokenizer makes itself.
    """
    data = block_bytes
    letter = _LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    begins = _LETTER[data]
    begins[:-1] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    mark = _MARK[data]
    return 1 + np.flatnonzero(letter[:-1] & mark[1:] | mark[:-1] & begins[1:])


class _Ids:
    """Token ids of words, found once per worker.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its
    words one after another. New words are encoded together, parted by a special token.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder().items()
        self.mark = next(
            ((i, t.content) for i, t in special if not (t.lstrip or t.rstrip or t.normalized or t.single_word)), None
        )
        self.clear()

    def clear(self) -> None:
        self.hashes = np.empty(0, dtype=np.uint64)  # sorted
        self.starts = np.empty(0, dtype=np.int64)
        self.lengths = np.empty(0, dtype=np.int64)
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0

    def _encoded(self, block, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words ``at`` one after another, and the number of each."""
        if self.mark:
            number, mark = self.mark
            glue = np.frombuffer(mark.encode(), dtype=np.uint8)
            sizes = block.ends[at] - block.starts[at]
            text = joined_words(block, at, glue)
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
            cuts = np.flatnonzero(ids == number)
            if len(cuts) == len(sizes):
                lengths = np.diff(cuts, prepend=-1) - 1
                return ids[ids != number], lengths
        # No special token to part the words by, or a word that holds its text.
        texts = [block.data[s:e].tobytes().decode("utf-8") for s, e in zip(block.starts[at], block.ends[at])]
        found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        lengths = np.array([len(x) for x in found], dtype=np.int64)
        return np.array([i for x in found for i in x], dtype=np.uint32), lengths

    def _add(self, block, hashes: np.ndarray, at: np.ndarray) -> None:
        starts, lengths = [], []
        for i in range(0, len(at), 20_000):
            ids, n = self._encoded(block, at[i : i + 20_000])
            while self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used : self.used + len(ids)] = ids
            starts.append(self.used + np.cumsum(n) - n)
            lengths.append(n)
            self.used += len(ids)
        place = np.searchsorted(self.hashes, hashes)
        self.starts = np.insert(self.starts, place, np.concatenate(starts))
        self.lengths = np.insert(self.lengths, place, np.concatenate(lengths))
        self.hashes = np.insert(self.hashes, place, hashes)

    def of(self, block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of a block, and how many ids come before each of its texts."""
        if len(self.hashes) > _CACHED:
            self.clear()
        distinct, first, inverse = np.unique(block.hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = place < len(self.hashes)
        new[inside] = self.hashes[place[inside]] != distinct[inside]
        if new.any():
            self._add(block, distinct[new], first[new])
            place = np.searchsorted(self.hashes, distinct)
        place = place[inverse]
        lengths = self.lengths[place]
        before = np.concatenate([[0], np.cumsum(lengths)])
        spread = np.repeat(self.starts[place] - before[:-1], lengths) + np.arange(before[-1])
        return self.flat[spread], before[block.offsets]


def word_units(first: int, data: np.ndarray, texts: np.ndarray):
    """The parts of a block of texts that the tokenizer encodes each on its own, lower-cased.

    The tokenizer lowers letters itself; a block that may hold the text of a special token, where
    case matters, is left as it is.
    """
    special = b"<|" in data.tobytes()
    return words_of(data, texts, first, lower=not special, cuts=None if special else _units(data))


def _tokenised(path: str, length: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _caches.get(path) or _caches.setdefault(path, _Ids(path))
        for batch in batches:
            ids_of = batch.column("doc_id").cast(pa.int64())
            for first, data, texts in blocks(batch.column("text")):
                block = word_units(first, data, texts)
                ids, before = cache.of(block)
                at, piece, start, size, crc, kept = [], [], [], [], [], []
                for i in range(len(before) - 1):
                    own = np.empty(before[i + 1] - before[i] + 1, dtype="<u4")
                    own[:-1], own[-1] = ids[before[i] : before[i + 1]], end_id
                    for k, s in enumerate(range(0, len(own), length)):
                        part = own[s : s + length]
                        at.append(block.first + i)
                        piece.append(k)
                        start.append(s)
                        size.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            kept.append(part.astype(np.int32))
                columns = [
                    ids_of.take(pa.array(at, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pieces(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document of ``docs`` (doc_id, text).

    A document is the ids of its whole text (null: none) and ``end_id``; only one longer than
    ``length`` is cut. ``tokenizer`` is the path of a tokenizer file on every machine, whose tokenizer
    must drop white space.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(
        _tokenised(tokenizer, length, end_id, with_ids), schema + (", ids array<int>" if with_ids else "")
    )


def sum_of_squares(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each size, which must come in the order of placing."""
    counts = np.zeros(length + 1, dtype=np.int64)  # open sequences by gap
    open_ones: list[list[int]] = [[] for _ in range(length + 1)]
    sequence = np.zeros(len(sizes), dtype=np.int64)
    offset = np.zeros(len(sizes), dtype=np.int64)
    never, n = np.int64(1) << 40, 0
    for i, s in enumerate(sizes.tolist()):
        # Change of the sum of squares when a gap g becomes g - s.
        fitting = counts[s:length]
        best = -1
        if len(fitting):
            change = 2 * (counts[: length - s] - fitting) + 2
            change[0] = 1 - 2 * fitting[0]
            change[fitting == 0] = never
            best = int(change.argmin())
            if change[best] > 2 * counts[length - s] + 1:
                best = -1
        if best < 0:
            gap, own = length, n
            n += 1
        else:
            gap = s + best
            counts[gap] -= 1
            own = open_ones[gap].pop()
        sequence[i], offset[i] = own, length - gap
        if gap > s:
            counts[gap - s] += 1
            open_ones[gap - s].append(own)
    return sequence, offset


def _packed(length: int):
    def run(table: pa.Table, bounds: np.ndarray) -> dict[str, object]:
        sizes = table.column("length").to_numpy()
        keys = [table.column(c).to_numpy(zero_copy_only=False) for c in ("ids_crc32", "piece")]
        ids = table.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
        sequence = np.zeros(len(sizes), dtype=np.int64)
        offset = np.zeros(len(sizes), dtype=np.int64)
        gap = np.zeros(len(sizes), dtype=np.int64)
        for at, end in zip(bounds[:-1], bounds[1:]):
            order = at + np.lexsort((keys[0][at:end], keys[1][at:end], ids[at:end], -sizes[at:end]))
            sequence[order], offset[order] = sum_of_squares(sizes[order], length)
            filled = np.bincount(sequence[at:end], weights=sizes[at:end]).astype(np.int64)
            gap[at:end] = length - filled[sequence[at:end]]
        out = {c: table.column(c).combine_chunks() for c in ("doc_id", "piece", "start", "length", "ids_crc32", "grp")}
        return out | {"bin": sequence, "offset": offset, "gap": gap}

    return run


def packed(parts: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``parts`` (columns of ``pieces``) with sequence_id and offset.

    Pieces are packed in groups of about ``group``. Those of poorly filled sequences are dealt anew, until they fit one
    group or a round no longer saves ``LEAST_GAIN`` of their sequences; no group grows with the corpus. Whole sequences need no packing. Rows that repeat a piece are placed each on its own. A sequence
    is numbered by round, group and place in the group, a whole one by its row.
    """
    scratch = Scratch(parts.sparkSession, "packing")
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    parts = scratch.keep(parts.select(*kept), "pieces")
    number = F.lit(1 << 62) + F.monotonically_increasing_id()
    out = parts.where(F.col("length") >= length).select(
        *kept, number.alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long, grp long, bin long, offset long, gap long"
    )
    left, turn = parts.where(F.col("length") < length), 0
    again = F.col("gap") > int(length * KEEP_GAP)
    sequences = F.coalesce(F.sum((F.col("offset") == 0).cast("long")), F.lit(0))

    def numbered(rows: DataFrame, turn: int) -> DataFrame:
        sequence = F.lit(turn << 56) + F.shiftleft("grp", 24) + F.col("bin")
        return rows.select(*kept, sequence.alias("sequence_id"), "offset")

    groups, before = -(-left.count() // group), None
    while groups:
        salt = F.xxhash64(F.lit(turn), "doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())
        dealt = left.select(*kept, F.pmod(salt, F.lit(groups)).alias("grp"))
        # Written before it is read twice, so that both readings see one dealing.
        done = scratch.keep(by_group(dealt, "grp", _packed(length), schema), f"round-{turn}")
        now = done.agg(sequences).first()[0]
        if before is not None and now >= before:
            out = out.unionByName(numbered(left, turn - 1))
            break
        if groups == 1 or turn == MOST_ROUNDS or before is not None and now > (1 - LEAST_GAIN) * before:
            out = out.unionByName(numbered(done, turn))
            break
        out = out.unionByName(numbered(done.where(~again), turn))
        left, turn = done.where(again), turn + 1
        count, before = left.agg(F.count("*"), sequences).first()
        groups = -(-count // group)
    return out


def pack_documents(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, group: int = GROUP
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of ``docs``.

    Null and empty texts are documents of the end id alone. Rows that repeat a doc_id are packed each;
    a null doc_id stays null. Further columns of ``docs`` are ignored; an empty table gives no rows.
    """
    return packed(pieces(docs, tokenizer, length, end_id), length, group)

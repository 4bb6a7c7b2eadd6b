"""Cross-tokenizer alignment: texts cut into groups at the bytes where the tokens of two tokenizers both end.

A byte range of a text is a *fragment*: the tokens that end in it, as an open prefix (up to
the first byte where both tokenizers end a token), closed groups, and an open suffix. Fragments of
neighbouring ranges compose: the left one's suffix and the right one's prefix make one more closed group. Composition is
associative, so the fragments of a very long text, made by different tasks, are reduced as a tree.

A range's tokens do not depend on where it was cut: each task tokenises from the last place before it to
the first place after it where both tokenizers surely part the text.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.common import Scratch, by_group

RANGE = 32 << 10  #: bytes of one range
LONG = 64 << 10  #: longer texts are dealt to several tasks by range
FAN_IN = 8  #: fragments that one step of the tree composes


#: How byte-level tokenizers part a text before they merge bytes (fixed value of the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokenizers:
    """Both tokenizers of a worker, with the bytes of every token.

    ``a`` is the JSON file of a byte-level tokenizer, ``b`` a sentencepiece model that puts a space before
    the text. Strings of special tokens in a text are plain text to both.
    """

    _loaded: dict[tuple[str, str], Tokenizers] = {}

    @classmethod
    def of(cls, a: str, b: str) -> Tokenizers:
        return cls._loaded.get((a, b)) or cls._loaded.setdefault((a, b), cls(a, b))

    def __init__(self, a: str, b: str):
        from sentencepiece import SentencePieceProcessor

        self.bytes_a, self.encode_a = _byte_level(a)
        self.b = SentencePieceProcessor(model_file=b)
        self.bytes_b = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.bytes_b.append(bytes([int(piece[3:5], 16)]))
            else:
                self.bytes_b.append(piece.replace("▁", " ").encode())
        self.table_a, self.table_b = _Table(self.bytes_a), _Table(self.bytes_b)
        self.names_a = [f"{i}{end}" for end in ",|" for i in range(len(self.bytes_a))]
        self.names = self.names_a + [f"{i}{end}" for end in ",;" for i in range(len(self.bytes_b))]
        self.pairs = self._possible_pairs()

    def _possible_pairs(self) -> np.ndarray:
        """Every pair of ids whose tokens can end together, as a * size of B + b, sorted.

        The bytes of one must end in those of the other, so there is at most one token of each
        tokenizer's bytes for each suffix of a token of the other: this bounds every table of pairs, however large the corpus.
        """
        out = set()
        size = len(self.bytes_b)
        for mine, other, swap in ((self.bytes_a, self.bytes_b, False), (self.bytes_b, self.bytes_a, True)):
            ids: dict[bytes, list[int]] = {}
            for i, x in enumerate(other):
                ids.setdefault(x, []).append(i)
            for i, x in enumerate(mine):
                for k in range(len(x)):
                    for j in ids.get(x[k:], ()):
                        out.add(j * size + i if swap else i * size + j)
        return np.array(sorted(out), dtype=np.int64)

    def encode(self, windows: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]]:
        """Ids and ends of both tokenizers for bytes that begin with a space; whether both give exactly these bytes."""
        texts = [w.decode("utf-8") for w in windows]
        ids_b = self.b.encode([t[1:] for t in texts], num_threads=1)
        for window, text, b in zip(windows, texts, ids_b):
            a, b = np.array(self.encode_a(text), dtype=np.int64), np.array(b, dtype=np.int64)
            data = np.frombuffer(window, dtype=np.uint8)
            same = self.table_a.spells(a, data) and self.table_b.spells(b, data)
            yield a, b, np.cumsum(self.table_a.lengths[a]), np.cumsum(self.table_b.lengths[b]), same


class _Table:
    """The bytes of all tokens in one array."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(x) for x in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def spells(self, ids: np.ndarray, data: np.ndarray) -> bool:
        sizes = self.lengths[ids]
        if sizes.sum() != len(data):
            return False
        place = np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(data))
        return bool((self.flat[place] == data).all())


def _byte_level(path: str) -> tuple[list[bytes], Callable[[str], list[int]]]:
    """Bytes of each token of a byte-level tokenizer file, and a function from a text to ids.

    Where merges are numbered as their tokens, which the format's makers do, ids serve as ranks for the faster
    of two libraries; other files are read by the one that knows them.
    """
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    special = {t["id"] for t in told["added_tokens"]}
    byte_of = _byte_alphabet()
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    tokens = [b""] * size
    for token, i in told["model"]["vocab"].items():
        tokens[i] = token.encode() if i in special else bytes(byte_of[c] for c in token)
    merges = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
    first = size - len(merges) - len(special)
    plain = told["normalizer"] is None and told["pre_tokenizer"] == {
        "type": "ByteLevel",
        "add_prefix_space": False,
        "trim_offsets": told["pre_tokenizer"].get("trim_offsets"),
        "use_regex": True,
    }
    vocabulary = told["model"]["vocab"]
    if plain and first == 256 and all(vocabulary["".join(m)] == first + k for k, m in enumerate(merges)):
        import tiktoken

        ranks = {x: i for i, x in enumerate(tokens) if i not in special}
        return tokens, tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return tokens, lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def _byte_alphabet() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies are written in.

    Printable bytes stand for themselves; the others follow, in order, from code point 256.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [i for i in range(256) if i not in plain]
    return {chr(i): i for i in plain} | {chr(256 + k): i for k, i in enumerate(rest)}


_GRAPHIC = np.zeros(256, dtype=bool)
_GRAPHIC[0x21:0x7F] = True


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """Places where both tokenizers part bytes: a space between two printable ASCII characters that are none."""
    cut = data == 0x20
    cut[0] = cut[-1] = False
    cut[1:-1] &= _GRAPHIC[data[:-2]] & _GRAPHIC[data[2:]]
    return np.flatnonzero(cut)


def ranges(data: np.ndarray, size: int) -> list[tuple[int, int, int, int]]:
    """(start, end, window start, window end) of the ranges of a text.

    Ranges are cut every ``size`` bytes, unless no safe place is near the cut; windows reach from safe place
    to safe place, so they are at most ``size`` longer at each end.
    """
    n = len(data)
    safe = np.concatenate([[0], safe_cuts(data) if n > 2 else np.empty(0, np.int64), [n]])
    at = np.arange(size, n, size)
    before = safe[np.searchsorted(safe, at, side="right") - 1]
    after = safe[np.searchsorted(safe, at)]
    near = (at - before < size) & (after - at < size)
    starts = np.concatenate([[0], at[near]])
    ends = np.concatenate([at[near], [n]])
    lows = np.concatenate([[0], before[near]])
    highs = np.concatenate([after[near], [n]])
    return [tuple(map(int, r)) for r in zip(starts, ends, lows, highs)]


class Fragment(NamedTuple):
    """Tokens that end in one range of a text."""

    n_a: int
    n_b: int
    exact: bool  #: whether both tokenizers give the bytes of the text
    closed: bool  #: whether some byte ends a token of both
    prefix_a: np.ndarray  #: up to the first such byte (all tokens where there is none)
    prefix_b: np.ndarray
    groups: str  #: closed groups, each followed by ``;``
    suffix_a: np.ndarray  #: after the last such byte
    suffix_b: np.ndarray
    links: np.ndarray  #: pairs (as numbers) that end together, one for each such byte

    @classmethod
    def none(cls) -> Fragment:
        e = np.empty(0, dtype=np.int64)
        return cls(0, 0, True, False, e, e, "", e, e, e)


def _group(tokens: Tokenizers, a: np.ndarray, b: np.ndarray) -> str:
    return f"{','.join(map(str, a.tolist()))}|{','.join(map(str, b.tolist()))};"


def fragment(tokens: Tokenizers, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, exact: bool) -> Fragment:
    """The fragment of tokens with the bytes where they end."""
    if not exact:
        return Fragment.none()._replace(exact=False)
    low = int(min(ends_a[:1].min(initial=0), ends_b[:1].min(initial=0)))
    ends = np.zeros((2, int(max(ends_a[-1:].max(initial=0), ends_b[-1:].max(initial=0))) - low + 1), dtype=bool)
    ends[0, ends_a - low] = ends[1, ends_b - low] = True
    both_a, both_b = ends[1, ends_a - low], ends[0, ends_b - low]
    ia, ib = np.flatnonzero(both_a), np.flatnonzero(both_b)
    e = np.empty(0, dtype=np.int64)
    if not len(ia):
        return Fragment(len(a), len(b), True, False, a, b, "", e, e, e)
    links = a[ia] * len(tokens.bytes_b) + b[ib]
    first_a, first_b, last_a, last_b = ia[0] + 1, ib[0] + 1, ia[-1] + 1, ib[-1] + 1
    # Closed groups written in one go: each token's place among those of all groups, and its name with what follows it.
    in_a, in_b = np.arange(first_a, last_a), np.arange(first_b, last_b)
    last_of_a, last_of_b = both_a[first_a:last_a], both_b[first_b:last_b]
    group_a = 1 + np.cumsum(last_of_a) - last_of_a
    group_b = 1 + np.cumsum(last_of_b) - last_of_b
    place_a = in_a - first_a + ib[group_a - 1] + 1 - first_b
    place_b = in_b - first_b + ia[group_b] + 1 - first_a
    names = np.empty(len(in_a) + len(in_b), dtype=np.int64)
    names[place_a] = a[in_a] + len(tokens.bytes_a) * last_of_a
    names[place_b] = len(tokens.names_a) + b[in_b] + len(tokens.bytes_b) * last_of_b
    groups = "".join(map(tokens.names.__getitem__, names.tolist()))
    return Fragment(
        len(a), len(b), True, True, a[:first_a], b[:first_b], groups, a[last_a:], b[last_b:], links
    )


def composed(tokens: Tokenizers, x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges; associative, with ``Fragment.none()`` as identity."""
    if not (x.exact and y.exact):
        return Fragment.none()._replace(exact=False)
    join = np.concatenate
    n_a, n_b = x.n_a + y.n_a, x.n_b + y.n_b
    links = join([x.links, y.links])
    if not x.closed:
        a, b = join([x.prefix_a, y.prefix_a]), join([x.prefix_b, y.prefix_b])
        return y._replace(n_a=n_a, n_b=n_b, prefix_a=a, prefix_b=b)
    if not y.closed:
        a, b = join([x.suffix_a, y.prefix_a]), join([x.suffix_b, y.prefix_b])
        return x._replace(n_a=n_a, n_b=n_b, suffix_a=a, suffix_b=b)
    middle = _group(tokens, join([x.suffix_a, y.prefix_a]), join([x.suffix_b, y.prefix_b]))
    groups = x.groups + middle + y.groups
    return Fragment(
        n_a, n_b, True, True, x.prefix_a, x.prefix_b, groups, y.suffix_a, y.suffix_b, links
    )


def range_fragments(tokens: Tokenizers, windows: list[tuple[bytes, int, int, int]]) -> Iterator[Fragment]:
    """The fragment of each range, from (window, where the window begins, start and end of the range)."""
    found = tokens.encode([w for w, *_ in windows])
    for (a, b, ends_a, ends_b, exact), (_, low, start, end) in zip(found, windows):
        own_a = slice(*np.searchsorted(ends_a, (start - low, end - low), side="right"))
        own_b = slice(*np.searchsorted(ends_b, (start - low, end - low), side="right"))
        yield fragment(tokens, a[own_a], b[own_b], ends_a[own_a] + low, ends_b[own_b] + low, exact)


_WHOLE = "doc_id long, n_a long, n_b long, n_groups long, groups string, pairs array<int>, times array<int>"


def whole_row(tokens: Tokenizers, f: Fragment) -> tuple:
    """Columns of ``_WHOLE`` after doc_id, of the fragment of a whole text.

    A text begins and ends where a token of both does, so its prefix is a group and nothing is left open.
    """
    if not (f.exact and f.closed):
        return 0, 0, 0, "", [], []
    groups = (_group(tokens, f.prefix_a, f.prefix_b) + f.groups)[:-1]
    pairs, times = np.unique(f.links, return_counts=True)
    places = np.searchsorted(tokens.pairs, pairs)
    return f.n_a, f.n_b, len(f.links), groups, places.astype(np.int32), times.astype(np.int32)


def _whole_batch(ids: list, rows: list[tuple], digest: bool) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in range(6)]
    groups = columns[3]
    if digest:
        groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            *(pa.array(columns[k], pa.int64()) for k in range(3)),
            pa.array(groups, pa.string()),
            *(pa.array(list(columns[k]), pa.list_(pa.int32())) for k in (4, 5)),
        ],
        ["doc_id", "n_a", "n_b", "n_groups", "groups", "pairs", "times"],
    )


def _short(a: str, b: str, digest: bool):
    """Tasks that align whole texts of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokenizers.of(a, b)
        for batch in batches:
            for s in range(0, batch.num_rows, 200):
                part = batch.slice(s, 200)
                texts = part.column("text").to_pylist()
                windows = [b" " + t.encode() for t in texts if t]
                done = range_fragments(tokens, [(w, 0, 0, len(w)) for w in windows])
                rows = [whole_row(tokens, next(done) if t else Fragment.none()) for t in texts]
                yield _whole_batch(part.column("doc_id").to_pylist(), rows, digest)

    return run


def _dealt(size: int):
    """Tasks that cut long texts into ranges with their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "number", "ranges", "low", "start", "end", "window"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for row, doc, text in zip(*(batch.column(c) for c in ("row", "doc_id", "text"))):
                whole = b" " + text.as_py().encode()
                found = ranges(np.frombuffer(whole, dtype=np.uint8), size)
                # One batch holds about 4 MB of windows.
                for s in range(0, len(found), 64):
                    out = [
                        (row.as_py(), doc.as_py(), s + k, len(found), low, start, end, whole[low:high])
                        for k, (start, end, low, high) in enumerate(found[s : s + 64])
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return run


_STATE = (
    "row long, doc_id long, number long, ranges long, n_a long, n_b long, exact boolean, closed boolean, prefix_a array<int>, "
    "prefix_b array<int>, groups string, suffix_a array<int>, suffix_b array<int>, links array<long>"
)
_FIELDS = [part.split()[0] for part in _STATE.split(", ")]


def _state_types() -> list[pa.DataType]:
    ids, n = pa.list_(pa.int32()), pa.int64()
    return [n, n, n, n, n, n, pa.bool_(), pa.bool_(), ids, ids, pa.string(), ids, ids, pa.list_(n)]


def _state_columns(rows: list[tuple]) -> list[pa.Array]:
    """Arrays of ``_STATE`` from (row, doc_id, number, ranges, *fragment)."""
    return [pa.array(list(c), t) for c, t in zip(zip(*rows), _state_types())]


def _range_states(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokenizers.of(a, b)
        for batch in batches:
            for s in range(0, batch.num_rows, 64):
                part = batch.slice(s, 64).to_pylist()
                done = range_fragments(tokens, [(r["window"], r["low"], r["start"], r["end"]) for r in part])
                rows = [(r["row"], r["doc_id"], r["number"], r["ranges"], *f) for r, f in zip(part, done)]
                yield pa.RecordBatch.from_arrays(_state_columns(rows), _FIELDS)

    return run


def _joined_states(a: str, b: str):
    """Groups of up to ``FAN_IN`` neighbouring fragments become one."""

    def run(table: pa.Table, bounds: np.ndarray) -> dict[str, object]:
        tokens = Tokenizers.of(a, b)
        rows = []
        for s, e in zip(bounds[:-1], bounds[1:]):
            parts = sorted(table.slice(s, e - s).to_pylist(), key=lambda r: r["number"])
            whole = Fragment.none()
            for r in parts:
                lists = {k: np.array(r[k], dtype=np.int64) for k in _FIELDS if isinstance(r[k], list)}
                whole = composed(tokens, whole, Fragment(**{k: lists.get(k, r[k]) for k in Fragment._fields}))
            first = parts[0]
            rows.append((first["row"], first["doc_id"], first["number"] // FAN_IN, -(-first["ranges"] // FAN_IN), *whole))
        return dict(zip(_FIELDS, _state_columns(rows)))

    return run


def _finished(a: str, b: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokenizers.of(a, b)
        for batch in batches:
            for s in range(0, batch.num_rows, 16):
                part = batch.slice(s, 16)
                rows = []
                for r in part.to_pylist():
                    lists = {k: np.array(r[k], dtype=np.int64) for k in _FIELDS if isinstance(r[k], list)}
                    rows.append(whole_row(tokens, Fragment(**{k: lists.get(k, r[k]) for k in Fragment._fields})))
                yield _whole_batch(part.column("doc_id").to_pylist(), rows, digest)

    return run


def aligned(
    docs: DataFrame, a: str, b: str, digest: bool = False, size: int = RANGE, long: int = LONG
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups, pairs and times of every row of ``docs`` (doc_id, text).

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` (or its SHA-256 with ``digest``; empty where there are no tokens); ``pairs`` are the
    distinct pairs of tokens that end together, as places in ``Tokenizers.pairs``, and ``times`` how often each does.

    Null and empty texts have no tokens, and neither has a text whose bytes either tokenizer does not give back. Every
    row is aligned on its own, also one that repeats another; a null doc_id stays null. Further columns are
    ignored; an empty table gives no rows. Texts of more than ``long`` bytes are dealt to tasks by ranges of ``size`` bytes.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    many = F.coalesce(F.octet_length("text"), F.lit(0)) > long
    done = scratch.keep(texts.where(~many).mapInArrow(_short(a, b, digest), _WHOLE), "short")
    numbered = texts.where(many).withColumn("row", F.monotonically_increasing_id())
    schema = "row long, doc_id long, number long, ranges long, low long, start long, end long, window binary"
    dealt = scratch.keep(numbered.mapInArrow(_dealt(size), schema), "ranges")
    most = dealt.agg(F.max("ranges")).first()[0]
    if most is None:
        scratch.drop(dealt)
        return done
    spread = dealt.repartition("row", "number")
    states = scratch.keep(spread.mapInArrow(_range_states(a, b), _STATE), "fragments")
    scratch.drop(dealt)
    while most > 1:
        keyed = states.withColumn("key", F.xxhash64("row", F.floor(F.col("number") / FAN_IN)))
        joined = scratch.keep(by_group(keyed, "key", _joined_states(a, b), _STATE), "fragments")
        scratch.drop(states)
        states, most = joined, -(-most // FAN_IN)
    last = scratch.keep(states.mapInArrow(_finished(a, b, digest), _WHOLE), "long")
    scratch.drop(states)
    return done.unionByName(last)


def _counted(n_pairs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_pairs, dtype=np.int64)
        for batch in batches:
            pairs, times = (batch.column(c).flatten().to_numpy() for c in ("pairs", "times"))
            counts += np.bincount(pairs, weights=times, minlength=n_pairs).astype(np.int64)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["pair", "n"])

    return run


def link_counts(rows: DataFrame, a: str, b: str) -> np.ndarray:
    """How many links of the whole corpus hold each possible pair.

    Counts are merged per task; their number is bounded by the two vocabularies (``Tokenizers.pairs``).
    """
    n = len(Tokenizers.of(a, b).pairs)
    partial = rows.select("pairs", "times").mapInArrow(_counted(n), "pair long, n long")
    found = partial.groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(n, dtype=np.int64)
    counts[found["pair"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


def with_link_counts(rows: DataFrame, a: str, b: str) -> DataFrame:
    """``rows`` of ``aligned`` with n_links, n_best and count_sum in place of pairs and times.

    ``n_best`` counts the links whose pair is the most frequent of the corpus for its token of B (ties
    included), ``count_sum`` adds up how often each link's pair is linked in the corpus.
    """
    counts = link_counts(rows, a, b)
    of_b = Tokenizers.of(a, b).pairs % len(Tokenizers.of(a, b).bytes_b)
    most = np.zeros(of_b.max(initial=0) + 1, dtype=np.int64)
    np.maximum.at(most, of_b, counts)
    shared = rows.sparkSession.sparkContext.broadcast((counts, counts == most[of_b]))
    kept = [c for c in rows.columns if c not in ("pairs", "times")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            pairs, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
            sums = []
            cuts = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))])
            for value in (times, times * best[pairs], times * counts[pairs]):
                before = np.concatenate([[0], np.cumsum(value)])
                sums.append(pa.array(before[cuts[1:]] - before[cuts[:-1]]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *sums], [*kept, "n_links", "n_best", "count_sum"]
            )

    return rows.mapInArrow(run, schema + ", n_links long, n_best long, count_sum long")

"""Document fingerprints (I-Match): terms in a band of inverse document frequency, random lexicon subsets.

The distinct terms of a text that lie in the band are hashed once whole and once for each random subset of
the lexicon. Subsets come in ``SUBSETS`` chains; each next one of a chain keeps about half of the terms of the
one before, so that short and long texts both have subsets that hold a few of their terms.
Two fingerprints are alike in the share of equal subset hashes, at the finest halving where at
least half of the chains hold a term.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.common import BitMap
from sparkprep.llm.words import BLOCK, mix, words

SUBSETS, HALVINGS = 32, 12
#: Shares of all documents that hold a term: ln of the inverse is the IDF band (1.6 to 7.6).
MOST, LEAST = 0.2, 0.0005
MAX_TERMS = 4_000_000

_SALTS = mix(np.arange(1, SUBSETS + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def _distinct(block) -> Iterator[np.ndarray]:
    """Sorted distinct terms of each text."""
    for i in range(len(block.offsets) - 1):
        yield np.unique(block.hashes[block.offsets[i] : block.offsets[i + 1]])


def _counted(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a batch of texts and how many of them hold each."""
    found = [t for block in words(batch.column("text"), lower=True) for t in _distinct(block)]
    return np.unique(np.concatenate([*found, np.empty(0, np.uint64)]), return_counts=True)


def _candidates(least: float):
    """Terms that at least the share ``least`` of a batch holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, n = _counted(batch)
            yield pa.RecordBatch.from_arrays([pa.array(term[n >= least * batch.num_rows].view(np.int64))], ["term"])

    return run


def _term_counts(wanted):
    """(term, n) of the terms that the map holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, n = _counted(batch)
            kept = wanted.value.holds(term)
            yield pa.RecordBatch.from_arrays([pa.array(term[kept].view(np.int64)), pa.array(n[kept])], ["term", "n"])

    return run


def lexicon(docs: DataFrame, most: float = MOST, least: float = LEAST, max_terms: int = MAX_TERMS) -> np.ndarray:
    """Sorted hashes of the terms that between ``least`` and ``most`` of all rows hold.

    A term that the share ``least`` of all rows holds is held by as large a share of the rows of some batch, so
    terms that no batch holds that often need no counting. The others are counted over all rows.

    At most (mean distinct terms of a row) / ``least`` terms can be that frequent, however many rows
    there are; more than ``max_terms`` (32 MB) are an error, for which ``least`` can be raised.
    """
    texts = docs.select(F.col("text").cast("string").alias("text"))
    rows = docs.count()
    frequent = BitMap.of(texts.mapInArrow(_candidates(least), "term long"), "term")
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    counts = texts.mapInArrow(_term_counts(shared), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    band = counts.where((F.col("n") >= least * rows) & (F.col("n") <= most * rows)).select("term")
    found = band.limit(max_terms + 1).toPandas()["term"].to_numpy(np.int64)
    if len(found) > max_terms:
        raise ValueError(f"more than {max_terms} terms in the band; raise least")
    return np.sort(found.view(np.uint64))


def fingerprints(texts: list[str], kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whole, subsets): the hash of all band terms, and texts by halvings by chains; 0 is an empty subset.

    A text with no term in the band is taken by all its terms.
    """
    whole = np.zeros(len(texts), dtype=np.uint64)
    parts = np.zeros((len(texts), HALVINGS, SUBSETS), dtype=np.uint8)
    for block in words(pa.array(texts, pa.large_string()), lower=True):
        owner, terms = [], []
        for i, found in enumerate(_distinct(block)):
            if len(kept) and len(found):
                at = np.minimum(np.searchsorted(kept, found), len(kept) - 1)
                inside = found[kept[at] == found]
                found = inside if len(inside) else found
            terms.append(found)
            owner.append(np.full(len(found), i))
        n = len(block.offsets) - 1
        owner, terms = np.concatenate(owner), np.concatenate(terms)
        # How often a term is halved away in each chain: the number of leading zeros of a hash.
        drawn = mix(terms[:, None] ^ _SALTS[None, :]) >> np.uint64(11)
        level = np.minimum(53 - np.frexp(drawn.astype(np.float64))[1], HALVINGS)
        place = (owner[:, None] * (HALVINGS + 1) + level) * SUBSETS + np.arange(SUBSETS)[None, :]
        value = mix(terms + np.uint64(0xC2B2AE3D27D4EB4F))
        shape = (n, HALVINGS + 1, SUBSETS)
        sums = []
        for shift in (0, 26):  # sums of 26 bits are exact
            weight = ((value >> np.uint64(shift)) & np.uint64((1 << 26) - 1)).astype(np.float64)
            got = np.bincount(place.ravel(), np.repeat(weight, SUBSETS), n * (HALVINGS + 1) * SUBSETS).reshape(shape)
            sums.append(got[:, ::-1].cumsum(axis=1)[:, ::-1].astype(np.uint64))
        number = np.bincount(place.ravel(), minlength=n * (HALVINGS + 1) * SUBSETS).reshape(shape)
        number = number[:, ::-1].cumsum(axis=1)[:, ::-1]
        hashed = mix(mix(sums[0] + np.uint64(1)) ^ sums[1])
        small = np.where(number > 0, np.maximum(hashed >> np.uint64(56), np.uint64(1)), np.uint64(0))
        here = slice(block.first, block.first + n)
        whole[here] = np.where(number[:, 0, 0] > 0, hashed[:, 0, 0], 0)
        parts[here] = small[:, 1:].astype(np.uint8)
    return whole, parts


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 to 1 for each pair of fingerprints; 1 where the whole hashes are equal."""
    either = (a[1] > 0) | (b[1] > 0)
    equal = (a[1] == b[1]) & either
    used, same = either.sum(axis=2), equal.sum(axis=2)
    enough = used >= SUBSETS // 2
    finest = np.where(enough.any(axis=1), HALVINGS - 1 - enough[:, ::-1].argmax(axis=1), 0)
    rows = np.arange(len(used))
    share = same[rows, finest] / np.maximum(used[rows, finest], 1)
    return np.where(a[0] == b[0], 1.0, share)


def _text(whole: int, parts: np.ndarray) -> str:
    return f"{whole:016x}" + parts.tobytes().hex()


def _compare(shared):
    """Rows in order; rows marked as context only follow the last row of their part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = shared.value

        def done(rows: list[tuple]) -> pa.RecordBatch:
            """``rows`` and the row that follows them, which is not put out."""
            texts = [r[3] for r in rows]
            edited = []
            for text, after in zip(texts, texts[1:]):
                half = len(text) // 2
                edited.append(text[: len(text) - half] + after[:half])
            own, other = fingerprints(texts, kept), fingerprints(edited, kept)
            first, following = (own[0][:-1], own[1][:-1]), (own[0][1:], own[1][1:])
            n = len(edited)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[2] for r in rows[:-1]], pa.int64()),
                    pa.array([len(t) for t in texts[:-1]], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                    pa.array([_text(int(own[0][i]), own[1][i]) for i in range(n)]),
                    pa.array([_text(int(other[0][i]), other[1][i]) for i in range(n)]),
                    pa.array(likeness(first, other).astype(np.float64)),
                    pa.array(likeness(first, following).astype(np.float64)),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        held: list[tuple] = []
        size = 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "context", "doc_id", "text")]
            for row in zip(*columns):
                row = (*row[:3], row[3] or "")
                if held and row[0] != held[-1][0]:
                    held, size = [], 0  # the part's last row has been put out before its context
                if held and held[-1][1]:
                    continue  # further copies of the context
                held.append(row)
                size += len(row[3])
                if len(held) > 1 and (size > BLOCK or row[1]):
                    yield done(held)
                    held, size = [row], len(row[3])

    return run


def fingerprint_edits(docs: DataFrame, kept: np.ndarray | None = None, parts: int | None = None) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text) and of its text edited with the next row's.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Rows go by
    descending doc_id, null last, equal ones by text; the row after the last is the first. The edited
    text has its last floor(n_chars / 2) code points replaced by as many of the next text's first, or all.

    Null texts are empty; empty texts have an empty fingerprint. A single row follows itself.
    Further columns are ignored; an empty table gives no rows. ``kept`` is the lexicon of ``docs`` unless given.

    Rows are dealt to ``parts`` ranges of doc_id once. A part also gets the first row of the
    next one, so no row needs another task.
    """
    spark = docs.sparkSession
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kept = lexicon(texts) if kept is None else kept
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / parts for i in range(1, parts)]
    cuts = texts.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, steps)), 10 * parts)).first()[0] or []
    splits = [-float("inf"), *sorted({float(c) for c in cuts}), float("inf")]
    keyed = texts.withColumn("__id", F.col("doc_id").cast("double"))
    if len(splits) > 2:
        bucket = Bucketizer(splits=splits, inputCol="__id", outputCol="__part", handleInvalid="keep")
        keyed = bucket.transform(keyed)
    else:
        keyed = keyed.withColumn("__part", F.lit(0.0))
    part = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.col("__part").cast("int"))
    keyed = keyed.select(part.alias("part"), "doc_id", "text")
    heads = sorted(map(tuple, keyed.groupBy("part").agg(F.max("doc_id").alias("head")).collect()), reverse=True)
    follows = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    to = spark.createDataFrame(follows, "head long, to int")  # a row for each part
    context = keyed.join(F.broadcast(to), F.col("doc_id").eqNullSafe(F.col("head"))).select(
        F.col("to").alias("part"), F.lit(True).alias("context"), "doc_id", "text"
    )
    rows = keyed.select("part", F.lit(False).alias("context"), "doc_id", "text").unionByName(context)
    dealt = rows.repartition(parts, "part").sortWithinPartitions(
        "part", "context", F.col("doc_id").desc_nulls_last(), "text"
    )
    return dealt.mapInArrow(_compare(spark.sparkContext.broadcast(kept)), schema)

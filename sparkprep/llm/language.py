"""Language identification with a string kernel, Nystroem landmarks and kernel ridge regression.

A text is the set of its distinct runs of one to three bytes of lower-cased letters, everything else being one space
(blended spectrum, presence); runs are told apart by ``BUCKETS`` hash values. The kernel of two texts is the size of the intersection over the geometric mean of the sizes. Landmark texts
span the kernel's space; ridge regression, one class against the rest, gives the weights of
the landmarks. A block of texts is scored by two matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.mixing import uniform
from sparkprep.llm.words import BLOCK, blocks, mix

GRAMS = (1, 2, 3)
BUCKETS = 8192
ROWS = 400  #: texts of one matrix, which bounds its memory to 13 MB
UNKNOWN = "und"

_SPACE = np.ones(256, dtype=bool)
_SPACE[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


class Model(NamedTuple):
    languages: list[str]  #: in order of code point
    landmarks: np.ndarray  #: presence of each bucket per landmark, scaled to length 1
    weights: np.ndarray  #: landmarks by languages


def presence(column: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, np.ndarray]]:
    """(first text, texts by buckets as 0 and 1) for each block of whole texts, ``ROWS`` at most."""
    for begin in range(0, len(column), ROWS):
        for first, x in _presence(column.slice(begin, ROWS), size):
            yield begin + first, x


def _presence(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    lowered = pc.utf8_lower(column.cast(pa.large_string()))
    for first, data, texts in blocks(lowered, size):
        space = _SPACE[data]
        keep = ~space
        keep[1:] |= ~space[:-1]  # the first of several separators stays
        before = np.concatenate([[0], np.cumsum(keep)])
        codes = np.where(space, np.uint8(0x20), data)[keep].astype(np.uint64)
        offsets = before[texts]
        n = len(texts) - 1
        owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
        out = np.zeros(n * BUCKETS, dtype=np.float32)
        value = np.zeros(len(codes), dtype=np.uint64)
        for k in range(1, max(GRAMS) + 1):
            m = len(codes) - k + 1
            if m <= 0:
                break
            value = value[:m] * np.uint64(257) + codes[k - 1 : k - 1 + m] + np.uint64(1)
            if k in GRAMS:
                own = owner[:m] == owner[k - 1 : k - 1 + m]
                bucket = (mix(value[own] + np.uint64(k << 40)) >> np.uint64(51)).astype(np.int64)
                out[owner[:m][own] * BUCKETS + bucket] = 1
        yield first, out.reshape(n, BUCKETS)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the CRC-32 of doc_id as text (null: empty) is divisible by ``folds``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = [np.packbits(row > 0).tobytes() for _, x in presence(batch.column("text")) for row in x]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("draw"), pa.array(bits, pa.binary())], ["lang", "draw", "bits"]
        )


def fit(
    labelled: DataFrame,
    per_language: int = 600,
    landmarks: int = 256,
    ridge: float = 1e-2,
    max_languages: int = 1000,
    seed: str = "language-1",
) -> Model | None:
    """A model of the rows of ``labelled`` (doc_id, text, lang) that have a language and a letter.

    It is fitted on a sample that does not grow with the table: about ``per_language`` rows of each
    language, drawn by a hash of doc_id; only the presence bits of their whole texts reach the
    driver (1 KB each). More than ``max_languages`` languages are an error. None without rows.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(max_languages + 1).collect()}
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not counts:
        return None
    rates = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.2 * per_language / n))])
    drawn = rows.withColumn("draw", uniform(seed, "doc_id")).where(F.col("draw") < rates[F.col("lang")])
    sample = drawn.select("lang", "draw", "text").mapInArrow(_packed, "lang string, draw double, bits binary")
    sample = sorted(map(tuple, sample.collect()))
    languages = sorted(counts)
    # Landmarks go round the languages, so that each has its share.
    rank: dict[str, int] = {}
    order = []
    for i, (lang, _, _) in enumerate(sample):
        rank[lang] = rank.get(lang, -1) + 1
        if rank[lang] < per_language:
            order.append((rank[lang], i))
    chosen = [i for _, i in sorted(order)]
    x = np.array([np.unpackbits(np.frombuffer(sample[i][2], np.uint8)) for i in chosen], dtype=np.float32)
    x = _scaled(x)
    y = np.array([[sample[i][0] == k for k in languages] for i in chosen], dtype=np.float64)
    base = x[:landmarks]
    cross = (x @ base.T).astype(np.float64)
    inner = (base @ base.T).astype(np.float64)
    # Every language counts alike, however many rows it has.
    share = 1 / np.maximum(y.sum(axis=0), 1)
    row = np.sqrt((y * share).sum(axis=1) / len(languages))[:, None]
    system = (cross * row).T @ (cross * row) + ridge * inner / len(chosen)
    system += 1e-9 * np.trace(system) * np.eye(len(base))
    weights = np.linalg.solve(system, (cross * row).T @ (y * row))
    return Model(languages, base, weights.astype(np.float32))


def scores(model: Model, column: pa.Array) -> Iterator[np.ndarray]:
    """Texts by languages, block by block."""
    for _, x in presence(column):
        yield (_scaled(x) @ model.landmarks.T) @ model.weights


def predict(docs: DataFrame, model: Model | None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` (text) with lang_pred and score, or columns of other ``names``, from the text alone.

    ``lang_pred`` is the language with the largest regression value (equal ones: the first by code
    point) and ``score`` that value cut to 0..1. A null text or one without a letter is ``und`` with
    score 0, as is every text where there is no model. Other columns are kept; those called as ``names`` are
    replaced. Rows that repeat are predicted each; an empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in names]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    if model is None:
        return docs.withColumns({names[0]: F.lit(UNKNOWN), names[1]: F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema.add("__letter", "boolean").add(names[0], "string").add(names[1], "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            letter = batch.column("__letter").to_numpy(zero_copy_only=False).astype(bool)
            value = np.concatenate(list(scores(model, batch.column("text"))))
            best = value.argmax(axis=1)
            top = np.clip(value[np.arange(len(best)), best], 0, 1).astype(np.float64)
            languages = np.array([*model.languages, UNKNOWN], dtype=object)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(languages[np.where(letter, best, len(model.languages))], pa.string()),
                    pa.array(np.where(letter, top, 0.0)),
                ],
                [*batch.schema.names, *names],
            )

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn("__letter", letter).mapInArrow(run, schema).drop("__letter")


def identify_languages(
    docs: DataFrame, folds: int = 5, names: tuple[str, str, str] = ("held_out", "lang_pred", "score"), **options
) -> DataFrame:
    """``docs`` (doc_id, text, lang) with held_out, lang_pred and score, or columns of other ``names``.

    Rows whose CRC-32 of doc_id is divisible by ``folds`` are never learned from. ``lang`` is read
    for learning only. Nulls, ties, repeated rows and empty tables: as :func:`predict` says.
    """
    model = fit(docs.where(~held_out(F.col("doc_id"), folds)).select("doc_id", "text", "lang"), **options)
    return predict(docs.withColumn(names[0], held_out(F.col("doc_id"), folds)), model, names[1:])

"""Toxicity: gradient-boosted trees over dense features of whole texts, with isotonic calibration.

Features of a text are densities of a listed and of a learned lexicon, nearness of their words to second-person
words, capitals, punctuation and obfuscation. The learned lexicon holds words and stems (first letters of words)
that labelled rows of one class hold far more often. It is learned out of fold: a row that the
trees learn from is described with a lexicon that its own fold had no part in.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.common import Scratch
from sparkprep.llm.mixing import uniform
from sparkprep.llm.words import MARKS, Words, blocks, mix, span_hashes, words_of

STEMS = range(3, 9)  #: letters of the stems that a learned lexicon may hold
FOLDS = 4  #: of the rows to learn from, for lexicons; the last one calibrates
NEAR = 6  #: words within which a second-person word counts as near

# Common insults and second-person words of four languages.
INSULTS = (
    "idiot idiots idiotic moron morons moronic stupid dumb fool fools loser losers scum trash garbage pathetic "
    "worthless disgusting clown clowns imbecile jerk jerks bastard bastards bitch asshole shit fuck fucking retard "
    "retarded filth filthy vermin pig pigs dumbass crap whore slut freak creep coward liar "
    "idioten dumm dummkopf abschaum verlierer trottel arschloch scheisse scheiße hurensohn widerlich erbärmlich "
    "wertlos schwachkopf vollidiot drecksau miststück "
    "imbécile crétin débile connard connasse salaud salope merde ordure minable abruti dégueulasse pourriture "
    "idiota estúpido estúpida imbécil tonto gilipollas cabrón mierda puta basura escoria asqueroso patético inútil "
    "perdedor payaso"
).split()
SECOND_PERSON = (
    "you your yours yourself yourselves u ur youre du dich dir dein deine deinen deiner euch euer ihr sie "
    "tu te toi ton ta tes vous votre vos tú ti contigo usted ustedes vosotros vuestro"
).split()
# Characters that stand for letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

FEATURES = [
    "log_words",
    "listed_density",
    "listed_log_count",
    "learned_density",
    "learned_log_count",
    "learned_weight",
    "learned_strongest",
    "learned_kinds",
    "second_person_rate",
    "hits_near_second_person",
    "second_person_nearness",
    "capital_letters",
    "capital_words",
    "capital_hits",
    "exclamations",
    "questions",
    "mark_runs",
    "symbols",
    "digits",
    "inner_marks",
    "letter_runs",
    "single_letters",
    "hidden_hits",
]

_LATIN = np.zeros(256, dtype=bool)  # second bytes of capital letters of Latin-1 in UTF-8
_LATIN[[b for b in range(0x80, 0x9F) if b != 0x97]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_ASCII_LETTER = _UPPER.copy()
_ASCII_LETTER[0x61:0x7B] = True
_LETTER = _ASCII_LETTER.copy()
_LETTER[0x80:] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_LEET = np.arange(256, dtype=np.uint8)
for _mark, _letter in LEET.items():
    _LEET[ord(_mark)] = ord(_letter)


def _capitals(data: np.ndarray) -> np.ndarray:
    """Bytes that are a capital letter of ASCII or end one of Latin-1."""
    out = _UPPER[data]
    out[1:] |= (data[:-1] == 0xC3) & _LATIN[data[1:]]
    return out


def lowered(data: np.ndarray) -> np.ndarray:
    return data + np.uint8(0x20) * _capitals(data)


class Lexicon(NamedTuple):
    """Sorted hashes of words and stems with their weights."""

    hashes: np.ndarray
    weights: np.ndarray
    bits: np.ndarray  #: which first 16 bits occur: leaves out most words early

    @classmethod
    def of(cls, hashes: np.ndarray, weights: np.ndarray) -> Lexicon:
        order = np.argsort(hashes)
        bits = np.zeros(1 << 16, dtype=bool)
        bits[(hashes >> np.uint64(48)).astype(np.int64)] = True
        return cls(hashes[order], np.asarray(weights, dtype=np.float64)[order], bits)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Weight of each hash, 0 where it is not in the lexicon."""
        out = np.zeros(len(hashes))
        maybe = np.flatnonzero(self.bits[(hashes >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), max(len(self.hashes) - 1, 0))
        if len(self.hashes):
            same = self.hashes[at] == hashes[maybe]
            out[maybe[same]] = self.weights[at[same]]
        return out


def _listed(words: list[str]) -> Lexicon:
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    found = np.unique(words_of(data, np.array([0, len(data)])).hashes)
    return Lexicon.of(found, np.ones(len(found)))


_INSULTS, _SECOND_PERSON = _listed(INSULTS), _listed(SECOND_PERSON)


def _stems(block: Words, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(letters, which of the words ``at`` are long enough, hashes of their stems)."""
    begins = (block.data & 0xC0) != 0x80
    places = np.append(np.flatnonzero(begins), len(block.data))
    number = np.cumsum(begins) - 1
    first, last = number[block.starts[at]], number[block.ends[at] - 1] + 1
    for k in STEMS:
        long = np.flatnonzero(last - first >= k)
        starts = block.starts[at[long]]
        yield k, long, mix(span_hashes(block.data, starts, places[first[long] + k]) + np.uint64(k))


def _distinct(block: Words) -> tuple[np.ndarray, np.ndarray]:
    """(one place of each distinct word, which distinct word each word is)."""
    _, first, inverse = np.unique(block.hashes, return_index=True, return_inverse=True)
    return first, inverse


def terms(block: Words, known: Lexicon | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, term) of a block: its words and their stems, those in ``known`` if given."""
    n = len(block.offsets) - 1
    first, inverse = _distinct(block)
    if not len(first):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(block.offsets))
    pairs = np.unique(owner * len(first) + inverse)
    text, word = pairs // len(first), pairs % len(first)
    kinds = [(np.arange(len(first)), block.hashes[first])]
    kinds += [(long, hashes) for _, long, hashes in _stems(block, first)]
    texts, found = [], []
    for places, hashes in kinds:
        of = np.full(len(first), -1)
        if known is not None:
            in_it = known.find(hashes) > 0
            places, hashes = places[in_it], hashes[in_it]
        of[places] = np.arange(len(places))
        has = of[word] >= 0
        texts.append(text[has])
        found.append(hashes[of[word[has]]])
    text, found = np.concatenate(texts), np.concatenate(found)
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (found[1:] != found[:-1])
    return text[new], found[new]


def _weights(block: Words, lexicon: Lexicon) -> np.ndarray:
    """Weight of each word: the largest of the word itself and its stems."""
    first, inverse = _distinct(block)
    best = lexicon.find(block.hashes[first])
    for _, long, hashes in _stems(block, first):
        best[long] = np.maximum(best[long], lexicon.find(hashes))
    return best[inverse]


def _revealed(data: np.ndarray, texts: np.ndarray) -> Words:
    """Words with stand-in characters as letters, inner marks left out and letters repeated thrice or more once."""
    solid = words_of(data, texts)
    letter = _LETTER[data]
    before = np.concatenate([[0], np.cumsum(letter)])
    places = np.append(np.flatnonzero(letter), len(data))
    inside = np.zeros(len(data) + 1, dtype=np.int64)
    has = before[solid.ends] > before[solid.starts]
    starts, ends = solid.starts[has], solid.ends[has]
    np.add.at(inside, places[before[starts]], 1)
    np.add.at(inside, places[before[ends] - 1] + 1, -1)
    inner = np.cumsum(inside[:-1]) > 0
    shown = np.where(inner, _LEET[data], data)
    keep = _BLANK[data] | inner & _LETTER[shown]
    same = np.zeros(len(data), dtype=bool)
    same[1:] = (shown[1:] == shown[:-1]) & _ASCII_LETTER[shown[1:]]
    run = np.zeros(len(data), dtype=bool)
    run[1:-1] = same[1:-1] & same[2:]
    run[2:] |= same[2:] & same[1:-1]
    keep &= ~run
    moved = np.concatenate([[0], np.cumsum(keep)])
    return words_of(shown[keep], moved[texts])


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[cuts[1:]] - total[cuts[:-1]]


def _largest(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n)
    np.maximum.at(out, owner, values)
    return out


def features(raw: np.ndarray, texts: np.ndarray, learned: Lexicon) -> np.ndarray:
    """Texts by ``FEATURES``; a text without words has zeros."""
    n = len(texts) - 1
    low = lowered(raw)
    block = words_of(low, texts, space=MARKS)
    cuts, owner = block.offsets, np.repeat(np.arange(n), np.diff(block.offsets))
    count = np.maximum(np.diff(cuts), 1).astype(np.float64)
    size = np.maximum(np.diff(texts), 1).astype(np.float64)
    listed = _INSULTS.find(block.hashes) > 0
    weight = _weights(block, learned)
    hit = listed | (weight > 0)
    you = _SECOND_PERSON.find(block.hashes) > 0

    # Words to the nearest second-person word of the same text.
    at, places = np.flatnonzero(hit), np.flatnonzero(you)
    near = np.zeros(len(at))
    if len(places):
        for side in (np.searchsorted(places, at) - 1, np.searchsorted(places, at)):
            ok = (side >= 0) & (side < len(places))
            other = places[np.clip(side, 0, len(places) - 1)]
            ok &= owner[other] == owner[at]
            near = np.maximum(near, np.where(ok, 1.0 / np.maximum(np.abs(other - at), 1), 0))
    close = np.zeros(len(block.hashes))
    close[at] = near >= 1 / NEAR

    capital = _capitals(raw)
    letters = _LETTER[raw] & ((raw & 0xC0) != 0x80)
    in_word = np.concatenate([[0], np.cumsum(capital)])
    is_letter = np.concatenate([[0], np.cumsum(letters)])
    capitals = in_word[block.ends] - in_word[block.starts]
    length = is_letter[block.ends] - is_letter[block.starts]
    shouted = (capitals >= 2) & (capitals == length)

    mark = MARKS[raw] & ~_BLANK[raw]
    run = np.zeros(len(raw), dtype=bool)
    run[1:] = mark[1:] & mark[:-1] & (raw[1:] == raw[:-1])
    symbol = mark & np.isin(raw, np.frombuffer(b"#$%&*@^~<>|\\", dtype=np.uint8))
    between = np.zeros(len(raw), dtype=bool)  # marks or digits with a letter on both sides
    between[1:-1] = (mark | _DIGIT[raw])[1:-1] & _LETTER[raw[:-2]] & _LETTER[raw[2:]] & (raw[1:-1] != 0x27) & (raw[1:-1] != 0x2D)
    thrice = np.zeros(len(raw), dtype=bool)
    thrice[2:] = (low[2:] == low[1:-1]) & (low[2:] == low[:-2]) & _ASCII_LETTER[low[2:]]
    single = length == 1
    alone = np.zeros(len(single))
    alone[1:-1] = single[1:-1] & single[:-2] & single[2:]

    shown = _revealed(low, texts)
    revealed = (_INSULTS.find(shown.hashes) > 0) | (_weights(shown, learned) > 0)
    hits = _sums(hit, cuts)
    hidden = np.maximum(_sums(revealed, shown.offsets) - hits, 0)

    kinds = np.zeros(n)
    if hit.any():
        pairs = np.unique(np.stack([owner[hit].astype(np.uint64), block.hashes[hit]]), axis=1)[0]
        kinds = np.bincount(pairs.astype(np.int64), minlength=n).astype(np.float64)
    found = weight > 0
    columns = {
        "log_words": np.log1p(np.diff(cuts)),
        "listed_density": _sums(listed, cuts) / count,
        "listed_log_count": np.log1p(_sums(listed, cuts)),
        "learned_density": _sums(found, cuts) / count,
        "learned_log_count": np.log1p(_sums(found, cuts)),
        "learned_weight": _sums(weight, cuts) / count,
        "learned_strongest": _largest(weight, owner, n),
        "learned_kinds": np.log1p(kinds),
        "second_person_rate": _sums(you, cuts) / count,
        "hits_near_second_person": _sums(close, cuts) / np.maximum(hits, 1),
        "second_person_nearness": _largest(near, owner[at], n),
        "capital_letters": _sums(capital, texts) / np.maximum(_sums(letters, texts), 1),
        "capital_words": _sums(shouted, cuts) / count,
        "capital_hits": _sums(shouted & hit, cuts) / np.maximum(hits, 1),
        "exclamations": _sums(raw == 0x21, texts) / size,
        "questions": _sums(raw == 0x3F, texts) / size,
        "mark_runs": _sums(run, texts) / size,
        "symbols": _sums(symbol, texts) / size,
        "digits": _sums(_DIGIT[raw], texts) / size,
        "inner_marks": _sums(between, texts) / count,
        "letter_runs": _sums(thrice, texts) / count,
        "single_letters": _sums(alone, cuts) / count,
        "hidden_hits": np.log1p(hidden),
    }
    return np.stack([columns[name] for name in FEATURES], axis=1)


def _featured(lexicons, kept: list[str]):
    """Tasks that replace whole texts by features, with the lexicon of each row's ``fold``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = lexicons.value
        for batch in batches:
            out = np.zeros((batch.num_rows, len(FEATURES)))
            folds = batch.column("fold").to_numpy()
            for fold in np.unique(folds):
                rows = np.flatnonzero(folds == fold)
                texts = batch.column("text").take(pa.array(rows))
                for first, data, cuts in blocks(texts):
                    out[rows[first : first + len(cuts) - 1]] = features(data, cuts, shared[fold])
            lists = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), len(FEATURES))
            columns = [*(batch.column(c) for c in kept), lists.cast(pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "values"])

    return run


def _term_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, data, cuts in blocks(batch.column("text")):
            n = len(cuts) - 1
            text, found = terms(words_of(lowered(data), cuts, space=MARKS))
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32()), pa.array(found.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays([batch.column("fold").slice(first, n), lists], ["fold", "terms"])


def _known_counts(known):
    """Tasks that count texts by fold and known term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = known.value
        counts = np.zeros((FOLDS, len(lexicon.hashes)), dtype=np.int64)
        for batch in batches:
            folds = batch.column("fold").to_numpy()
            for first, data, cuts in blocks(batch.column("text")):
                text, found = terms(words_of(lowered(data), cuts, space=MARKS), lexicon)
                np.add.at(counts, (folds[first + text], np.searchsorted(lexicon.hashes, found)), 1)
        fold, at = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(fold), pa.array(lexicon.hashes[at].view(np.int64)), pa.array(counts[fold, at])],
            ["fold", "term", "n"],
        )

    return run


def learn_lexicons(
    sample: DataFrame, least: int = 4, least_share: float = 0.003, most_terms: int = 20_000
) -> list[Lexicon]:
    """One lexicon without each fold of ``sample`` (text, label, fold), and one of all rows.

    A term is taken if at least ``least`` texts of label 1 (and ``least_share`` of them) hold it and the lower
    end of its log odds ratio (two standard errors) is above 1; that end is its weight. The ``most_terms`` heaviest are
    kept. The sample is bounded, and so are the tables of terms that reach the driver.
    """
    spark = sample.sparkSession
    totals = np.zeros((2, FOLDS))
    for r in sample.groupBy("label", "fold").count().collect():
        totals[int(r["label"]), r["fold"]] = r["count"]
    floor = max(least, int(least_share * totals[1].sum()))
    exploded = sample.where("label = 1").select("fold", "text").mapInArrow(_term_lists, "fold long, terms array<long>")
    counted = exploded.select("fold", F.explode("terms").alias("term")).groupBy("term").pivot(
        "fold", list(range(FOLDS))
    ).count()
    counted = counted.na.fill(0).where(sum((F.col(str(f)) for f in range(FOLDS)), F.lit(0)) >= floor)
    found = counted.toPandas().sort_values("term")
    if not len(found):
        return [Lexicon.of(np.empty(0, np.uint64), np.empty(0))] * (FOLDS + 1)
    hashes = found["term"].to_numpy(np.int64).view(np.uint64)
    known = Lexicon.of(hashes, np.ones(len(hashes)))
    order = np.argsort(hashes)
    ones = found[[str(f) for f in range(FOLDS)]].to_numpy(np.float64)[order].T
    zeros = np.zeros_like(ones)
    rest = sample.where("label = 0").select("fold", "text")
    partial = rest.mapInArrow(_known_counts(spark.sparkContext.broadcast(known)), "fold long, term long, n long")
    clean = partial.groupBy("fold", "term").agg(F.sum("n").alias("n")).toPandas()
    at = np.searchsorted(known.hashes, clean["term"].to_numpy(np.int64).view(np.uint64))
    zeros[clean["fold"].to_numpy(np.int64), at] = clean["n"].to_numpy(np.float64)

    def without(fold: int | None) -> Lexicon:
        own = [f for f in range(FOLDS) if f != fold]
        a, b, n_a, n_b = ones[own].sum(axis=0), zeros[own].sum(axis=0), totals[1, own].sum(), totals[0, own].sum()
        odds = np.log((a + 0.5) / (n_a - a + 0.5)) - np.log((b + 0.5) / (n_b - b + 0.5))
        error = np.sqrt(1 / (a + 0.5) + 1 / (n_a - a + 0.5) + 1 / (b + 0.5) + 1 / (n_b - b + 0.5))
        weight = odds - 2 * error
        good = np.flatnonzero((weight > 1) & (a >= floor * len(own) / FOLDS))
        good = good[np.argsort(-weight[good], kind="stable")][:most_terms]
        return Lexicon.of(known.hashes[good], weight[good])

    return [*(without(f) for f in range(FOLDS)), without(None)]


class Model(NamedTuple):
    lexicon: Lexicon
    trees: GBTClassificationModel
    calibration: IsotonicRegressionModel


def held_out(doc_id: Column, folds: int = 3, rest: int = 1) -> Column:
    """Whether the CRC-32 of doc_id as text (null: empty) leaves ``rest`` by ``folds``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == rest


def labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int, seed: str = "toxicity-1") -> DataFrame:
    """(doc_id, text, label, fold) of about ``per_label`` documents of each label, drawn by a hash of doc_id.

    Labels other than 0 and 1 and null ids teach nothing; of a doc_id with several labels the largest counts, of one
    with several rows the smallest text.
    """
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    told = told.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(
        F.max("label").alias("label")
    )
    counts = {r["label"]: r["count"] for r in told.groupBy("label").count().collect()}
    rates = F.create_map(
        *[F.lit(x) for k in (0, 1) for x in (k, min(1.0, 1.1 * per_label / max(counts.get(k, 0), 1)))]
    )
    drawn = told.where(uniform(seed, "doc_id") < rates[F.col("label")])
    # The draw has a bound, so it is sent to the tasks that read texts; no text is shuffled to find its label.
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    rows = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    return rows.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(FOLDS)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_label: int = 25_000,
    trees: int = 30,
    depth: int = 4,
    least_to_calibrate: int = 30,
) -> Model | None:
    """A model of the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) names.

    It is fitted on a sample that does not grow with the tables (``per_label`` documents of each label). The trees learn
    from all folds but one, which calibrates them; with fewer than ``least_to_calibrate`` rows of either label
    there, all rows do both. None where one of the labels is missing.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = scratch.keep(labelled_sample(docs, labels, per_label), "sample")
    if sample.select("label").distinct().count() < 2:
        return None
    lexicons = learn_lexicons(sample)
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)
    kept = ["label", "fold"]
    rows = sample.select("text", *kept).mapInArrow(_featured(shared, kept), "label int, fold long, values array<double>")
    rows = scratch.keep(rows, "features").withColumn("features", array_to_vector("values"))
    scratch.drop(sample)
    last = rows.where(F.col("fold") == FOLDS - 1)
    fewest = min([r["count"] for r in last.groupBy("label").count().collect()] + [10**9])
    apart = last.select("label").distinct().count() == 2 and fewest >= least_to_calibrate
    learner = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.2, minInstancesPerNode=5, seed=11)
    forest = learner.fit(rows.where(F.col("fold") < FOLDS - 1) if apart else rows)
    # Equal margins, of which there are many, are one point with a weight.
    raw = _margins(forest, last if apart else rows).groupBy("margin").agg(
        F.avg("label").alias("label"), F.count("*").cast("double").alias("n")
    )
    calibration = IsotonicRegression(labelCol="label", featuresCol="margin", weightCol="n").fit(raw)
    return Model(lexicons[-1], forest, calibration)


def _margins(forest: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    done = forest.transform(rows)
    return done.withColumn("margin", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``docs`` (doc_id, text), from the whole text alone.

    Null and empty texts and those without words have the score of a text without features. Equal texts have equal
    scores; every row is scored, also one that repeats another or has a null doc_id. Further columns are ignored and an
    empty table gives no rows. Without a model every score is 0.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return texts.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast([model.lexicon])
    texts = texts.withColumn("fold", F.lit(0).cast("long"))
    rows = texts.mapInArrow(_featured(shared, ["doc_id"]), "doc_id long, values array<double>")
    told = _margins(model.trees, rows.withColumn("features", array_to_vector("values")))
    done = model.calibration.transform(told)
    return done.select("doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "prediction")).alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``; rows that are held out are never learned from.

    Nulls, empty and repeated rows, further columns and empty tables: as ``score`` and ``labelled_sample`` say.
    """
    model = fit(docs.where(~held_out(F.col("doc_id"))), labels, **options)
    done = score(docs, model)
    return done.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

"""Toxicity: features and lexicons by hand, held-out accuracy on rows with planted insults and stems."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkprep.llm.toxicity import FEATURES, Lexicon, features, learn_lexicons, lowered, terms, toxicity
from sparkprep.llm.words import MARKS, blocks, words_of

NONE = Lexicon.of(np.empty(0, np.uint64), np.empty(0))


def described(texts, lexicon=NONE):
    out = []
    for _, data, cuts in blocks(pa.array(texts, pa.string())):
        out += [dict(zip(FEATURES, row)) for row in features(data, cuts, lexicon)]
    return out


def lexicon_of(words, weight=2.0):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return Lexicon.of(np.unique(words_of(data, np.array([0, len(data)])).hashes), np.full(len(set(words)), weight))


def test_features():
    plain, near, shout, hidden, none, empty = described(
        ["A calm text of seven plain words.", "oh you total IDIOT!! go", "STUPID STUPID text", "such an 1d.i0t... stuuupid", None, ""]
    )
    assert plain["listed_density"] == 0 and plain["log_words"] == pytest.approx(np.log1p(7))
    assert near["listed_density"] == 0.2 and near["hits_near_second_person"] == 1
    assert near["second_person_nearness"] == 0.5 and near["exclamations"] == pytest.approx(2 / 23)
    assert near["capital_hits"] == 1 and near["mark_runs"] > 0 and near["capital_words"] == 0.2
    assert shout["listed_density"] == pytest.approx(2 / 3) and shout["learned_kinds"] == pytest.approx(np.log(2))
    assert hidden["listed_density"] == 0 and hidden["hidden_hits"] > 0 and hidden["inner_marks"] > 0
    assert hidden["letter_runs"] > 0
    assert set(none.values()) == set(empty.values()) == {0.0}


def test_second_person_words_of_another_text_are_not_near():
    first, _ = described(["idiot", "you"])
    assert first["second_person_nearness"] == 0


def test_words_and_stems_of_the_learned_lexicon():
    lexicon = lexicon_of(["verflucht"])
    hit, other = described(["Ein Verflucht ist", "ein verfluchter ist"], lexicon)
    assert hit["learned_density"] == pytest.approx(1 / 3) and hit["learned_strongest"] == 2
    assert other["learned_density"] == 0  # the whole word is in the lexicon, not its stem
    data = np.frombuffer("größeren und größe".encode(), np.uint8)
    text, found = terms(words_of(lowered(data), np.array([0, len(data)]), space=MARKS))
    # Words: 3; stems of 3, 4 and 5 letters are shared, of 6, 7 and 8 letters belong to the first word; und is one of 3.
    assert len(text) == len(found) == 3 + 3 + 3 + 1


def made(n, seed):
    """Texts of two languages; a tenth is toxic, by listed insults or by stems with random endings."""
    rng = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ter", "sun", "pra", "ne", "vo", "sti", "ble", "ru", "dan"]

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))

    out = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(5, 120))]
        toxic = i % 10 == 3
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                bad = rng.choice(["idiot", "scum", "Loser"]) if i % 20 < 10 else "grukz" + rng.choice(syllables)
                words.insert(rng.randrange(len(words)), bad)
        out.append((i, " ".join(words), int(toxic)))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    rows = made(1500, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows if r[0] % 5], "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_accuracy(tables):
    docs, labels = tables
    found = {r["doc_id"]: r for r in toxicity(docs, labels, trees=8).collect()}
    truth = {r[0]: r[2] for r in made(1500, 1)}
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.7)
    unseen = [i for i in found if found[i]["held_out"] or i % 5 == 0]
    caught = [found[i]["predicted"] for i in unseen if truth[i]]
    wrong = [found[i]["predicted"] for i in unseen if not truth[i]]
    assert sum(caught) >= 0.95 * len(caught) and sum(wrong) <= 0.01 * len(wrong)


def test_held_out_labels_are_never_read(tables):
    docs, labels = tables
    apart = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    flipped = labels.withColumn("toxic", F.when(apart, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted(map(tuple, toxicity(docs, x, trees=3).collect())) for x in (labels, flipped))
    assert one == two


def test_lexicon_of_a_fold_does_not_know_its_rows(spark):
    """A stem that only one fold holds is in the lexicons of the other folds only."""
    rows = [(f"plain words {i}", 0, i % 4) for i in range(200)]
    rows += [(f"plain zzzzy{i % 3}", 1, 2) for i in range(30)] + [(f"plain qqqqx{i % 3}", 1, i % 4) for i in range(30)]
    sample = spark.createDataFrame(rows, "text string, label int, fold long")
    found = learn_lexicons(sample)
    assert len(found) == 5
    (at,) = [described(["zzzzy1"], lexicon)[0]["learned_strongest"] for lexicon in found[2:3]]
    assert at == 0 and all(described(["zzzzy1"], lexicon)[0]["learned_strongest"] > 0 for lexicon in (found[0], found[4]))
    assert all(described(["qqqqx2"], lexicon)[0]["learned_strongest"] > 0 for lexicon in found)


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame(
        [(1, 0), (2, 0), (5, 0), (6, 1), (8, 0), (9, 1), (None, 1), (4, 1), (4, 0), (77, 1), (3, None), (7, 3)],
        "doc_id long, toxic int",
    )
    done = toxicity(odd, labels, trees=2).collect()
    assert len(done) == odd.count() and done[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    empties = {r["score"] for r in done if r["doc_id"] in (3, 4, 5)}
    assert len(empties) == 1 and all(0 <= r["score"] <= 1 for r in done)
    assert {r["score"] for r in toxicity(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity(odd.limit(0), labels).count() == 0

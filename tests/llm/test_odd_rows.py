"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, by brute force."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkprep.llm import fingerprints, lines
from sparkprep.llm.fingerprints import fingerprint_edits
from sparkprep.llm.language import identify_languages
from sparkprep.llm.lines import dedup_lines
from sparkprep.llm.mixing import mixed, n_words, source_targets, with_copies
from sparkprep.llm.near_documents import drop_near_documents, near_documents
from sparkprep.llm.packing import pack_documents
from sparkprep.llm.queries import tokenizer_path
from sparkprep.llm.repeated_passages import remove_repeated_passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans({i: i + 32 for i in range(65, 91)})


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def words_of(text):
    return WORD.findall(text or "")


def test_fingerprints(odd):
    found = fingerprint_edits(odd, parts=3).collect()
    given = sorted(
        ((r["doc_id"], r["text"] or "") for r in odd.collect()),
        key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()),
    )
    wanted = []
    for (i, text), (_, after) in zip(given, given[1:] + given[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        wanted.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted([tuple(r[:3]) for r in found], key=str) == sorted(wanted, key=str)
    by_text = collections.defaultdict(set)
    for r in found:
        by_text[next(t for i, t in given if i == r["doc_id"])].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(v) == 1 for v in by_text.values())
    twins = [r["near_next"] for r in found if r["doc_id"] == 2]
    assert max(twins) == 1.0


def test_one_row_follows_itself(odd):
    found = fingerprint_edits(odd.where("doc_id = 6")).collect()
    assert [r["near_next"] for r in found] == [1.0]


def test_lexicon_is_the_band(spark):
    texts = [(i, "all " + ("half " if i % 2 else "") + ("few " if i < 4 else "") + f"own{i}") for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    kept = fingerprints.lexicon(docs, most=0.6, least=0.1)
    import pyarrow as pa

    from sparkprep.llm.words import words

    block = next(iter(words(pa.array(["all half few own1"]), lower=True)))
    assert [h in kept for h in block.hashes] == [False, True, True, False] and len(kept) == 2
    with pytest.raises(ValueError):
        fingerprints.lexicon(docs, most=0.6, least=0.0, max_terms=3)


def test_mixing(spark, odd):
    found = with_copies(odd, n_words("text")).collect()
    sizes = collections.Counter()
    for r in found:
        assert r["__size"] == len(words_of(r["text"]))
        sizes[r["source"]] += r["__size"]
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, level, capped = 1.5 * sum(sizes.values()), 0.0, set()
    while True:
        open_weight = sum(weight[s] for s in order if s not in capped)
        level = (total - sum(2 * sizes[s] for s in capped)) / open_weight
        more = {s for s in order if 2 * sizes[s] < weight[s] * level}
        if more <= capped:
            break
        capped |= more
    for r in found:
        assert r["__target"] == pytest.approx(min(2 * sizes[r["source"]], weight[r["source"]] * level))
        assert 0 <= r["__copies"] <= 2
    assert rows(mixed(odd)) == rows(mixed(odd)) and mixed(odd).columns == odd.columns
    assert source_targets(odd.limit(0), n_words("text")).count() == 0


def test_taken_words_come_near_the_target(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 7 + 1).cast("int")).alias("text"),
    )
    taken = with_copies(docs, n_words("text")).groupBy("source").agg(
        F.sum(F.col("__size") * F.col("__copies")).alias("n"), F.first("__target").alias("t")
    )
    for r in taken.collect():
        assert r["n"] == pytest.approx(r["t"], rel=0.05)


def test_near_documents(odd):
    found = near_documents(odd).collect()
    given = odd.collect()
    sets = []
    for r in given:
        w = words_of((r["text"] or "").translate(ASCII_LOWER))
        k = min(5, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    up = list(range(len(given)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(given)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i, r in enumerate(given):
        groups[root(i)].append(r["doc_id"])
    wanted = []
    for i, r in enumerate(given):
        known = [x for x in groups[root(i)] if x is not None]
        component = min(known) if known else None
        wanted.append((r["doc_id"], len(sets[i]), component, component == r["doc_id"]))
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    kept = drop_near_documents(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted([1, 3, 4, 5, 6, 7, 8, None, -10], key=str)
    twice = drop_near_documents(odd.where("doc_id <> 1").unionByName(odd)).where("doc_id = 1").collect()
    assert len(twice) == 1  # wholly repeated rows are copies too
    one = drop_near_documents(odd.where("doc_id = 2")).collect()
    assert [(r["doc_id"], r["score"]) for r in one] == [(2, 1.0)]  # the smallest by its other columns
    assert drop_near_documents(odd.where("doc_id = 2").select("text", "doc_id")).count() == 1


def test_repeated_passages(odd):
    length = 35
    given = [(r["doc_id"], words_of(r["text"])) for r in odd.collect()]
    seen = collections.Counter(tuple(w[i : i + length]) for _, w in given for i in range(len(w) - length + 1))
    wanted = []
    for i, w in given:
        gone = set()
        for k in range(len(w) - length + 1):
            if seen[tuple(w[k : k + length])] > 1:
                gone.update(range(k, k + length))
        wanted.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert rows(remove_repeated_passages(odd)) == sorted(wanted, key=str)


def test_passages_repeated_in_one_text_and_across_shards(spark):
    """Overlapping repeats, repeats inside a document and anchors with hundreds of kinds."""
    import random

    rng = random.Random(4)
    shared = [f"s{i}" for i in range(60)]
    texts = []
    for i in range(400):
        own = [f"o{rng.randrange(10**6)}" for _ in range(40)]
        texts.append(" ".join(own[:20] + shared + own[20:] + (["x"] * 50 if i % 50 == 0 else [])))
    texts.append(" ".join(shared * 3))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    given = [t.split() for t in texts]
    seen = collections.Counter(tuple(w[i : i + 35]) for w in given for i in range(len(w) - 34))
    found = {r["doc_id"]: r for r in remove_repeated_passages(docs).collect()}
    for i, w in enumerate(given):
        gone = {k + j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(35)}
        assert found[i]["kept"].split() == [x for k, x in enumerate(w) if k not in gone]


def normal(line):
    lowered = line.translate(ASCII_LOWER).translate({i: i + 32 for i in range(0xC0, 0xDF) if i != 0xD7})
    return " ".join(re.findall("[a-z0\x80-\U0010ffff]+", re.sub("[0-9]", "0", lowered)))


def test_lines(odd):
    done = dedup_lines(odd)
    assert done.columns == [*[c for c in odd.columns if c != "text"], "__lines", "__removed", "__kept"]
    given = sorted((r for r in odd.collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    first, wanted = {}, []
    for r in given:
        own = r["text"].split("\n") if r["text"] else []
        kept = []
        for i, line in enumerate(own):
            form = normal(line)
            if not form or first.setdefault(form, (r["doc_id"], i)) == (r["doc_id"], i):
                kept.append(line)
        wanted.append((r["doc_id"], len(own), len(own) - len(kept), "\n".join(kept) if r["text"] is not None else None))
    # The two long texts are near as well: the second one goes.
    wanted = [(9, 1, 1, "") if w[0] == 9 else w for w in wanted]
    assert rows(done.select("doc_id", "__lines", "__removed", "__kept")) == sorted(wanted, key=str)


def test_edit_distance():
    assert lines.edit_distance("kitten", "sitting", 9) == 3 and lines.edit_distance("", "abc", 9) == 3
    assert lines.edit_distance("kitten", "sitting", 2) == 3
    assert lines.similar("abcde", "abcdx", 0.8) and not lines.similar("abcd", "abcx", 0.8)


def test_languages(odd):
    done = identify_languages(odd.drop("score"))
    for r in done.collect():
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "de") and 0 <= r["score"] <= 1
    own = identify_languages(odd, names=("h", "l", "s"))
    assert own.columns == [*odd.columns, "h", "l", "s"]
    assert rows(own.select("doc_id", "score")) == rows(odd.select("doc_id", "score"))
    assert rows(own.select("doc_id", "l", "s")) == rows(done.select("doc_id", "lang_pred", "score"))
    none = identify_languages(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}


def test_packing(odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    found = pack_documents(odd, tokenizer_path(), length=64, group=5).collect()
    wanted = collections.Counter()
    for r in odd.collect():
        n = len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        wanted.update((r["doc_id"], k, s, min(64, n - s)) for k, s in enumerate(range(0, n, 64)))
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in found) == wanted
    sequences = collections.defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64


def test_empty_tables(odd):
    none = odd.limit(0)
    assert fingerprint_edits(none).count() == 0
    assert mixed(none).count() == 0
    assert near_documents(none).count() == 0 and drop_near_documents(none).count() == 0
    assert remove_repeated_passages(none).count() == 0
    assert dedup_lines(none).count() == 0
    assert identify_languages(none).count() == 0
    assert pack_documents(none, tokenizer_path()).count() == 0


def test_pipeline_stages_keep_columns(spark, odd, tmp_path):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, "")
        assert done.columns == docs.columns and done.dtypes == docs.dtypes
        done.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= docs.count() > 0

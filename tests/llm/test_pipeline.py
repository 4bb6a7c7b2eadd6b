"""The rows of the pipeline's stages, each against a plain version on its own input."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from sparkprep.llm.lines import similar
from sparkprep.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({i: i + 32 for i in range(65, 91)})


def made():
    """Two languages, repeated and near lines, copies, near copies, texts without letters, wholly repeated rows."""
    rng = random.Random(11)
    lexicon = {
        "en": "the of and to in that was with for this from have they which house water people morning".split(),
        "de": "der die und nicht ist mit für auf eine dem werden können straße häuser wasser menschen morgen über".split(),
    }
    rows = []
    for i in range(120):
        lang = "en" if i % 2 else "de"
        lines = [" ".join(rng.choices(lexicon[lang], k=rng.randrange(14, 30))) for _ in range(rng.randrange(1, 4))]
        if i % 10 == 0:
            lines.insert(0, "Subscribe to our newsletter now and read every story first")
        if i % 10 == 5:
            lines.append("subscribe to our newsletter now and read every stories first!")
        rows.append((i, "\n".join(lines), lang, f"s{i % 3}", 0))
    long = " ".join(rng.choices(lexicon["en"], k=150))
    rows += [(200, long, "en", "s0", 0), (201, long.replace("water", "stone", 1), "en", "s1", 0)]
    rows += [(300, "12 34 !!", "en", "s0", 0), (301, None, "de", "s1", 0), (302, "", "en", None, 0)]
    rows += [rows[7], rows[8]]
    return rows


def normal(line):
    lowered = line.translate(LOWER).translate({i: i + 32 for i in range(0xC0, 0xDF) if i != 0xD7})
    return " ".join(re.findall("[a-z0-9\x80-\U0010ffff]+", lowered))


def groups(n, linked):
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            if root(i) != root(j) and linked(i, j):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(n)]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, as rows."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.createDataFrame(made(), "doc_id long, text string, lang string, source string, n_chars long")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, "")
        done.write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs.collect(), after.collect()
        docs = after
    return out


def table(rows):
    return sorted(map(tuple, rows), key=str)


def test_languages(stages):
    before, after = stages["language_id"]
    wanted = [r for r in before if any(c.isalpha() for c in r["text"] or "")]
    assert table(after) == table(wanted)


def test_lines(stages):
    before, after = stages["line_dedup"]
    places = sorted({(r["doc_id"], k, x) for r in before for k, x in enumerate(r["text"].split("\n"))})
    forms = [normal(x) for _, _, x in places]
    root = groups(len(forms), lambda i, j: forms[i] and forms[j] and similar(forms[i], forms[j], 0.8))
    gone = {places[i][:2] for i in range(len(forms)) if root[i] != i}
    assert len(gone) >= 23
    wanted = []
    for r in before:
        text = "\n".join(x for k, x in enumerate(r["text"].split("\n")) if (r["doc_id"], k) not in gone)
        wanted.append((r["doc_id"], text, r["lang"], r["source"], len(text)))
    assert table(after) == table(wanted)


def test_near_copies(stages):
    before, after = stages["near_dedup"]
    rows = sorted(set(map(tuple, before)), key=lambda r: (r[0], str(r)))
    sets = []
    for r in rows:
        w = WORD.findall(r[1].translate(LOWER))
        k = min(5, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    near = lambda i, j: sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    root = groups(len(rows), near)
    wanted = [r for i, r in enumerate(rows) if root[i] == i or not sets[i]]
    empty = [r for r in map(tuple, before) if not WORD.findall(r[1])]
    wanted = [r for r in wanted if WORD.findall(r[1])] + empty
    assert table(after) == table(wanted) and len(wanted) < len(before)


def test_mixing(stages):
    before, after = stages["mix_sources"]
    sizes = collections.Counter()
    for r in before:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    order = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    level, capped = 0.0, set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        level = left / max(sum(weight[s] for s in order if s not in capped), 1)
        more = {s for s in order if 2 * sizes[s] < weight[s] * level} | capped
        if more == capped:
            break
        capped = more
    wanted = []
    for r in before:
        size = sizes[r["source"]]
        rate = min(2 * size, weight[r["source"]] * level) / size if size else 0
        drawn = int(hashlib.md5(f"mix-1|{r['doc_id']}".encode()).hexdigest()[:13], 16) / (1 << 52)
        wanted += [tuple(r)] * (int(rate) + (drawn < rate - int(rate)))
    assert table(after) == table(wanted)


def test_packing(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    before, after = stages["pack_sequences"]
    wanted = collections.Counter()
    for r in before:
        n = len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        wanted.update((r["doc_id"], k, s, min(4096, n - s)) for k, s in enumerate(range(0, n, 4096)))
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in after) == wanted
    sequences = collections.defaultdict(list)
    for r in after:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert len(sequences) <= -(-sum(r["length"] for r in after) // 4096) + 1

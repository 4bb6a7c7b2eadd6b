"""Ranked search against brute force, with odd rows, several blocks of items and pruned pairs."""

import collections
import math
import random
import re

import numpy as np

from sparkprep.llm import ranked_search
from sparkprep.llm.ranked_search import Best, Sparse, dual_tree, search, with_hierarchy

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({i: i + 32 for i in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    lists = [(i, collections.Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in lists]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = collections.Counter(t for _, c in lists for t in c)
    out = []
    for item, text in items:
        scores = []
        for (doc, c), n in zip(lists, sizes):
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 25 + (75 * n * n_docs) // total
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_odd_rows(spark, odd):
    texts = ["the lazy DOG runs", "fuchs Läuft davon", "word5 word6 tail 1234", None, "", "the the one", "nul byte"]
    items = spark.createDataFrame(
        [(i if i != 5 else None, t, 1.0) for i, t in enumerate(texts)], "item_id long, text string, score double"
    )
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    wanted = brute(docs, [(r["item_id"], r["text"]) for r in items.collect()])
    assert found(search(odd.repartition(3), items)) == wanted
    assert found(search(odd, items, block_terms=8)) == wanted  # several blocks of items
    assert search(odd.limit(0), items).count() == 0 and search(odd, items.limit(0)).count() == 0


def test_many_ties_and_first_thresholds(spark, monkeypatch):
    """Repeated documents tie at the tenth place; the first thresholds come from a part of the rows."""
    monkeypatch.setattr(ranked_search, "SEED_DOCS", 50)
    rng = random.Random(3)
    texts = [" ".join(f"t{int(rng.paretovariate(0.6)) % 500}" for _ in range(rng.randrange(1, 40))) for _ in range(250)]
    docs = [(i, texts[i % 250]) for i in rng.sample(range(2000), 1000)]
    items = [(i, " ".join(f"t{int(rng.paretovariate(0.5)) % 500}" for _ in range(12))) for i in range(40)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(search(table, asked)) == brute(docs, items)


def test_node_pairs_are_pruned():
    """Items that share terms with a few documents only: most pairs are never scored, none is lost."""
    rng = np.random.default_rng(5)
    n, n_items = 4000, 60
    topic = np.arange(n) % 40
    row = np.repeat(np.arange(n), 12)
    term = (topic[row] * 50 + rng.integers(0, 50, len(row))) % 2000
    cells = np.unique(row * 2000 + term)
    docs = Sparse(cells // 2000, cells % 2000, rng.integers(1, 1000, len(cells)))
    cells = np.unique(np.repeat(np.arange(n_items), 8) * 2000 + np.repeat(rng.integers(0, 40, n_items), 8) * 50 + rng.integers(0, 50, 8 * n_items))
    vectors = Sparse(cells // 2000, cells % 2000, rng.integers(1, 50, len(cells)))
    items = with_hierarchy(np.arange(n_items), np.arange(2000, dtype=np.uint64), vectors, np.ones(2000))
    best = Best(n_items, 10, np.zeros(n_items, np.int64))
    scored, pairs = dual_tree(items, docs, np.arange(n), best)
    assert pairs == n * n_items and scored < pairs / 10
    dense = np.zeros((n, 2000), np.int64)
    dense[docs.row, docs.term] = docs.value
    weights = np.zeros((n_items, 2000), np.int64)
    weights[vectors.row, vectors.term] = vectors.value
    scores = dense @ weights.T
    for i in range(n_items):
        order = np.lexsort((np.arange(n), -scores[:, i]))[:10]
        order = order[scores[order, i] > 0]
        assert best.found[i][0].tolist() == order.tolist()
        assert best.found[i][1].tolist() == scores[order, i].tolist()

"""Embedding near-dedup against all pairs, odd vectors and recall at the threshold."""

import numpy as np

from sparkprep.llm.embeddings import list_decode, near_embeddings


def brute(vectors, least=0.9):
    usable = [
        v is not None and len(v) > 0 and None not in v and bool(np.isfinite(np.array(v, float)).all()) and any(v)
        for v in (x for _, x in vectors)
    ]
    units = [np.array(v, float) / np.linalg.norm(np.array(v, float) / 1e3) / 1e3 if u else None for (_, v), u in zip(vectors, usable)]
    n, links, up = len(vectors), [0] * len(vectors), list(range(len(vectors)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            if usable[i] and usable[j] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    ids = [i for i, _ in vectors]
    groups = {}
    for k in range(n):
        groups.setdefault(root(k), []).append(ids[k])
    out = []
    for k in range(n):
        known = [x for x in groups[root(k)] if x is not None]
        c = min(known) if known else None
        out.append((ids[k], links[k], c, c == ids[k]))
    return sorted(out, key=str)


def test_against_all_pairs(spark, monkeypatch):
    from sparkprep.llm import embeddings

    monkeypatch.setattr(embeddings, "PART", 7)  # many blocks for one filter
    rng = np.random.default_rng(1)
    vectors = []
    for group in range(4):
        centre = rng.standard_normal(24)
        for _ in range(30):
            vectors.append((len(vectors) + 10, (centre + 0.09 * rng.standard_normal(24)).tolist()))
    vectors += [(500 + i, rng.standard_normal(24).tolist()) for i in range(60)]
    inf, nan = float("inf"), float("nan")
    vectors += [
        (1, None), (2, []), (3, [0.0] * 24), (4, [1.0] * 23 + [nan]), (5, [inf] * 24), (6, [1.0, None]),
        (7, [2.0, 1.0]), (8, [200.0, 100.0]), (None, [2.0, 1.0]), (7, [2.0, 1.0]), (9, [3.0]), (9, [3.0]),
        (20, vectors[0][1]), (-3, vectors[0][1]),
    ]
    rows = [(i, v, k, "x") for k, (i, v) in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, kind int, n_links string").repartition(4)
    found = sorted(map(tuple, near_embeddings(df).collect()), key=str)
    assert found == brute(vectors)
    assert near_embeddings(df.limit(0)).count() == 0


def test_recall_at_the_threshold():
    """Pairs of exactly 0.9 in 64 dimensions share a filter."""
    rng = np.random.default_rng(3)
    found = 0
    for _ in range(200):
        x, z = rng.standard_normal(64), rng.standard_normal(64)
        x /= np.linalg.norm(x)
        z -= (z @ x) * x
        y = 0.9 * x + np.sqrt(1 - 0.81) * z / np.linalg.norm(z)
        found += bool(len(np.intersect1d(list_decode(x), list_decode(y))))
    assert found >= 196


def test_huge_components_do_not_overflow(spark):
    df = spark.createDataFrame([(1, [1e200, 1e200]), (2, [1e-200, 1e-200])], "vec_id long, embedding array<double>")
    assert [r["component_id"] for r in near_embeddings(df).collect()] == [1, 1]

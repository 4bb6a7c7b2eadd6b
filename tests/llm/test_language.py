"""The kernel and the regression by hand, held-out accuracy, and the memory of short texts."""

import resource

import numpy as np
import pyarrow as pa

from sparkprep.llm.language import BUCKETS, ROWS, _scaled, fit, held_out, identify_languages, presence
from sparkprep.llm.queries import read


def grams(text):
    flat = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split(" "))
    data = flat.encode()
    return {data[i : i + k] for k in (1, 2, 3) for i in range(len(data) - k + 1)}


def test_kernel_is_the_shared_runs_over_the_mean_size():
    texts = ["the cat sat", "the hat", "zug fährt", "", "a"]
    x = np.concatenate([x for _, x in presence(pa.array(texts))])
    assert x.shape == (5, BUCKETS)
    kernel = _scaled(x) @ _scaled(x).T
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            both = len(grams(a) & grams(b))
            wanted = both / np.sqrt(max(len(grams(a)), 1) * max(len(grams(b)), 1))
            assert abs(kernel[i, j] - wanted) < 0.02  # runs that share a bucket


def test_weights_solve_the_ridge_system(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 6)]
    rows = [(i, f"{t} {'abc'[i % 3] * (i + 1)}", lang) for i, t, lang in rows]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), landmarks=12, ridge=0.1)
    assert model.languages == ["de", "en"] and len(model.landmarks) == 12
    base = model.landmarks.astype(np.float64)
    kernel = base @ base.T
    labels = np.array([[0.0, 1.0] if r[2] == "en" else [1.0, 0.0] for r in rows])
    order = [int(np.argmin([np.abs(_scaled(x) - b).sum() for x in np.concatenate([x for _, x in presence(pa.array([r[1] for r in rows]))])[:, None]])) for b in base]
    wanted = np.linalg.solve(kernel @ kernel / 12 + 0.1 * kernel / 12 + 1e-9 * np.trace(kernel @ kernel / 12) * np.eye(12), kernel @ labels[order] / 12)
    assert np.abs(kernel @ wanted - kernel @ model.weights).max() < 0.02


def test_held_out_accuracy(spark, small):
    docs = read(spark, small, "documents")
    found = identify_languages(docs.select("doc_id", "text", "lang")).where("held_out AND lang_pred <> 'und'").collect()
    assert len(found) > 20 and sum(r["lang"] == r["lang_pred"] for r in found) >= 0.95 * len(found)
    assert docs.where(held_out(docs["doc_id"])).count() >= len(found)


def test_many_short_texts_take_little_memory():
    column = pa.array([f"short text {i}" for i in range(10_000)])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    seen = 0
    for first, x in presence(column):
        assert first == seen and len(x) <= ROWS
        seen += len(x)
    assert seen == 10_000 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 150_000

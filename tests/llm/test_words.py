"""Words of whole texts as arrays agree with regular expressions."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkprep.llm.words import joined_words, shingles, windows, words

TEXT = st.text(st.sampled_from("aB é\t\n\x0b\x0c\r 漢.😀"), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.integers(1, 30))
def test_words(texts, size):
    found = {}
    for block in words(pa.array(texts, pa.string()), size=size):
        for i in range(len(block.offsets) - 1):
            at = range(block.offsets[i], block.offsets[i + 1])
            found[block.first + i] = [
                (block.data[block.starts[k] : block.ends[k]].tobytes().decode(), int(block.hashes[k])) for k in at
            ]
    wanted = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert [[w for w, _ in found[i]] for i in range(len(texts))] == wanted
    hashes = {h: w for ws in found.values() for w, h in ws}
    assert all(hashes[h] == w for ws in found.values() for w, h in ws)
    assert len(hashes) == len({w for ws in wanted for w in ws})


def test_lower_case_and_long_texts():
    texts = ["Ab ÀB " * 50_000, "ab"]
    blocks = list(words(pa.array(texts), lower=True, size=1000))
    assert [b.first for b in blocks] == [0, 1]
    assert len(set(blocks[0].hashes.tolist())) == 2 and blocks[1].hashes[0] in blocks[0].hashes
    assert joined_words(blocks[0], np.array([1, 0]), np.frombuffer(b"|", np.uint8)) == "Àb|ab|"


def test_windows_and_shingles():
    h = np.array([5, 6, 7, 5, 6, 7], dtype=np.uint64)
    w = windows(h, 3)
    assert len(w) == 4 and w[0] == w[3] and len(set(w.tolist())) == 3
    assert len(windows(h, 7)) == 0 and len(shingles(h[:0])) == 0
    assert len(shingles(h, 3)) == 3 and len(shingles(h[:2], 5)) == 1

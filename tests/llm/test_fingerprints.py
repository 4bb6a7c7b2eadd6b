"""Subset hashes and likeness, one term and one chain at a time."""

import random

import numpy as np

from sparkprep.llm.fingerprints import _SALTS, HALVINGS, SUBSETS, fingerprints, likeness
from sparkprep.llm.words import mix, words_of

MASK = (1 << 64) - 1


def mixed(x):
    return int(mix(np.array([x & MASK], dtype=np.uint64))[0])


def hashes(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return {int(h) for h in words_of(data, np.array([0, len(data)]), lower=True).hashes}


def by_hand(text, kept):
    """(whole hash, subset of terms and its byte for each halving and chain)."""
    found = hashes(text) & kept or hashes(text)

    def hashed(terms):
        values = [mixed(t + 0xC2B2AE3D27D4EB4F) for t in terms]
        low, high = (sum(v >> shift & (1 << 26) - 1 for v in values) for shift in (0, 26))
        return mixed(mixed(low + 1) ^ high) if terms else 0

    def halvings(term, chain):
        drawn = mixed(term ^ int(_SALTS[chain])) >> 11
        return min(53 - drawn.bit_length(), HALVINGS)

    subsets = [
        [frozenset(t for t in found if halvings(t, c) >= h) for c in range(SUBSETS)] for h in range(1, HALVINGS + 1)
    ]
    return hashed(found), subsets, [[max(hashed(s) >> 56, 1) if s else 0 for s in row] for row in subsets]


def test_subset_hashes_and_likeness():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.sample(vocabulary, rng.choice([1, 3, 30, 200]))) for _ in range(8)]
    texts += [texts[-1] + " w1 extra", texts[-2] + " W7", "", "none of the band"]
    kept = set().union(*[hashes(w) for w in vocabulary if int(w[1:]) % 4])
    whole, parts = fingerprints(texts, np.sort(np.array(sorted(kept), dtype=np.uint64)))
    told = [by_hand(t, kept) for t in texts]
    for i, (w, _, bytes_of) in enumerate(told):
        assert int(whole[i]) == w and parts[i].tolist() == bytes_of
    for i in range(len(texts)):
        for j in range(len(texts)):
            found = likeness((whole[[i]], parts[[i]]), (whole[[j]], parts[[j]]))[0]
            if told[i][0] == told[j][0]:
                assert found == 1
                continue
            wanted = None
            for h in range(HALVINGS):
                pairs = [(a, b) for a, b in zip(told[i][1][h], told[j][1][h]) if a or b]
                if len(pairs) >= SUBSETS // 2 or wanted is None:
                    wanted = sum(a == b for a, b in pairs) / max(len(pairs), 1)
            assert abs(found - wanted) <= 2 / SUBSETS  # subsets that share a byte


def test_near_texts_are_liker_than_others():
    rng = random.Random(2)
    words = [f"t{i}" for i in range(5000)]
    text = rng.choices(words, k=300)
    near, far = text[:285] + rng.choices(words, k=15), rng.choices(words, k=300)
    whole, parts = fingerprints([" ".join(t) for t in (text, near, far)], np.empty(0, np.uint64))
    first = (whole[[0, 0]], parts[[0, 0]])
    found = likeness(first, (whole[1:], parts[1:]))
    assert found[0] > found[1] + 0.3

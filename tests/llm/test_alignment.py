"""Alignment against whole-text tokenisation, and the laws of fragments."""

import base64
import bisect
import collections
import hashlib
import random

import numpy as np
import pytest

from sparkprep.llm.alignment import Fragment, Tokenizers, aligned, composed, range_fragments, ranges, with_link_counts
from sparkprep.llm.queries import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """(ids, bytes) of whole texts, by the library that the files are made for."""
    import sentencepiece
    from tokenizers import Tokenizer

    with open(tokenizer_path("byte_bpe_50k.tiktoken"), "rb") as f:
        bytes_of = {int(i): base64.b64decode(x) for x, i in map(bytes.split, f)}
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)

    def piece_bytes(i):
        p = second.id_to_piece(i)
        return bytes.fromhex(p[3:5]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    def tokens(text):
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        return [(i, bytes_of[i]) for i in a], [(i, piece_bytes(i)) for i in b]

    return tokens


def brute(docs, plain):
    rows, links = [], []
    for doc, text in docs:
        a, b = plain(text) if text else ([], [])
        whole = (" " + text).encode() if text else b""
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a, b = [], []
        ends = [{}, {}]
        for side, tokens in enumerate((a, b)):
            at = 0
            for i, x in tokens:
                at += len(x)
                ends[side][at] = i
        cuts = sorted(set(ends[0]) & set(ends[1]))
        own = [(ends[0][c], ends[1][c]) for c in cuts]
        members = [([], []) for _ in cuts]
        for side in (0, 1):
            for e, i in sorted(ends[side].items()):
                members[bisect.bisect_left(cuts, e)][side].append(str(i))
        groups = ["|".join(map(",".join, m)) for m in members]
        rows.append((doc, len(a), len(b), len(groups), ";".join(groups)))
        links.append(own)
    count = collections.Counter(p for own in links for p in own)
    most = collections.Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for (doc, n_a, n_b, n_groups, groups), own in zip(rows, links):
        best = sum(count[p] == most[p[1]] for p in own)
        out.append((doc, n_a, n_b, n_groups, groups, len(own), best, sum(count[p] for p in own)))
    return sorted(out, key=str)


def found(df):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum"]
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


ODD = [
    "  two  spaces ",
    " ",
    "tab\tand\n\nlines \n end ",
    "nul\x00 <s> </s> <|endoftext|> <0x41> [INST]",
    "under▁score is a space to one",
    "é Å Å ﬁ \U0001f600\U0001f600 　 z   line",
    "﻿mark ​ zero",
    "x" * 400 + " " + "ab " * 300,
    "你好世界 " * 40,
]


def test_short_and_long_texts(spark, odd, plain):
    rng = random.Random(7)
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()] + [(100 + i, t) for i, t in enumerate(ODD)]
    mixed = ["the", "tokenizers'", "Straße", "é", "don't", "\n", "1234567", "", "你好", "co-operate,"]
    docs += [(200 + i, " ".join(rng.choice(mixed) for _ in range(rng.randrange(1, 900)))) for i in range(12)]
    docs.append((300, None))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    wanted = brute(docs, plain)
    assert found(with_link_counts(aligned(table, A, B), A, B)) == wanted
    # Most texts dealt to several tasks by ranges of 90 bytes, with several steps of the tree.
    assert found(with_link_counts(aligned(table, A, B, size=90, long=100), A, B)) == wanted
    digests = aligned(table, A, B, digest=True).select("doc_id", "groups").collect()
    hashed = [(w[0], hashlib.sha256(w[4].encode()).hexdigest() if w[4] else "") for w in wanted]
    assert sorted(map(tuple, digests), key=str) == sorted(hashed, key=str)


def test_empty_table(spark, odd):
    assert with_link_counts(aligned(odd.limit(0), A, B), A, B).count() == 0


def test_fragments_compose_associatively():
    tokens = Tokenizers.of(A, B)
    words = "internationalisation counterrevolutionary pseudopolynomial Straßenbahnhaltestelle well-known 1234567".split()
    text = (" " + " ".join(words[i * i % 6] for i in range(90))).encode()
    found = ranges(np.frombuffer(text, np.uint8), 24)
    parts = list(range_fragments(tokens, [(text[low:high], low, start, end) for start, end, low, high in found]))
    assert len(parts) > 8 and any(len(p.suffix_a) for p in parts) and any(len(p.prefix_b) > 1 for p in parts)

    def plain(f):
        return [x.tolist() if isinstance(x, np.ndarray) else x for x in f]

    (whole,) = range_fragments(tokens, [(text, 0, 0, len(text))])
    left = Fragment.none()
    for p in parts:
        left = composed(tokens, left, p)
    right = Fragment.none()
    for p in reversed(parts):
        right = composed(tokens, p, right)
    assert plain(left) == plain(right) == plain(whole)


def test_ranges_have_bounded_windows():
    rng = random.Random(1)
    text = ("a" * 500 + " " + " ".join("w" * rng.randrange(1, 30) for _ in range(400))).encode()
    found = ranges(np.frombuffer(b" " + text, np.uint8), 100)
    assert [r[0] for r in found[1:]] == [r[1] for r in found[:-1]] and found[-1][1] == len(text) + 1
    for start, end, low, high in found:
        assert low <= start < end <= high and start - low < 100 and high - end < 100


def test_pairs_are_bounded_by_the_vocabularies():
    tokens = Tokenizers.of(A, B)
    assert len(tokens.pairs) <= sum(map(len, tokens.bytes_a)) + sum(map(len, tokens.bytes_b))

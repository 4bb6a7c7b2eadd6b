"""Groups of the packing stay bounded where sequences cannot be filled; ids are those of whole texts."""

import collections
import zlib

import numpy as np

from sparkprep.llm.packing import packed, pieces
from sparkprep.llm.queries import read, tokenizer_path


def test_ids_are_those_of_whole_texts(spark, odd, small):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    marks = ["don't (stop)!", "a<|endoftext|>b C", "ÀÉ×÷ß, Œuvre", "x.y,z;1,000.50$", "tab\t\u00a0\u3000end", "é.é 'S 'll"]
    extra = spark.createDataFrame([(900 + i, t) for i, t in enumerate(marks)], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(extra).unionByName(read(spark, small, "documents").select("doc_id", "text"))
    wanted = collections.Counter()
    for r in docs.collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        wanted.update((r["doc_id"], k, zlib.crc32(ids[s : s + 128].tobytes())) for k, s in enumerate(range(0, len(ids), 128)))
    found = pieces(docs.repartition(3), tokenizer_path(), length=128).collect()
    assert collections.Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in found) == wanted


def test_no_group_takes_all_that_is_left(spark):
    rows = [(i, 0, 0, 2500, i) for i in range(1000)] + [(2000 + i, 0, 0, 40 + i, i) for i in range(20)]
    parts = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(4)
    found = packed(parts, length=4096, group=50).collect()
    assert sorted((r["doc_id"], r["length"]) for r in found) == [(r[0], r[3]) for r in rows]
    places = collections.Counter((r["sequence_id"], r["offset"]) for r in found)
    assert max(places.values()) == 1 and len({r["sequence_id"] for r in found}) <= 1010
    groups = collections.Counter(r["sequence_id"] >> 24 for r in found)
    assert max(groups.values()) <= 100

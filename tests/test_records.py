"""Delimited text with line breaks inside quotes, read by many tasks as by one."""

import csv
import io
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException

from sparkprep.sources.records import states_before
from sparkprep.sources.tables import read_delimited


@pytest.fixture
def many_splits(spark):
    """Files are cut every few hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "300b")
    spark.conf.set(names[1], "1b")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def dump(rows, newline="\n"):
    out = io.StringIO()
    writer = csv.writer(out, delimiter="\t", lineterminator=newline)
    writer.writerows(rows)
    return out.getvalue()


def made(n, seed):
    rng = random.Random(seed)
    cells = ["plain", "with\nbreak", 'a "quoted" word', "two\n\nbreaks\n", "tab\there", "x" * 90, '""', "long\n" * 60, "é\n ü"]
    return [(f"r{i}", rng.choice(cells), str(i % 7), rng.choice(cells[:3])) for i in range(n)]


def test_states_follow_from_line_functions():
    rng = random.Random(2)
    for _ in range(300):
        does = [rng.randrange(4) for _ in range(rng.randrange(0, 12))]
        for start in (0, 1):
            wanted = [start]
            for d in does:
                wanted.append(d >> wanted[-1] & 1)
            assert states_before(np.array(does, dtype=np.int64), start).tolist() == wanted


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_many_tasks_read_the_rows_that_one_task_reads(spark, tmp_path, many_splits, newline):
    rows = made(400, 5)
    for k in range(2):
        (tmp_path / f"part{k}.tsv").write_bytes(dump([("a", "b", "c", "d"), *rows[k::2]], newline).encode())
    found = read_delimited(spark, str(tmp_path), numeric=["c"], null_tokens=[""])
    assert found.rdd.getNumPartitions() > 20
    assert rows_of(found) == sorted(((a, b, float(c), d) for a, b, c, d in rows), key=str)
    one = read_delimited(spark, str(tmp_path), numeric=["c"], null_tokens=[""], multi_line=True)
    assert rows_of(one) == rows_of(found)


def test_quotes_inside_plain_fields_open_nothing(spark, tmp_path, many_splits):
    text = 'a\tb\n5" pipe\tsay "hi\n' + 'x\t"open\nand ""closed"""\n' * 60 + 'last\t"never closed\nends here'
    (tmp_path / "d.tsv").write_text(text)
    found = rows_of(read_delimited(spark, str(tmp_path / "d.tsv")))
    assert ('5" pipe', 'say "hi') in found and len(found) == 62
    assert found.count(("x", 'open\nand "closed"')) == 60
    assert [r for r in found if r[0] == "last"]


def test_rows_with_too_many_fields_go_and_short_ones_are_filled(spark, tmp_path, many_splits):
    text = "a\tb\n" + "1\t2\n" * 80 + "1\t2\t3\n" + '"only\none"\n\n' + "5\t6\n" * 80
    (tmp_path / "d.tsv").write_text(text)
    found = rows_of(read_delimited(spark, str(tmp_path / "d.tsv")))
    assert len(found) == 161 and ("only\none", None) in found


def test_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("a\tb\n1\t2\n")
    (tmp_path / "y.tsv").write_text("a\tc\n1\t2\n")
    with pytest.raises(PySparkException):
        read_delimited(spark, str(tmp_path)).collect()


def test_a_header_alone(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("a\tb\n")
    assert read_delimited(spark, str(tmp_path / "x.tsv")).count() == 0

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from sparkprep.workspace import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", **{"spark.sql.shuffle.partitions": "3"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


#: Documents with nulls, empty texts, white space of all kinds, ties and repeated rows.
LONG = " ".join(f"word{i % 97} Ünï{i % 89} tail" for i in range(3000))
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it all today.\nShared line here now.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from it all today.\nShared line here now.", "en", "b"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from it all today.\nShared line here now.", "en", "b"),
    (3, None, "en", None),
    (4, "", None, "a"),
    (5, " \t\n\x0b ", "de", "a"),
    (6, "one", "en", "é"),
    (7, "1234 !!! 99", "en", "z"),
    (8, LONG, "de", "a"),
    (9, LONG + " end", "de", None),
    (None, "Der schnelle braune Fuchs springt über den faulen Hund und läuft davon.\nShared line here now!", "de", "b"),
    (-10, "nul\x00byte and line sep one two three", "en", "b"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with a column more than the operators know and names that clash with their own."""
    rows = [(*r, len(r[1] or ""), float(i), f"x{i}") for i, r in enumerate(DOCS)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, kind string"
    return spark.createDataFrame(rows, schema)

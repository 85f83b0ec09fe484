from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
PROSE = "the quick brown fox jumps over the lazy dog and runs far away from here today"
LINE = "One line that several documents share."

# Ids, texts: nulls, empties, copies, ties, repeated rows, a very long text, other scripts.
ROWS = [
    (1, f"{PROSE}\n{LINE}\nown line of the first document"),
    (2, f"{PROSE} again\n  {LINE.upper()}\t\nown line of the second document"),
    (3, f"{PROSE}\n{LINE}\nown line of the first document"),
    (3, f"{PROSE}\n{LINE}\nown line of the first document"),
    (4, None),
    (5, ""),
    (6, "\n\n"),
    (7, "word"),
    (8, "two words"),
    (9, "ÉCOLE École école 北京 🙂 naïve " * 3),
    (10, " ".join(f"w{n % 977}" for n in range(30_000)) + "\n" + LINE),
    (None, f"{PROSE}\n{LINE}"),
    (None, None),
    (12, "idiot idiot\r\n" + LINE + " \x0b"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """The rows above, with columns whose names operators use for results or inside."""
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, n_lines string, fingerprint string, "
        "component_id string, toxicity string, lang_pred string, licenses string, gram string, size string, y string"
    )
    rows = [(i, t, "en" if t else None, "s", len(t or ""), *["x"] * 9) for i, t in ROWS]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def tables(spark):
    if not os.path.isdir(SF):
        pytest.skip("benchmark tables not present")
    return SF

"""Small documents with every awkward shape, used by all tests of this folder."""

import random
from pathlib import Path

import pyarrow.parquet as pq

FOLDER = Path("/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    """Test documents without repeated ids: real ones, empty, NULL, blank, very long, copies, odd characters."""
    rows = [tuple(r.values()) for r in pq.read_table(FOLDER / "documents.parquet").slice(0, 120).to_pylist()]
    draw = random.Random(5)
    long = " ".join(draw.choice(["alpha", "beta", "gamma", "delta,", "Épsilon"]) + str(draw.randrange(4000)) for _ in range(30_000))
    odd = [None, "", " \t\r\n\x0b\x0c ", "one", "Ünï 日本語 😀 ǅ x y  z", "a b c d", long, rows[0][1], rows[0][1], rows[1][1] + " tail", "\n\n" + rows[2][1]]
    return rows + [(1000 + i, t, None if i % 2 else "xx", None if i % 3 else "src1", len(t or "")) for i, t in enumerate(odd)]


def frame(spark, rows=None, extra=()):
    """The documents as a DataFrame; ``extra`` names columns that clash with names used inside."""
    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
    for name in extra:
        df = df.selectExpr("*", f"'kept' AS `{name}`")
    return df


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")

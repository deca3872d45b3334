import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = Path("/root/testdata/sf0.001")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def edge_rows():
    """NULLs, empty and blank texts, one-word texts, repeated rows, ties, one very long text, odd characters."""
    pick = random.Random(7)
    vocabulary = ["".join(pick.choices("abcdefgh", k=pick.randint(1, 9))) for _ in range(400)]
    prose = [" ".join(pick.choices(vocabulary, k=pick.randint(60, 260))) for _ in range(12)]
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "\n\n"), (4, "word"), (4, "word"), (5, "one two three four"),
            (6, "ONE two  three\nfour"), (None, "an id is missing"), (None, None), (7, "tie"), (8, "tie"),
            (9, "Größe naïve 東京 x   y"), (10, "a\x0bb\x0cc\rd"), (11, "a a a a a a a a"),
            (12, " ".join(pick.choices(vocabulary, k=30_000)))]
    for i, text in enumerate(prose):
        words = text.split()
        words[len(words) // 2] = "changed"
        rows += [(100 + i, text), (200 + i, text), (300 + i, " ".join(words)),
                 (400 + i, " ".join([*words[:5], *prose[0].split()[:58], *words[5:9]])),
                 (500 + i, f"Shared Line\n{text}\n  shared line \nown {i}")]
    return rows + [(600, prose[3]), (600, prose[3]), (None, prose[4])]


@pytest.fixture(scope="session")
def rows_small(spark):
    if not SMALL.exists():
        pytest.skip("no test tables")
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def edge():
    return edge_rows()


@pytest.fixture
def table(spark):
    """Rows as a table with further columns whose names clash with those used inside."""

    def make(rows):
        df = spark.createDataFrame(rows, SCHEMA)
        return df.selectExpr("doc_id", "text", "1 AS _block", "2 AS text_hash", "'x' AS key", "3 AS n_lines", "4 AS label",
                             "5 AS _unit", "6 AS size", "7 AS fail_bits", "8 AS ids", "9 AS n_words").repartition(5)

    return make

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that the operators use for columns of their own.
    "r string, t int, row string, f int, mix string, dedup string, language string, `a.b` int"
)
EXTRA = ("r", 1, "row", 2, "mix", "dedup", "language", 3)


def document(doc_id, text, lang="en", source="web"):
    return (doc_id, text, lang, source, None if text is None else len(text), *EXTRA)


def prose(seed, n, words=("the", "of", "Tree", "river", "Über", "stone,", "walk", "élan", "42", "cloud.")):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(n))


def unusual_documents():
    """NULLs in every column, empty, blank and very long texts, repeated rows, copies, odd characters."""
    long = prose(1, 40_000, [f"w{i}" for i in range(3000)])
    rows = [
        document(0, prose(2, 120)),
        document(1, prose(2, 120)),  # a copy
        document(2, prose(2, 119) + " other"),
        document(3, None),
        document(4, ""),
        document(5, " \t\r\n\x0b\x0c "),
        document(6, "12 34 !!! ²"),
        document(7, "one"),
        document(8, "Two words"),
        document(9, long),
        document(10, "漢字 と かな ﬁ ▁ <|endoftext|> <s>"),
        document(11, "A B C\x1fD\x85E  double  blanks "),
        document(12, prose(3, 80), lang=None, source=None),
        document(13, prose(4, 200), lang="de", source="books"),
        document(13, prose(4, 200), lang="de", source="books"),  # the same row again
        document(None, prose(5, 60)),
        document(None, None, lang=None, source=None),
        document(15, prose(6, 50) + "\n" + prose(7, 40) + "\n" + prose(6, 50), source="books"),
        document(16, prose(7, 40), source=""),
        tuple([None] * (5 + len(EXTRA))),
    ]
    return rows


@pytest.fixture(scope="session")
def unusual(spark):
    return spark.createDataFrame(unusual_documents(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    """Documents of the small test tables."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def sorted_rows(df, *columns):
    """Rows as tuples, in an order that NULLs don't upset."""
    found = [tuple(row) for row in df.select(*columns).collect()]
    return sorted(found, key=lambda row: [(v is not None, str(v)) for v in row])


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda row: [(v is not None, str(v)) for v in row])

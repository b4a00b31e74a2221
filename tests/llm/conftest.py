import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, sha string, size long, row string, rep long, text_hash string"


def passage(seed, n):
    """n invented words."""
    return " ".join(f"w{(seed * 7919 + k * k * 31 + k * 17) % 9973}x{k % 7}" for k in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, very long, equal, repeated and nearly equal texts, ids with
    gaps and one null; further columns have names that operators use inside."""
    long, shared = passage(1, 20_000), passage(2, 150)
    texts = [(3, None), (4, ""), (5, " \t\n "), (10, "one"), (11, "One"), (12, "ONE two three"), (20, long), (21, passage(3, 300) + " " + shared),
             (22, shared + " " + passage(4, 200)), (23, passage(5, 120)), (24, passage(5, 120)), (25, passage(5, 119) + " end"), (25, passage(5, 119) + " end"),
             (40, "é" * 300 + " \x00 <|endoftext|> 日本語 \U0001f642"), (41, "1234 -- 567"), (7, "ab " * 400), (None, "ab " * 50), (1000, passage(6, 60))]
    return [(i, t, ["en", None, "de"][k % 3], [None, "a", "b", ""][k % 4], 0, "x", k, "r", -k, "h") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_rows():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()


def ordered(rows):
    """By doc_id, null first."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))

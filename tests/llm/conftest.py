import pytest

KINDS = "doc_id long, text string, lang string, source string, n_chars long, word string, fp long, failed long, shard int, payload string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A table of documents from (doc_id, text) pairs, with further columns whose names operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(k, t, "en", "web", len(t or ""), "w", 1, 2, 3, "p") for k, t in rows], KINDS)

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


LONG = " ".join(f"w{k % 977} x{k * 7 % 1009}" for k in range(60_000))
#: Nulls in both columns, empty and blank texts, a very long one, ties, repeated rows, characters of several bytes.
ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "alone without a key"), (None, None), (4, "same same"), (4, "same same"), (5, "same same"), (6, LONG), (7, "ação é 漢字 🙂 " * 30), (-8, "negative key"), (9, "x" * 5000)]


@pytest.fixture(scope="session")
def odd():
    return ODD

import os

import duckdb
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, hash string, ids string"

LONG = "ab" * 60_000  # one word
WORDS = " ".join(f"w{i % 977}" for i in range(40_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, blank and very long texts, repeated rows, and columns that clash with inner names."""
    texts = [
        (1, "One two three, four."), (2, None), (3, ""), (4, " \t\n "), (5, LONG), (6, WORDS), (7, "One two three, four."),
        (7, "One two three, four."), (8, "One  two\tthree, four."), (None, "no id"), (None, None), (9, "漢字 😀 é́ <|endoftext|> x"),
    ]
    rows = [(i, t, None if i == 1 else "en", "s", None if t is None else len(t), "r", "h", "x") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def plain_docs(sf_dir):
    """{doc_id: text} of the test table."""
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf_dir}/documents.parquet'").fetchall())


@pytest.fixture(scope="session")
def query(spark, sf_dir):
    """The rows of a registered query, run once."""
    from holdfast.llm import registry

    known = {}

    def rows(name):
        if name not in known:
            known[name] = registry.QUERIES[name](spark, sf_dir).collect()
        return known[name]

    return rows


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def library(tokenizer):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer)

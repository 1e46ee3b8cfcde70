import pytest

import public_tokenizers


@pytest.fixture(autouse=True)
def batches(spark):
    """Tiny Arrow batches, so that every test crosses batch boundaries."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.fixture(scope="session")
def bytes_file():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def words_file():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def pieces_file():
    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture
def docs(frame):
    """Documents from texts, with an extra column named like a result."""

    def make(*texts, ids=None):
        rows = [(i, t, True, "x") for i, t in zip(ids or range(len(texts)), texts)]
        return frame("doc_id long, text string, kept boolean, key string", *rows)

    return make

import hashlib

import pytest


@pytest.fixture
def documents(spark):
    """Rows to a documents frame, with an extra column."""

    def make(rows):
        full = [(i, t, lang, src, None if t is None else len(t), "x") for i, t, lang, src in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score string")

    return make


@pytest.fixture
def prose():
    """Deterministic words: prose(seed, n)."""

    def make(seed, n):
        return " ".join(hashlib.md5(f"{seed}-{i}".encode()).hexdigest()[:6] for i in range(n))

    return make

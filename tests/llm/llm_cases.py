"""Fixtures of the tests in this folder; each test module imports those it needs."""

import os

import pytest
from pyspark.sql import functions as F

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """``documents`` rows from texts, or (doc_id, text) pairs."""

    def make(*rows):
        full = [(r if isinstance(r, tuple) else (i, r)) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", f"s{k % 2}", len(t or "")) for k, (i, t) in enumerate(full)], DOCUMENTS)

    return make


ODD_TEXTS = (None, "", "   \n\t ", "one", "a b c d", "a b c d", "é ß 漢字 😀 \x1c x", "x " * 30_000, "###!!", "0123456789" * 2000)


@pytest.fixture
def odd_documents(documents):
    """Nulls, empty and very long texts, repeated rows and ids, an id that is null, columns with clashing names."""
    df = documents(*ODD_TEXTS, (3, "one"), (3, "other"), (None, "no id at all here"), (None, None))
    clashing = ("row", "token", "node", "label", "n", "block", "_copy", "_place", "print", "tag", "score", "spans", "length", "kept")
    clashing += ("_id", "_sha", "_kept", "_copies", "_n", "_tag", "_terms", "_parts", "_source", "_u", "lang_pred", "key", "bucket", "range", "word", "vector")
    return df.withColumns({c: F.lit("x") for c in clashing})


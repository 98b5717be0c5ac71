"""Documents for the tests of the text operators; every test module imports the fixtures it uses."""

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="session")
def make(spark):
    """Documents with columns whose names clash with those the operators use inside."""

    def docs(rows):
        full = [(i, t, lang, src, len(t) if t is not None else None) for i, t, lang, src in rows]
        return spark.createDataFrame(full, DOCS).withColumns(
            {c: F.lit("clash") for c in ("row", "size", "kept", "score", "h1", "whole", "digest", "bands", "label", "class")}
        )

    return docs


@pytest.fixture(scope="session")
def odd(make):
    """Nulls in every column, empty and blank texts, repeated rows, ties and a very long text."""
    long = " ".join(f"wort{i % 977} und" for i in range(30_000))
    return make(
        [
            (1, None, None, None),
            (2, "", "en", "a"),
            (3, " \t\n\x0b\x0c\r ", "en", "a"),
            (4, "one two three four five six seven", "en", "b"),
            (4, "one two three four five six seven", "en", "b"),
            (5, "one  two three four five six\nseven", "en", None),
            (6, "one two three four five six seven", None, "b"),
            (None, "one two three four five six seven", "en", "b"),
            (None, None, None, None),
            (7, "ab", "de", "c"),
            (8, long, "de", "c"),
            (9, long + " ende", "de", "c"),
            (10, "\x00 \U0001f600 é́ 中文", "zh", "c"),
            (11, "123 456 ...", "en", "c"),
        ]
    )


@pytest.fixture(scope="session")
def none(make):
    return make([])

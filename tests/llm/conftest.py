import os
from pathlib import Path

import pytest

# Python workers of the session must find the package from any working folder.
ROOT = str(Path(__file__).resolve().parents[2])
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture
def documents(spark):
    """Builds documents with two columns that the operators themselves make, to clash."""

    def build(rows):
        return spark.createDataFrame(
            [(*r, 7, "x") for r in rows],
            "doc_id long, text string, lang string, source string, n_chars long, score long, kept string",
        )

    return build


@pytest.fixture
def odd_documents(documents):
    """Nulls in every column, no text, blanks only, a very long text, ties and repeated rows."""
    prose = "you wrote a very calm and careful note about the weather of this week "
    return documents(
        [
            (1, prose * 9, "en", "a", 10),
            (1, prose * 9, "en", "a", 10),
            (2, prose * 9, "en", "a", 10),
            (3, None, "en", "a", 0),
            (4, "", "en", "b", 0),
            (5, " \n\t ", None, "b", 4),
            (None, prose * 9, "de", None, None),
            (6, "word", None, None, None),
            (7, "ab1 " * 60_000, "en", "a", 240_000),
            (8, "token = \"0123456789abcdef0123456789abcdef\" ünïcödé ▁ 日本 " + prose, "fr", "c", 9),
        ]
    )


@pytest.fixture
def labels(spark):
    def build(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return build

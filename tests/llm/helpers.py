"""Tables for the tests of the text operators, with the awkward rows every operator must take."""

from __future__ import annotations

import re
import string

FOLDER = "/root/testdata/sf0.01"
_LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_SPACED = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls, empty and blank texts, repeated rows, a row without id, one very long text.
ODD = [
    (901, None, None, None, None),
    (902, "", "en", "s", 0),
    (903, " \n\t ", "en", "s", 4),
    (904, "One two", "en", "s", 7),
    (904, "One two", "en", "s", 7),
    (None, "One two three four five six seven", "en", "s", 33),
    (905, "%%% *** 123", None, "s", 11),
    (906, "word " * 40_000, "en", "s", 200_000),
]


def spaced(text: str | None) -> list[str]:
    return _SPACED.findall((text or "").translate(_LOW))


def documents(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df):
    """Columns named like the outputs and helpers of the operators."""
    names = "ids n_tokens ids_sha256 decoded_sha256 lang_pred score rep keys n id h pos component_id labels n_words host verdict __spans label"
    return df.selectExpr("*", *[f"'x' AS `{n}`" for n in names.split()])

import re
import time

import pyarrow as pa
import pytest

from millrace.llm import licences
from millrace.llm.queries import QUERIES
from tests.llm.helpers import _LOW, FOLDER, ODD, documents, with_clashes

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    w, hits = WORDS.findall((text or "").translate(_LOW)), []
    for phrase, label in licences.BASE.items():
        k = phrase.split()
        hits += [(i, label) for i in range(len(w) - len(k) + 1) if w[i : i + len(k)] == k]
    starts = [h[0] for h in hits]
    return len(w), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({h[1] for h in hits}))


def test_query_on_all_documents(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op3_license_scan"](spark, FOLDER).collect()}
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        own = rows[r["doc_id"]]
        assert tuple(own[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == brute(r["text"])
        assert set(own["base_labels"].split(",")) <= set(own["labels"].split(",")) | {""}
        assert 0 <= own["score"] <= 1 and (own["score"] > 0) >= (own["n_base"] > 0)


@pytest.mark.parametrize("text", ["MIT License MIT-license,mit\nlicense", "cc by cc by-sa CC\tBY é mit licensé", "xmit license mit licensex", "gnu general public license" * 3, "Apache License\x00Apache License"])
def test_places_overlap_and_end_at_whole_words(text):
    assert licences.scanned(pa.array([text]))[0][:5] == brute(text)


@pytest.mark.parametrize(
    "text,names,free",
    [
        ("MIT", {"mit"}, True),
        ("MIT OR GPL-2.0-only", {"mit", "gpl-2.0-only"}, True),
        ("MIT AND GPL-2.0-only", {"mit", "gpl-2.0-only"}, False),
        ("MIT OR Apache-2.0 AND GPL-3.0", {"mit", "apache-2.0", "gpl-3.0"}, True),
        ("(MIT OR Apache-2.0) AND GPL-3.0 */", {"mit", "apache-2.0", "gpl-3.0"}, False),
        ("GPL-2.0 WITH Classpath-exception-2.0 or BSD-3-Clause", {"gpl-2.0", "bsd-3-clause"}, True),
        ("MIT OR", {"mit"}, True),
        ("MIT ) AND ISC", {"mit"}, True),
    ],
)
def test_expressions(text, names, free):
    assert licences.evaluated(licences.postfix(" " + text)) == (names, free)


@pytest.mark.parametrize("text", ["", " ", "OR MIT", "(MIT", ")", "AND"])
def test_no_expression(text):
    assert licences.postfix(text) == []


def test_tags_are_read_to_the_end_of_their_line():
    text = "// SPDX-License-Identifier: MIT OR\n GPL-2.0\n# spdx-license-identifier: (ISC)\nSPDX license identifier\nSPDX-License-Identifier:"
    row = licences.scanned(pa.array([text]))[0]
    assert row[5:] == ("isc,mit", 1 - 0.5**4, 2, True)


def test_many_tags_in_one_text_take_time_in_proportion():
    def seconds(n, between):
        start = time.process_time()
        row = licences.scanned(pa.array([f"SPDX-License-Identifier: MIT OR ISC{between}" * n]))[0]
        assert row[7] == n and row[5] == "isc,mit"
        return time.process_time() - start

    for between in ("\n", " ; "):
        seconds(1000, between)
        assert seconds(80_000, between) < 30 * max(seconds(8_000, between), 0.05)


def test_odd_rows_clashing_names_and_empty_tables(spark):
    docs = with_clashes(documents(spark, ODD))
    rows = licences.scan(docs).collect()
    assert len(rows) == len(ODD)
    assert all((r["labels"], r["score"], r["first_word"]) == ("", 0, None) for r in rows)
    assert licences.scan(docs.limit(0)).count() == 0

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe
from millrace.llm.queries import BYTE_BPE, WORD_BPE
from tests.llm.helpers import FOLDER, ODD, documents, with_clashes

LETTERS = "aAbBéÉéΣσςİıßſKÅ ’' \t\n\x1c\x85 ​0123²Ⅷ½٣_-–…<>|!?#中文字😀👩‍👩‍👧ñ lldvres"


def odd_texts():
    pick = random.Random(10)
    texts = ["".join(pick.choice(LETTERS) for _ in range(pick.randint(0, 40))) for _ in range(800)]
    return [*texts, "aaaa aaa aaaaa", "I'm WE'RE 'LL", "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "a\0b", "x" * 3000, "", "ΑΣ ΑΣ"]


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_ids_and_texts_are_the_library_s(path):
    library, texts = Tokenizer.from_file(path), odd_texts()
    library.no_truncation()
    library.no_padding()
    flat, at = bpe.Bpe(path).encode(texts)
    for i, r in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        own = flat[at[i] : at[i + 1]]
        assert own.tolist() == r.ids, texts[i]
        assert bpe.loaded(path).decode(own) == library.decode(r.ids, skip_special_tokens=False)


def test_memory_of_words_can_run_over(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    one, two = bpe.Bpe(WORD_BPE), bpe.loaded(WORD_BPE)
    for text in odd_texts()[:200]:
        assert one.encode([text])[0].tolist() == two.encode([text])[0].tolist()


def test_query_on_all_documents(spark):
    from millrace.llm.queries import QUERIES

    library = Tokenizer.from_file(WORD_BPE)
    library.no_truncation()
    library.no_padding()
    found = {r["doc_id"]: r for r in QUERIES["op10_bpe_round_trip"](spark, FOLDER).collect()}
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        own = found[r["doc_id"]]
        assert own["n_tokens"] == len(ids)
        assert own["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows_clashing_names_and_empty_tables(spark):
    docs = with_clashes(documents(spark, ODD))
    found = bpe.digests(docs, WORD_BPE).collect()
    assert len(found) == len(ODD)
    assert {r["n_tokens"] for r in found if r["doc_id"] in (901, 902, 903)} == {0}
    assert len({r["ids_sha256"] for r in found if r["doc_id"] == 904}) == 1
    back = bpe.decode(bpe.encode(docs, BYTE_BPE), BYTE_BPE)
    assert all(r["decoded"] == (r["text"] or "") for r in back.collect())
    assert bpe.digests(docs.limit(0), WORD_BPE).count() == 0


def test_stretches_met_before_are_not_cut_into_words_again():
    one = bpe.Bpe(BYTE_BPE)
    ids, at = one.encode(["a café's 12  men,\n and ½ a cat", "a ½"])
    one.given = one.quick = None
    again, ends = one.encode(["a ½", "a café's 12  men,\n and ½ a cat", "a and ½ café's"])
    assert again[: ends[2]].tolist() == [*ids[at[1] :], *ids[: at[1]]]
    assert one.decode(again[ends[2] :]) == "a and ½ café's"


def test_pairs_are_found_by_hashing():
    keys = np.unique(np.random.default_rng(9).integers(0, 1 << 32, 20_000))
    asked = np.concatenate([keys, keys + 1])
    want = np.where(np.isin(asked, keys), np.searchsorted(keys, asked), -1)
    assert bpe.Pairs(keys).find(asked).tolist() == want.tolist()
    assert bpe.Pairs(keys[:0]).find(keys).max() == -1

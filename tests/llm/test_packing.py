import random

import numpy as np
from tokenizers import Tokenizer

from millrace.llm import packing
from millrace.llm.queries import BYTE_BPE, QUERIES
from tests.llm.helpers import FOLDER, ODD, documents, with_clashes


def test_best_fit_by_trying_every_row():
    pick = random.Random(9)
    for _ in range(60):
        length = pick.choice([1, 7, 16, 100])
        sizes = np.array([pick.randint(1, length) for _ in range(pick.randint(0, 60))], np.int64)
        room: list[int] = []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            fits = [r for r in room if r >= sizes[i]]
            if fits:
                room.remove(min(fits))
                room.append(min(fits) - sizes[i])
            else:
                room.append(length - sizes[i])
        rows = packing.best_fit(sizes, length)
        assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
        assert sorted(length - sum(sizes[i] for i in r) for r in rows) == sorted(room)


def unpacked(rows, length):
    out = {}
    for r in rows:
        ids, at = np.frombuffer(r["input_ids"], "<u4"), np.frombuffer(r["positions"], "<u4")
        cu = r["cu_seqlens"]
        assert len(ids) == len(at) == length and cu[0] == 0 and cu[-1] == r["n_tokens"] <= length
        assert not ids[cu[-1] :].any() and not at[cu[-1] :].any()
        for doc, start, lo, hi in zip(r["doc_ids"], r["starts"], cu[:-1], cu[1:], strict=True):
            assert at[lo:hi].tolist() == list(range(hi - lo))
            out.setdefault(doc, []).append((start, ids[lo:hi].tolist()))
    return {d: sorted(p) for d, p in out.items()}


def test_every_token_of_all_documents_is_there_once(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = packing.pack(docs, BYTE_BPE, length=512).collect()
    found = unpacked(rows, 512)
    for r in docs.select("doc_id", "text").collect():
        parts = found.get(r["doc_id"], [])
        assert [x for _, p in parts for x in p] == library.encode(r["text"] or "", add_special_tokens=False).ids
        assert [s for s, _ in parts] == [512 * k for k in range(len(parts))]
    assert sum(r["n_tokens"] for r in rows) > 0.97 * 512 * len(rows)
    assert QUERIES["op9_packed_tokens"](spark, FOLDER).count() > 0


def test_blocks_odd_rows_clashing_names_and_empty_tables(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 10)
    docs = with_clashes(documents(spark, ODD))
    packed = packing.pack(docs, BYTE_BPE, length=64, pad=0)
    found = unpacked(packed.collect(), 64)
    assert set(found) == {903, 904, None, 905, 906}
    assert len(found[904]) == 2 and sum(len(p) for _, p in found[906]) == len(Tokenizer.from_file(BYTE_BPE).encode("word " * 40_000).ids)
    packing.write(packed, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == packed.count()
    assert packing.pack(docs.limit(0), BYTE_BPE).count() == 0

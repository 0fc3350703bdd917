import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import manifest
from millrace.llm.queries import QUERIES
from tests.llm.helpers import FOLDER, ODD, documents, with_clashes

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])


def tree(nodes):
    """The root, and for each node the others of its run, level by level."""
    paths, groups, now = [[] for _ in nodes], [[i] for i in range(len(nodes))], list(nodes)
    while len(now) > 1:
        above, above_groups = [], []
        for lo in range(0, len(now), 3):
            run = now[lo : lo + 3]
            for k in range(len(run)):
                for i in groups[lo + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(digest(*run))
            above_groups.append(sum(groups[lo : lo + 3], []))
        now, groups = above, above_groups
    return now[0], paths


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    if not by:
        return []
    parts = []
    for s in sorted(by, key=lambda s: (s is not None, (s or "").encode())):
        own = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])), i) for i, r in enumerate(by[s]))
        own = [(x[2], by[s][i]) for x, i in own]
        parts.append((own, *tree([leaf for leaf, _ in own])))
    root, tops = tree([p[1] for p in parts])
    out = []
    for (own, subroot, paths), top in zip(parts, tops, strict=True):
        for (leaf, r), path in zip(own, paths, strict=True):
            h = leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                h = leaf_of(r, r["text"].replace("\n", ""))
            for a, b in path + top:
                h = digest(a, h, b)
            out.append((r["doc_id"], leaf, subroot, root, digest(*[a + b for a, b in path + top]), h, h == root))
    return sorted(out, key=str)


def proofs_of(docs, levels=manifest.LEVELS):
    bare = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    return manifest.proofs(docs, tampered=bare, when=F.crc32(F.col("doc_id").cast("string")) % 2 == 0, levels=levels)


def rows_of(df):
    return sorted([tuple(r[c] for c in COLUMNS) for r in df.collect()], key=str)


def test_query_equals_trees_built_in_one_place(spark):
    want = brute([r.asDict() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()])
    assert rows_of(QUERIES["op13_merkle_manifest"](spark, FOLDER)) == want
    assert 0 < sum(r[-1] for r in want) < len(want)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_repeats_nulls_far_ids_and_blocks_of_all_sizes(spark, levels):
    rows = [
        *[(904, f"t\n{k % 4}", "en", "s", 7) for k in range(9)], (-70_000, "q\n", "en", "s", 2), (1 << 40, "r\n", "en", "s", 2), (5, "q\n", "en", "Ä", 2),
        (None, "z", None, None, None), (None, "z", None, None, None), (None, None, None, "s", None), *[(k, f"{k}\n", "de", "many", k) for k in range(40)], (7, "", "", "", 0),
    ]
    docs = documents(spark, [*ODD, *rows])
    assert rows_of(proofs_of(docs, levels)) == brute([r.asDict() for r in docs.collect()])


def test_one_row_empty_table_and_clashing_names(spark):
    one = documents(spark, [(4, "a\nb", "en", "s", 3)])
    assert rows_of(proofs_of(one)) == brute([r.asDict() for r in one.collect()])
    assert proofs_of(one.limit(0)).count() == 0
    docs = documents(spark, ODD)
    assert rows_of(proofs_of(with_clashes(docs).withColumns({c: F.lit("x") for c in ("grp", "hi", "low", "pos", "tree", "row", "leaf", "root", "hash")}))) == rows_of(proofs_of(docs))


def test_changed_rows_fail_and_no_others(spark):
    docs = documents(spark, [(k, f"line {k}\nmore", "en", f"s{k % 3}", k) for k in range(30)])
    found = manifest.proofs(docs, tampered={"n_chars": F.col("n_chars") + 1}, when=F.col("doc_id") < 3).collect()
    assert {r["doc_id"] for r in found if not r["verified"]} == {0, 1, 2}
    assert all(r["verified"] for r in manifest.proofs(docs).collect())

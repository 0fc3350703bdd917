"""One query for each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import bpe, chains, jaccard, langid, licences, manifest, multiindex, packing, preference, resample, templates, toxicity, urlfilter

TOKENIZER_FOLDER = "/opt/tokenizers"
WORD_BPE = f"{TOKENIZER_FOLDER}/word_bpe_49k.json"
BYTE_BPE = f"{TOKENIZER_FOLDER}/byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op10_bpe_round_trip")
def op10(spark, folder):
    """Token count and digests of the ids and of the decoded text, for every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.digests(docs, WORD_BPE).drop("text")


@query("op2_jaccard_join")
def op2(spark, folder):
    """Near-duplicate components of all documents: five words, similarity 0.8."""
    return jaccard.near_duplicates(table(spark, folder, "documents"))


@query("op4_language_id")
def op4(spark, folder):
    """The predicted language of every document; the third with held_out was not learned from."""
    docs = table(spark, folder, "documents")
    model = langid.train(docs)
    found = langid.identify(docs.select("doc_id", "text", langid.held_out().alias("held_out")), model)
    return found.drop("text")


@query("op5_shared_passages")
def op5(spark, folder):
    """Every passage of at least 50 words that a document shares with an earlier one."""
    return chains.shared_passages(table(spark, folder, "documents"))


@query("op6_decontamination")
def op6(spark, folder):
    """Every document that holds a benchmark item, also with other numbers, names or units."""
    return templates.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op3_license_scan")
def op3(spark, folder):
    """Licence phrases, tags and labels of every document."""
    return licences.scan(table(spark, folder, "documents").select("doc_id", "text")).drop("text")


@query("op7_url_filter")
def op7(spark, folder):
    """Rule and verdict of every page's URL."""
    return urlfilter.judge(table(spark, folder, "pages").select("page_id", "url")).drop("url")


@query("op8_embedding_near_dedup")
def op8(spark, folder):
    """Near-duplicate vectors of one label: cosine of 0.98 or more."""
    return multiindex.near_duplicates(table(spark, folder, "embeddings"))


@query("op1_preference_format", preference.SQL)
def op1(spark, folder):
    """All conversations as preference pairs of neighbours, one row for each rendered turn."""
    return preference.format_pairs(*preference.neighbours(table(spark, folder, "conversations")))


@query("op9_packed_tokens")
def op9(spark, folder):
    """The packed rows of all documents: pieces, cumulative lengths, and digests of the id and position rows."""
    rows = packing.pack(table(spark, folder, "documents"), BYTE_BPE)
    return rows.select("doc_ids", "starts", "cu_seqlens", "n_tokens", F.sha2("input_ids", 256).alias("ids_sha256"), F.sha2("positions", 256).alias("positions_sha256"))


@query("op11_toxicity")
def op11(spark, folder):
    """The toxicity of every document; the quarter with held_out was not learned from."""
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    scored = toxicity.judge(docs.select("doc_id", "text", "lang", toxicity.held_out().alias("held_out")), model)
    scored = toxicity.flagged(scored, model, flag="flagged_by_language")
    return scored.withColumn("predicted", (F.col("score") >= toxicity.CUT).cast("int")).drop("text", "lang")


@query("op12_importance_resampling")
def op12(spark, folder):
    """Weight, score and rank of every document in a draw of a tenth that resembles the benchmark."""
    return resample.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("n_words")


@query("op13_merkle_manifest")
def op13(spark, folder):
    """Leaf, roots and proof of every document; half of the documents are folded from texts without line ends."""
    bare = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    return manifest.proofs(table(spark, folder, "documents"), tampered=bare, when=F.crc32(F.col("doc_id").cast("string")) % 2 == 0)

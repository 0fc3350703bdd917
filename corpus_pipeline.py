"""The cleaning of a corpus for training, stage by stage.

Each stage takes all documents that its predecessor kept, written as Parquet, and all but the last return the columns of
``documents``. Rows without doc_id take no part in comparisons and stay. Empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import bpe, chains, jaccard, langid, ranks, templates
from millrace.llm.queries import WORD_BPE
from millrace.llm.sieve import sieve
from millrace.llm.textops import unused
from millrace.sources.scratch import Scratch


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a known language; a missing lang is filled in with the predicted one.

    Texts without a letter, null texts and texts unlike those of every language (less familiar than the limit learned for
    the best one) go. Where no document has a lang to learn from, nothing is judged but that a text has a letter.
    """
    model = langid.train(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found, score, known = (unused(docs.columns, n) for n in ("found", "score", "known"))
    judged = langid.identify(docs, model, lang_pred=found, score=score, known=known)
    return judged.where(known).withColumn("lang", F.coalesce("lang", found)).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The first document of every group of near duplicates.

    A row stays or goes by its own text: rows that share an id but not a text are documents of their own, and of rows that
    agree in both one stays. Rows without an id and rows without words stay.
    """
    scratch = Scratch(spark, "groups")
    key, row = unused(docs.columns, "key"), unused(docs.columns, "row")
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        keyed = docs.withColumn(key, F.col("doc_id"))
    else:
        # ids do not tell rows apart: their places in the order of the ids do
        order = [F.col("doc_id").asc_nulls_last(), F.sha2("text", 256), F.col(row)]
        keyed = ranks.placed(docs.withColumn(row, F.monotonically_increasing_id()), order, key, scratch).drop(row)
        keyed = scratch.write(keyed.withColumn(key, F.when(F.col("doc_id").isNotNull(), F.col(key))), "keyed")
    groups = jaccard.near_duplicates(keyed, id_col=key)
    # written, so that its size is known when the join with the texts is planned
    gone = scratch.write(groups.where(F.col(key) != F.col("component_id")).select(key).distinct(), "gone")
    may = sieve(gone, key)(key)
    return keyed.where(~may).unionByName(keyed.where(may).join(gone, key, "left_anti")).select(docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the passages that an earlier one has; those of which nothing is left go.

    Rows of one id are one document here: they lose what an earlier id has, and nothing to each other. Null and empty texts, and
    texts too short for a passage, stay as they are, as do rows without an id.
    """
    passages = chains.shared_passages(docs)
    changed = unused(docs.columns, "changed")
    kept = chains.cut_passages(docs, passages, changed=changed).where(~F.col(changed) | (F.col("text") != ""))
    return kept.withColumn("n_chars", F.when(F.col(changed), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Rows of one id go together. Null and empty texts hold nothing and stay, as do rows without an id. Without benchmark items
    all documents stay.
    """
    found = templates.contaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    gone = Scratch(spark, "leaks").write(found.select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every document that is left, with the digests of the ids and of the decoded text.

    Null and empty texts have no ids. Every row has its own result, also if it repeats another.
    """
    return bpe.digests(docs.select("doc_id", "text"), WORD_BPE, keep_ids=True).drop("text")


STAGES = [
    ("language_id", language),
    ("jaccard_join", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("bpe", tokenise),
]

#: The stages are models, chains and vocabularies that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        before = list(Scratch.opened)
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        # the stage is stored: what it and its predecessors wrote is not read again
        for used in [s for s in Scratch.opened if s not in before]:
            used.release()
        scratch.keep_only(name)
    return docs

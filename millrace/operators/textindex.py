"""An index of three-character pieces over the texts of a catalogue, for many searches in one job.

Equal texts are kept once. A posting says that a text holds a piece; texts are padded at the end, so that shorter search texts are
beginnings of pieces. A search takes the texts that hold the rarest pieces of what is sought, and looks only into those.
Postings lie sorted by piece, so that a reader that seeks few pieces reads few row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.sources.scratch import Scratch

SIZE = 3
PAD = "\x00"
#: Rarest pieces of a search text whose postings are met with each other, and pieces that are sought by name in the files.
RAREST = 2
NAMED = 500


def _pieces(text: Column) -> Column:
    """The different pieces of a text of SIZE characters or more, in one pass over its characters (a substring would count
    them from the beginning each time): each match looks SIZE characters ahead and takes one."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)(?=(" + "." * SIZE + "))."), F.lit(1)))


def build(cells: DataFrame, folder: str) -> None:
    """Store an index of ``cells(text, ...)``: distinct texts, as they are and in lower case, their postings, and the cells without their texts.

    Null and empty texts hold nothing and are left out.
    """
    spark = cells.sparkSession
    cells = cells.where("text <> ''")
    # a text is made lower and measured once, not for every search that looks into it
    texts = cells.select("text").distinct().select("text", F.lower("text").alias("low"), F.length("text").alias("length"), F.monotonically_increasing_id().alias("text_id"))
    texts.write.mode("overwrite").parquet(f"{folder}/texts")
    texts = spark.read.parquet(f"{folder}/texts")
    padded = F.concat("low", F.lit(PAD * (SIZE - 1)))
    # written as they come first: finding the ranges would cut every text into pieces once more
    scratch = Scratch(spark, "pieces")
    postings = scratch.write(texts.select(F.explode(_pieces(padded)).alias("piece"), "text_id"), "cut")
    postings.repartitionByRange("piece").sortWithinPartitions("piece", "text_id").write.mode("overwrite").parquet(f"{folder}/postings")
    scratch.release()
    counts = spark.read.parquet(f"{folder}/postings").groupBy("piece").agg(F.count("*").alias("texts"))
    counts.write.mode("overwrite").parquet(f"{folder}/pieces")
    cells.join(texts.select("text", "text_id"), "text").drop("text").write.mode("overwrite").parquet(f"{folder}/cells")


def search(spark: SparkSession, folder: str, queries: DataFrame) -> DataFrame:
    """(query_id, query, text, length, at, cell columns) of every cell that holds a text of ``queries(query_id, query)``, in any case.

    ``at`` is where it first does, ``length`` that of the text. Null and empty search texts find nothing.
    """
    texts, postings, pieces, cells = (spark.read.parquet(f"{folder}/{n}") for n in ("texts", "postings", "pieces", "cells"))
    sought = queries.where("query <> ''").select(F.lower("query").alias("sought")).distinct()
    long = sought.where(F.length("sought") >= SIZE).select("sought", F.explode(_pieces(F.col("sought"))).alias("piece"))
    rare = long.join(pieces, "piece", "left").groupBy("sought").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "piece"))), 1, RAREST).alias("rarest"))
    wanted = rare.select("sought", F.size("rarest").alias("needed"), F.explode("rarest.piece").alias("piece"))
    for n in range(1, SIZE):  # every piece that begins with the whole search text will do
        own = sought.where(F.length("sought") == n)
        starts = pieces.select("piece", F.substring("piece", 1, n).alias("start"))
        wanted = wanted.unionByName(own.join(starts, own["sought"] == starts["start"]).select("sought", F.lit(1).alias("needed"), "piece"))
    named = [r[0] for r in wanted.select("piece").distinct().limit(NAMED + 1).collect()]
    if len(named) <= NAMED:
        postings = postings.where(F.col("piece").isin(named))
    met = postings.join(wanted, "piece").groupBy("sought", "needed", "text_id").agg(F.count_distinct("piece").alias("held"))
    found = met.where((F.col("held") >= F.col("needed"))).join(texts, "text_id")
    # as the one element of an array: a plain column would be made again where it is read
    place = F.explode(F.array(F.expr("instr(low, sought)")))
    found = found.select("sought", "text_id", "text", "length", place.alias("at")).where("at > 0")
    asked = queries.where("query <> ''").withColumn("sought", F.lower("query"))
    return found.join(asked, "sought").join(cells, "text_id").drop("sought", "text_id")

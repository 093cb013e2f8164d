"""A corpus pipeline of four stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next one's docs. The first three return the
columns of ``documents``, so each one's decisions reach the next.

1. toxicity: documents that the weakly supervised model rejects go.
2. near_duplicates: of every group of near duplicates the document with the
   least doc_id stays.
3. mixing: documents are repeated as often as the mix takes them (those it
   doesn't take go).
4. packing: every remaining row is packed into sequences of 4096 ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddsline.llm import mixing, ngram_join, packing, toxicity
from oddsline.llm.common import written
from oddsline.llm.queries import TOKENIZER
from oddsline.session import share_modules


def _whole(docs: DataFrame, *more) -> DataFrame:
    """The documents as one struct column, so that no added column clashes with theirs."""
    return docs.select(F.struct(*docs.columns).alias("doc"), *more)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_modules(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(docs, toxicity.fit(docs, labels), whole=True).where("score < 0.5").select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document named by its component stays, a repeated doc_id once; rows
    without a doc_id stay.

    The rows that go are joined, not those that stay: they are far fewer.
    Repeated doc_ids, if there are any, take a second pass. The merge hint
    keeps one plan at every size: the ids that go grow with the data, so they
    are never broadcast."""
    share_modules(spark)
    found = ngram_join.near_duplicates(docs).where("doc_id is not null")
    ids = written(found.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("root"),
                                              F.count("*").alias("rows")), "ids")
    gone, twice = ids.where("not root").select("doc_id"), ids.where("root and rows > 1").select("doc_id")
    rows = _whole(docs, F.col("doc_id").cast("long").alias("doc_id")).join(gone.hint("merge"), "doc_id", "left_anti")
    if not twice.isEmpty():
        once = rows.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        rows = rows.join(twice, "doc_id", "left_anti").union(once)
    return rows.select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_modules(spark)
    decided = mixing.plan(written(mixing.sized(docs), "sized"))
    rows = mixing.mixed(mixing.sized(docs, F.struct(*docs.columns).alias("doc")), decided)
    return rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))) \
        .select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_modules(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The classifier and the tokenizer have no SQL form; tests/llm checks the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

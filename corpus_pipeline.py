"""A corpus pipeline in five stages: toxicity, near duplicates, benchmark decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; between stages the documents are a Parquet
table in the shared folder. Stages 1 to 4 return the columns of the documents, the last one adds the tokens. Operators see
doc_id and text only; all other columns travel in one struct, so their names cannot clash with what operators add. Null and
empty texts are neither toxic, copies nor contaminated, and pass all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.llm.common import table, written
from tamarack.llm.containment import mark_leaks
from tamarack.llm.jaccard import near_duplicates
from tamarack.llm.ledger import masked, scan_documents
from tamarack.llm.pieces import encode_documents
from tamarack.llm.toxicity import labelled, train_toxicity

#: Score from which a document is rejected as toxic.
TOXIC = 0.3

#: Rows up to which a list of ids is broadcast to the texts; beyond it the texts are shuffled to them.
BROADCAST_IDS = 2_000_000

REST = "_rest"


def _narrow(docs: DataFrame) -> DataFrame:
    """doc_id, text and everything else in one struct."""
    return docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(0).alias("_none")]).alias(REST))


def _wide(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return kept.select(*[F.col(c) if c in ("doc_id", "text") else F.col(REST).getField(c).alias(c) for c in docs.columns])


def _ids(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold; the model learns from the labelled documents that are no hold-out."""
    model = train_toxicity(labelled(docs, table(spark, sf_dir, "labels")))
    return _wide(model.score(_narrow(docs)).where(F.col("score") < TOXIC), docs)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of every near-duplicate group, once; documents without doc_id stay."""
    groups = written(near_duplicates(docs), "groups").where("doc_id IS NOT NULL")
    copies = written(groups.where("component_id <> doc_id").select("doc_id").distinct(), "copies")
    repeated = groups.groupBy("doc_id").count().where("count > 1").select("doc_id").join(copies, "doc_id", "left_anti")
    repeated = written(repeated, "repeated")
    single = docs.join(_ids(copies.unionByName(repeated)), "doc_id", "left_anti")
    once = docs.join(_ids(repeated), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return single.select(*docs.columns).unionByName(once.select(*docs.columns))


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _wide(mark_leaks(_narrow(docs), table(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0), docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and n_chars counted anew where the text changed."""
    found = scan_documents(_narrow(docs)).withColumn("text", masked())
    if "n_chars" in docs.columns:
        count = F.when(F.size("found") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        found = found.withColumn(REST, F.col(REST).withField("n_chars", F.coalesce(count, F.col(REST).getField("n_chars"))))
    return _wide(found, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids."""
    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", reject_toxic),
    ("n-gram Jaccard join", keep_one_copy),
    ("benchmark decontamination", remove_benchmarks),
    ("secret scans", mask_secrets),
    ("SentencePiece encoding", encode),
]

#: Near-duplicate components, learnt weights and piece encoding are beyond SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the last stage's rows are returned without being written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)

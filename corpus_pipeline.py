"""From raw documents to token files: quality rules, near duplicates, decontamination, mixture, tokens.

Each stage is written and read again as the next one's input. A stage's scratch tables are its own and go
when the next stage begins. Documents are told apart by their id and a hash of id and text where a verdict joins
them back; rows that are equal in both get the same verdict, and of equal texts one row stays. The token files hold
the mixture in a global shuffle, not by id.

Defined cases: a null or empty text fails the quality rules; a null id is an id like others, a null source the source "".
Rows that repeat are near copies of each other, so one of them stays. Very long texts are read whole, ties between copies
go to the least id. Other columns, whatever their names, are kept up to the last stage. No documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import decontamination, mixing, near_duplicates, quality, token_files
from barloom.llm.common import prepared, table
from barloom.llm.queries import tokenizer_path
from barloom.session import Workspace

NODE = "_node"
_scratch: dict[str, Workspace] = {}


def _workspace(spark: SparkSession, label: str) -> Workspace:
    """The stage's workspace; that of the stage before, whose result has been written, is closed."""
    app = spark.sparkContext.applicationId
    if app in _scratch:
        _scratch.pop(app).close()
    _scratch[app] = Workspace(prepared(spark), label)
    return _scratch[app]


def _with_node(docs: DataFrame) -> DataFrame:
    return docs.withColumn(NODE, F.xxhash64("doc_id", "text"))


def _same(rows: DataFrame, found: DataFrame) -> Column:
    return (rows[NODE] == found["found_node"]) & rows["doc_id"].eqNullSafe(found["found_id"])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no quality rule and whose host is not rejected."""
    return quality.kept_documents(docs, _workspace(spark, "stage-quality"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    classes = near_duplicates.duplicate_classes(docs, _workspace(spark, "stage-copies"))
    kept = classes.where("kept").select(F.col("doc_id").alias("found_id"), F.col("node").alias("found_node"))
    rows = _with_node(docs)
    return rows.join(kept, _same(rows, kept), "left_semi").dropDuplicates(["doc_id", NODE]).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    rows = _with_node(docs)
    found = decontamination.contamination(rows, table(spark, sf_dir, "benchmark"), _workspace(spark, "stage-contamination"), ("doc_id", NODE))
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias("found_id"), F.col(NODE).alias("found_node")).distinct()
    return rows.join(hit, _same(rows, hit), "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or thinned out to the target weights of their sources, in global hash order."""
    _workspace(spark, "stage-mixture")
    return mixing.mixed(docs).select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents in the mixture's shuffle, and what is read back from them."""
    path = _workspace(spark, "stage-tokens").path("tokens")
    token_files.write_tokens(docs, path, tokenizer_path(), order_by=mixing.hash_order)
    return token_files.read_documents(token_files.read_segments(spark, path))


STAGES = [
    ("quality rules", keep_good),
    ("near duplicates", drop_copies),
    ("decontamination", drop_contaminated),
    ("mixture", mix_sources),
    ("token files", write_tokens),
]
#: SQL can't express the hashing of near duplicates or the tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    results = Workspace(prepared(spark), "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = results.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

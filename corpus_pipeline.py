"""A training corpus from ``documents``: five stages, each on what the one before kept.

Stages return the columns of ``documents`` (in their order, with all extra
columns), mix its place column behind them, the last one the packed pieces. Rows with a NULL id are never
dropped by the duplicate stages; of rows that repeat an id each is decided by
its own text; NULL texts pass as empty; an empty table
gives empty results. The session's Arrow batches are lowered to ``TEXTS`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import small, small_batches, staged
from quarry.llm.exact_dup import exact_duplicates
from quarry.llm.mixing import mix_sources
from quarry.llm.near_dup import near_duplicates
from quarry.llm.packing import pack
from quarry.llm.sharding import row_numbers
from quarry.llm.tokens import tokenizer_path
from quarry.llm.toxicity import score_documents, train

ALPHA = 0.5  # a source's target weight is its bytes to this power
PLACE = "mix_position"  # column of a document's place in the mixed corpus
ROW = "_row"  # id of a row while duplicates are decided
TEXTS = 1024  # rows of an Arrow batch: whole texts, held by the JVM and by the worker
SMALL_IDS = 1_000_000  # longer lists of ids join by a shuffle


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` and an id of each row: doc_id, or for all but one row of an id that
    repeats a number above all ids. So duplicates are decided row by row."""
    if ROW in docs.columns:
        raise ValueError(f"documents have a column {ROW} already")
    own = F.col("doc_id").cast("long")
    again = staged(docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
                   .filter("_n > 1").select(F.col("doc_id").alias("_again")), "repeated")
    if again.isEmpty():
        return docs.withColumn(ROW, own)
    again, twice = small(again, SMALL_IDS), F.col("doc_id") == F.col("_again")
    top = docs.agg(F.max(own)).first()[0]
    rows = row_numbers(docs.join(again, twice, "left_semi"), "doc_id", "text")
    first = rows.groupBy(F.col("doc_id").alias("_id")).agg(F.min("row_number").alias("_first"))
    rows = rows.join(first, F.col("doc_id") == F.col("_id")).withColumn(
        ROW, F.when(F.col("row_number") == F.col("_first"), own).otherwise(F.lit(top + 1) + F.col("row_number")))
    return staged(docs.join(again, twice, "left_anti").withColumn(ROW, own)
                  .unionByName(rows.select(*docs.columns, ROW)), "rows-apart")


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    ids = staged(dropped.select(F.col(ROW).alias("_gone")).filter("_gone IS NOT NULL").distinct(), "dropped")
    return docs.join(small(ids, SMALL_IDS), F.col(ROW) == F.col("_gone"), "left_anti").drop(ROW)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents scored toxic (0.5 or more) by a model of the labelled rows."""
    small_batches(spark, TEXTS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels)
    return score_documents(docs, model, out="_toxicity").filter(F.col("_toxicity") < 0.5).drop("_toxicity")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal without white space one document stays. Rows that repeat an
    id are documents each: of equal rows one stays, another text of the id stays too."""
    rows = _apart(docs)
    return _without(rows, exact_duplicates(rows, id_col=ROW).filter(~F.col("kept")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) one document stays.
    Rows that repeat an id are documents each."""
    rows = _apart(docs)
    found = near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "text"), size=5, percent=80)
    return _without(rows, found.filter(~F.col("kept")).select(F.col("doc_id").alias(ROW)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixed corpus, written in that order.
    Rows that repeat an id share its first place."""
    if PLACE in docs.columns:
        raise ValueError(f"documents have a column {PLACE} already")
    place = staged(mix_sources(docs, alpha=ALPHA).groupBy(F.col("doc_id").alias("_id"))
                   .agg(F.min("position").alias(PLACE)), "places")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (docs.join(small(place, SMALL_IDS), F.col("doc_id").eqNullSafe(F.col("_id")))
            .repartitionByRange(parts, PLACE).sortWithinPartitions(PLACE).select(*docs.columns, PLACE))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4,096 tokens, filled in the order of the mixed corpus: the slots
    of the mix decide which sources a sequence holds. Documents that were not
    mixed are packed in the corpus's own proportions."""
    small_batches(spark, TEXTS)
    return pack(docs, tokenizer_path("word_bpe_49k.json"), False, end_id=2,
                order=PLACE if PLACE in docs.columns else None)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix),
          ("packing", packing)]

#: a trained score, similarity classes and tokens are not SQL; tests/llm has the plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

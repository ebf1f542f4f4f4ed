"""The registered queries of this subpackage: each applies one operator with
production parameters to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.exact_dup import EXACT_ORACLE, exact_duplicates
from quarry.llm.lexical_search import SEARCH_ORACLE, search
from quarry.llm.mixing import mix_sources
from quarry.llm.near_dup import near_duplicates
from quarry.llm.packing import pack
from quarry.llm.secret_scan import SECRETS_ORACLE, find_secrets
from quarry.llm.sharding import shard_documents
from quarry.llm.suffix_dedup import cut_report
from quarry.llm.token_file import read_token_file, write_token_file
from quarry.llm.tokens import tokenizer_path
from quarry.llm.topk_search import TOPK_ORACLE, top_k
from quarry.llm.toxicity import held_out, score_documents, train
from quarry.llm.url_rules import PAGE_ORACLE, judge_pages
from quarry.llm.vector_codes import CODES_ORACLE, compress
from quarry.session import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_near_dedup")
def op1(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


@query("op2_exact_dedup", EXACT_ORACLE)
def op2(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query("op3_toxicity")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op4_token_file")
def op4(spark, sf_dir):
    path = scratch(spark, "llm-tokens")
    write_token_file(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"), True, end_id=0)
    return read_token_file(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op5_suffix_dedup")
def op5(spark, sf_dir):
    return cut_report(table(spark, sf_dir, "documents"), window=50)


@query("op6_packing")
def op6(spark, sf_dir):
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), False, end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query("op7_url_rules", PAGE_ORACLE)
def op7(spark, sf_dir):
    return judge_pages(table(spark, sf_dir, "pages"))


@query("op8_topk_search", TOPK_ORACLE)
def op8(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), every=100, k=10)


@query("op9_mix_sources")
def op9(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"))


@query("op10_sharding")
def op10(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"))


@query("op11_vector_codes", CODES_ORACLE)
def op11(spark, sf_dir):
    return compress(table(spark, sf_dir, "embeddings"))


@query("op13_secret_scan", SECRETS_ORACLE)
def op13(spark, sf_dir):
    return find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query("op12_lexical_search", SEARCH_ORACLE)
def op12(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""Token ids of a corpus in a compressed file of independent blocks.

The file is a folder with two Parquet tables, written and committed by Spark
so it works in any store and survives lost executors:

- ``codebook``: (symbol, length) of a canonical Huffman code, from the counts
  of all ids; the codes follow from the lengths;
- ``blocks``: whole documents in ascending id order, about ``BLOCK_IDS`` ids
  each: part, start (ids before it in the part), the documents' ids and
  lengths, the bit offset of every ``CHECKPOINT``-th id, and the bits.

A block decodes alone, and inside it each run between checkpoints does. All steps
keep the words a worker has learnt for the next corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import before, by_range, require_columns, small, staged, task_of
from quarry.llm.huffman import Coder, code_lengths
from quarry.llm.tokens import encoder

BLOCK_IDS, CHECKPOINT, DECODE_BLOCKS = 1 << 15, 256, 32

BLOCKS = ("part int, start long, doc_ids array<long>, sizes array<int>, n_ids int, "
          "checkpoints binary, payload binary")
_ARROW = pa.schema([("part", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("sizes", pa.list_(pa.int32())), ("n_ids", pa.int32()), ("checkpoints", pa.binary()),
                    ("payload", pa.binary())])


def _tokenise(path: str, byte_level: bool, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, byte_level)
        end, wide = enc._pack([end_id]), enc.kind.itemsize
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = 0
            for ids in enc.encode_batch(batch.column("text"), end):
                sizes = pc.binary_length(ids).to_numpy().astype(np.int64) // wide
                starts = start + np.cumsum(sizes) - sizes
                start += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, dtype=np.int32)), batch.column("doc_id").slice(at, len(ids)),
                     pa.array(starts), pa.array(sizes.astype(np.int32)), ids],
                    names=["part", "doc_id", "start", "n", "ids"])
                at += len(ids)
    return run


def _histogram(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                joined = b"".join(batch.column("ids").slice(k, 512).to_pylist())
                c = np.bincount(np.frombuffer(joined, dtype=kind))
                if len(c) > len(total):
                    total = np.concatenate([total, np.zeros(len(c) - len(total), dtype=np.int64)])
                total[:len(c)] += c
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])],
                                         names=["symbol", "n"])
    return run


def _encode_blocks(lengths: bytes, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(np.frombuffer(lengths, dtype=np.uint8))
        held: list[tuple] = []
        size, at = 0, (None, None)

        def block():
            ids = np.frombuffer(b"".join([h[3] for h in held]), dtype=kind)
            bits, marks = coder.encode(ids, CHECKPOINT)
            return {"part": at[0], "start": held[0][1], "doc_ids": [h[0] for h in held],
                    "sizes": [h[2] for h in held], "n_ids": len(ids), "checkpoints": marks.tobytes(), "payload": bits}

        for batch in batches:
            out = []
            cols = [batch.column(c).to_pylist() for c in ("part", "doc_id", "start", "n", "ids")]
            for part, doc, start, n, ids in zip(*cols):
                if held and ((part, start) != at or size + n > BLOCK_IDS):
                    out.append(block())
                    held, size = [], 0
                held.append((doc, start, n, ids))
                size, at = size + n, (part, start + n)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
        if held:
            yield pa.RecordBatch.from_pylist([block()], schema=_ARROW)
    return run


def write_token_file(docs: DataFrame, path: str, tokenizer: str, byte_level: bool = True, end_id: int = 0) -> None:
    """Encode every whole text (NULL as empty), end each document with
    ``end_id`` and write the file. Needs doc_id and text; extra columns are
    ignored, NULL ids come first, repeated ids keep a document each."""
    require_columns(docs, "doc_id", "text")
    tokens = staged(
        by_range(docs.select("doc_id", "text"), "doc_id")
        .mapInArrow(task_of("tokens", _tokenise(tokenizer, byte_level, end_id)),
                    "part int, doc_id long, start long, n int, ids binary"),
        "ids")
    kind = encoder(tokenizer, byte_level).kind.str
    # one row per id of the vocabulary at most
    counts = (tokens.select("ids").mapInArrow(task_of("tokens", _histogram(kind)), "symbol int, n long")
              .groupBy("symbol").agg(F.sum("n").alias("n")).toArrow())
    total = np.zeros(max(counts["symbol"].to_pylist(), default=0) + 1, dtype=np.int64)
    total[counts["symbol"].to_numpy()] = counts["n"].to_numpy()
    lengths = code_lengths(total)
    spark = docs.sparkSession
    book = pa.table({"symbol": pa.array(np.arange(len(lengths)), pa.int32()),
                     "length": pa.array(lengths.astype(np.int32))})
    spark.createDataFrame(book).coalesce(1).write.mode("overwrite").parquet(f"{path}/codebook")
    (tokens.mapInArrow(task_of("tokens", _encode_blocks(lengths.tobytes(), kind)), BLOCKS)
     .write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/blocks"))


def _decode_blocks(lengths: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(np.frombuffer(lengths, dtype=np.uint8))
        for batch in batches:
            for k in range(0, batch.num_rows, DECODE_BLOCKS):
                some = batch.slice(k, DECODE_BLOCKS)
                col = {c: some.column(c).to_pylist() for c in _ARROW.names}
                marks = [np.frombuffer(c, dtype=np.uint32) for c in col["checkpoints"]]
                ids = coder.decode(col["payload"], col["n_ids"], marks, CHECKPOINT)
                out: dict[str, list] = {c: [] for c in ("part", "doc_id", "start", "n_tokens", "ids")}
                for part, start, docs, sizes, own in zip(col["part"], col["start"], col["doc_ids"], col["sizes"], ids):
                    raw, at = own.astype("<u4").tobytes(), 0
                    for doc, n in zip(docs, sizes):
                        for c, v in zip(out, (part, doc, start + at, n, raw[4 * at:4 * (at + n)])):
                            out[c].append(v)
                        at += n
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                    ("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()),
                    ("n_tokens", pa.int64()), ("ids", pa.binary())]))
    return run


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens,
    ids (little-endian unsigned 32-bit)."""
    book = spark.read.parquet(f"{path}/codebook").orderBy("symbol").toArrow()
    lengths = book["length"].to_numpy().astype(np.uint8).tobytes()
    blocks = spark.read.parquet(f"{path}/blocks")
    base = before(blocks.groupBy("part").agg(F.sum("n_ids").alias("_n")), "part", "_n", "_base")
    docs = blocks.mapInArrow(task_of("tokens", _decode_blocks(lengths)),
                             "part int, doc_id long, start long, n_tokens long, ids binary")
    return (docs.join(small(base.select("part", "_base")), "part")
            .select("doc_id", (F.col("start") + F.col("_base")).alias("start"), "n_tokens", "ids"))

"""Mix sources to target weights by Pfair scheduling of blocks.

A source with weight w releases its block i at time i / w and must run it by
(i + 1) / w (rounded outwards); earliest deadline first among released blocks
then keeps every source within one block of its target at all times. The whole
schedule is computed, to weights exact to 2**-40. Blocks are its unit: their
size doubles until the corpus has about ``MAX_BLOCKS`` (128 MB each at 100 TB),
so the bound holds at every size and what the driver holds does not grow.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import before, bounded_rows, by_range, require_columns, small, staged, task_of
from quarry.llm.sharding import row_numbers

CYCLE = 4096  # the most sources; more raise an error
EXACT = 1 << 40  # parts of the weights
MAX_BLOCKS = 1 << 20  # of a schedule; blocks grow until it fits
BLOCK_BYTES = 1 << 16  # the smallest blocks


def whole_shares(weights: list[float], cycle: int = CYCLE) -> list[int]:
    """Weights as integers of sum ``cycle``, at least 1 each (largest remainders)."""
    if not weights or len(weights) > cycle or min(weights) <= 0:
        raise ValueError(f"needs 1 to {cycle} positive weights")
    total = sum(weights)
    ideal = [w / total * cycle for w in weights]
    share = [max(1, int(x)) for x in ideal]
    while sum(share) != cycle:
        step = 1 if sum(share) < cycle else -1
        can = [k for k in range(len(share)) if step > 0 or share[k] > 1]
        best = max(can, key=lambda k: (step * (ideal[k] - share[k]), -k))
        share[best] += step
    return share


def schedule(shares: list[int], blocks: list[int] | None = None) -> list[tuple[int, int, int, int, int]]:
    """``blocks`` of each source (one cycle if not given) as (source, block, release,
    deadline, slot), earliest deadline first. A slot stays empty when no block is released."""
    cycle, blocks = sum(shares), shares if blocks is None else blocks
    release = lambda s, i: i * cycle // shares[s]
    deadline = lambda s, i: -(-(i + 1) * cycle // shares[s])
    waiting = [(0, s, 0) for s in range(len(shares)) if blocks[s]]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    out, slot = [], 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline(s, i), s, i))
        due, s, i = heapq.heappop(ready)
        out.append((s, i, release(s, i), due, slot))
        if i + 1 < blocks[s]:
            heapq.heappush(waiting, (release(s, i + 1), s, i + 1))
        slot += 1
    return out


def slot_plan(weights: list[float], sizes: list[int], block_bytes: int = BLOCK_BYTES):
    """Whole shares, the bytes of a block (doubled until all sources of ``sizes`` bytes
    fill at most ``MAX_BLOCKS`` and one each), and the schedule of their blocks."""
    while sum(sizes) // block_bytes > MAX_BLOCKS:
        block_bytes *= 2
    shares = whole_shares(weights, EXACT)
    return shares, block_bytes, schedule(shares, [-(-n // block_bytes) for n in sizes])


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, so_far = TaskContext.get().partitionId(), {}
    for batch in batches:
        starts = []
        for s, n in zip(batch.column("source").to_pylist(), batch.column("size").to_pylist()):
            starts.append(so_far.get(s, 0))
            so_far[s] = starts[-1] + n
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(starts), part, dtype=np.int32)), batch.column("doc_id"), batch.column("source"),
             batch.column("size"), pa.array(starts, pa.int64())], names=["part", "doc_id", "source", "size", "start"])


def mix_sources(docs: DataFrame, weights: dict | None = None, alpha: float = 0.5,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, source, size, weight, block, release, deadline,
    slot, block_bytes, position (0-based place of the document in the mixed corpus).

    A source's documents in id order fill blocks (a document belongs to the
    block its first byte falls into; size is the UTF-8 length plus 1). Blocks
    have ``block_bytes``, doubled while they are more than ``MAX_BLOCKS``; the
    column says what they came to. Without ``weights`` a source weighs its bytes to the power
    ``alpha``. No row is dropped: when a source runs dry its slots stay empty
    and the others go on in their proportion. NULL source is a source of its
    own, NULL text has size 1, NULL ids come first, repeated rows are placed
    each. Extra columns are ignored; an empty table gives no rows; a source
    without a positive weight raises ValueError.
    """
    require_columns(docs, "doc_id", "text", "source")
    spark = docs.sparkSession
    slim = docs.select("doc_id", "source", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long")
                       .alias("size"))
    rows = staged(by_range(slim, "doc_id").mapInArrow(
        task_of("mix", _running), "part int, doc_id long, source string, size long, start long"), "mix")
    totals = {r["source"]: r["n"] for r in bounded_rows(
        rows.groupBy("source").agg(F.sum("size").alias("n")), CYCLE, "the list of sources")}
    names = sorted(totals, key=lambda s: (s is not None, s))
    if weights is not None and any(weights.get(s, 0) <= 0 for s in names):
        raise ValueError("every source needs a positive weight")
    shares, block_bytes, plan = slot_plan([weights[s] if weights else totals[s] ** alpha for s in names],
                                          [totals[s] for s in names], block_bytes) if names else ([], block_bytes, [])
    columns = list(zip(*plan)) or [()] * 5
    # a row a block, at most MAX_BLOCKS and one a source
    slots = small(spark.createDataFrame(pa.table(
        [pa.array([names[s] for s in columns[0]], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
        names=["_s", "_i", "_r", "_d", "_t"])))
    base = before(rows.groupBy("part", "source").agg(F.sum("size").alias("_n")), "part", "_n", "_base", "source")
    b = small(base.select(F.col("part").alias("_p"), F.col("source").alias("_bs"), "_base"))
    share = F.broadcast(spark.createDataFrame(list(zip(names, shares)), "_ss string, _w long"))
    block = (rows.join(b, (F.col("part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_bs")))
             .join(share, F.col("source").eqNullSafe(F.col("_ss")))
             .withColumn("block", F.floor((F.col("start") + F.col("_base")) / F.lit(block_bytes)).cast("long")))
    placed = (block.join(slots, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_i")))
              .select("doc_id", "source", "size", (F.col("_w") / F.lit(float(sum(shares) or 1))).alias("weight"),
                      "block", F.col("_r").alias("release"), F.col("_d").alias("deadline"), F.col("_t").alias("slot"),
                      F.lit(block_bytes).cast("long").alias("block_bytes")))
    return row_numbers(placed, "slot", "doc_id").withColumnRenamed("row_number", "position")

"""Exact duplicates of normalised texts with a heavy-hitter split.

Misra-Gries summaries of the digests, one per part and merged by sums, name
a bounded list of candidates. Their true counts and winners come from an
exact aggregate; that list (at most ``counters`` rows) is broadcast and
settles the copies of frequent texts map-side. Only the remaining digests,
each held by a small share of all rows, go through a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ASCII_SPACE, require_columns, staged, task_of

COUNTERS = 1024


def misra_gries(counters: int, column: str):
    """A part's summary: at most ``counters`` (value, count) rows. A value with
    more than 1 / (counters + 1) of the part's rows is always among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for v in batch.column(column).to_pylist():
                if v in held:
                    held[v] += 1
                elif len(held) < counters:
                    held[v] = 1
                else:
                    held = {k: c - 1 for k, c in held.items() if c > 1}
        yield pa.RecordBatch.from_pydict({column: list(held), "n": list(held.values())},
                                         schema=pa.schema([(column, pa.binary()), ("n", pa.int64())]))
    return run


def frequent(df: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` values, all with over 2 / (counters + 1) of the rows
    among them: summed summaries are short by at most 1 / (counters + 1)."""
    parts = df.select(column).mapInArrow(task_of("exact_dup", misra_gries(counters, column)), f"{column} binary, n long")
    return parts.groupBy(column).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), column).limit(counters).select(column)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     counters: int = COUNTERS) -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical without ASCII white space; NULL counts as
    empty. The longest original text (code points), then the smallest id
    stays; a NULL id loses to any other. Rows that repeat an id count each in
    group_size and share its decision. Extra columns are ignored; an empty
    table gives no rows.
    """
    require_columns(docs, id_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.length(text).alias("_len"),
        F.unhex(F.sha2(F.translate(text, ASCII_SPACE, "").cast("binary"), 256)).alias("digest"))
    rows = staged(base, "digests")
    hot = staged(frequent(rows, "digest", counters), "hot")

    def winners(df: DataFrame) -> DataFrame:
        # longest first, then smallest id with NULL last
        rank = F.struct(F.col("_len"), F.col("doc_id").isNotNull(), -F.col("doc_id"))
        return df.groupBy("digest").agg(F.max_by("doc_id", rank).alias("keep_id"),
                                        F.count(F.lit(1)).alias("group_size"))

    # at most ``counters`` rows of 32 bytes: safe to broadcast at any input size
    small = F.broadcast(hot)
    won = F.broadcast(staged(winners(rows.join(small, "digest", "left_semi")), "winners"))
    settled = rows.join(won, "digest")
    rest = rows.join(small, "digest", "left_anti")
    shuffled = rest.join(winners(rest), "digest")
    return settled.unionByName(shuffled).select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
        .alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")).withColumnRenamed("doc_id", id_col)


EXACT_ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS h
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY len DESC, doc_id)
"""

"""Change capture and MERGE on plain parquet.

MERGE INTO does not run on parquet tables, so a merge is a rewrite of the rows
it may touch: one full outer join of target and changes, one outcome per row.
``quarry.streaming.buckets`` limits it to the hash buckets that hold a changed
key. Keys match null-safe: a NULL key is a key.

Duplicate source keys: ``upsert`` raises (the warehouse errors);
``apply_changes`` keeps the change with the highest ``_seq``, and a
DELETE followed by an INSERT of the same key inside one batch is an
UPDATE (streams expose updates as such pairs). ``apply_ordered`` holds that
order across batches as well: every row carries the ``_seq`` of its last change,
deleted keys stay as tombstones, and what arrives late changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION, SEQ, ROW_ID, BEFORE, DELETED = "_action", "_seq", "_row_id", "_before", "_deleted"


class DuplicateKeyError(ValueError):
    pass


def row_id(key: Column) -> Column:
    """METADATA$ROW_ID: a stable id derived from the key."""
    return F.md5(key.cast("string"))


def _facing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join on the null-safe key: (key, _l, _r), both structs of the other columns."""
    side = lambda df, k, out: df.select(F.col(key).alias(k), F.struct(
        *[c for c in df.columns if c != key]).alias(out))
    j = side(left, "_lk", "_l").join(side(right, "_rk", "_r"), F.col("_lk").eqNullSafe(F.col("_rk")), "full_outer")
    return j.select(F.when(F.col("_l").isNotNull(), F.col("_lk")).otherwise(F.col("_rk")).alias(key), "_l", "_r")


def changes(old: DataFrame, new: DataFrame, key: str, with_before: bool = False) -> DataFrame:
    """Snapshot diff as a change stream (M01/M03): INSERT/UPDATE rows carry
    the new values, DELETE rows the old ones. Unchanged rows are dropped
    with a null-safe comparison of the whole row. ``with_before`` adds the old
    row as struct ``_before`` (NULL for an INSERT)."""
    cols = [c for c in new.columns if c != key]
    j = _facing(old.select(key, *cols), new, key)
    action = (F.when(F.col("_l").isNull(), "INSERT")
              .when(F.col("_r").isNull(), "DELETE")
              .when(~F.col("_l").eqNullSafe(F.col("_r")), "UPDATE"))
    out = j.withColumn(ACTION, action).filter(F.col(ACTION).isNotNull())
    payload = F.when(F.col("_r").isNull(), F.col("_l")).otherwise(F.col("_r"))
    return out.select(key, *[payload[c].alias(c) for c in cols], ACTION, row_id(F.col(key)).alias(ROW_ID),
                      *([F.col("_l").alias(BEFORE)] if with_before else []))


def latest_change(changes_df: DataFrame, key: str) -> DataFrame:
    """One change per key: the highest ``_seq`` wins; DELETE then INSERT of
    a key collapses to UPDATE. A partial aggregate (``max`` of a struct
    led by ``_seq``), so a hot key is reduced inside each task first."""
    cols = [c for c in changes_df.columns if c not in (key, ACTION, SEQ, ROW_ID)]
    agg = changes_df.groupBy(key).agg(
        F.max(F.struct(F.col(SEQ), F.col(ACTION), *[F.col(c) for c in cols])).alias("_last"),
        F.max((F.col(ACTION) == "DELETE").cast("int")).alias("_had_delete"))
    action = (F.when((F.col("_last." + ACTION) == "INSERT") & (F.col("_had_delete") == 1), "UPDATE")
              .otherwise(F.col("_last." + ACTION)))
    return agg.select(key, *[F.col(f"_last.{c}").alias(c) for c in cols], action.alias(ACTION),
                      F.col("_last." + SEQ).alias(SEQ))


@dataclass
class MergeResult:
    table: DataFrame
    counts: DataFrame   # one row: inserted, updated, deleted


def apply_changes(target: DataFrame, changes_df: DataFrame, key: str,
                  guard_deletes: bool = False) -> MergeResult:
    """The CDC MERGE of the banking procedures (M05):

        WHEN MATCHED AND action = 'DELETE' THEN DELETE
        WHEN MATCHED AND action = 'UPDATE' THEN UPDATE SET ...
        WHEN NOT MATCHED THEN INSERT ...

    A matched INSERT changes nothing. The NOT MATCHED branch has no guard,
    so a DELETE of an unknown key inserts it, as written; pass
    ``guard_deletes=True`` to drop those instead.
    """
    cols = [c for c in target.columns if c != key]
    if SEQ not in changes_df.columns:
        # no order to choose by: a key may change once only
        once = changes_df.groupBy(key).agg(*[
            F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"a key changes twice and there is no {SEQ}")))
            .otherwise(F.max(c)).alias(c) for c in (*cols, ACTION)])
        changes_df = once.withColumn(SEQ, F.lit(0))
    src = latest_change(changes_df.select(key, *cols, ACTION, SEQ), key)
    j = _facing(target, src, key).withColumn(ACTION, F.col("_r")[ACTION])
    matched = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    outcome = (F.when(matched & (F.col(ACTION) == "DELETE"), "deleted")
               .when(matched & (F.col(ACTION) == "UPDATE"), "updated")
               .when(matched, "unchanged")
               .when(F.col("_l").isNotNull(), "unchanged")
               .when(F.lit(guard_deletes) & (F.col(ACTION) == "DELETE"), "skipped")
               .otherwise("inserted"))
    j = j.withColumn("_outcome", outcome)
    changed = F.col("_outcome").isin("updated", "inserted")
    merged = (j.filter(~F.col("_outcome").isin("deleted", "skipped"))
              .select(key, *[F.when(changed, F.col("_r")[c]).otherwise(F.col("_l")[c]).alias(c) for c in cols]))
    counts = j.agg(*[F.count(F.when(F.col("_outcome") == o, 1)).alias(f"rows_{o}")
                     for o in ("inserted", "updated", "deleted")])
    return MergeResult(merged, counts)


def with_order(table: DataFrame) -> DataFrame:
    """A plain table as the state of ``apply_ordered``: no row has a change yet."""
    return table.withColumns({SEQ: F.lit(None).cast("long"), DELETED: F.lit(False)})


def live_rows(state: DataFrame) -> DataFrame:
    """The table that a state of ``apply_ordered`` stands for."""
    return state.filter(~F.col(DELETED)).drop(SEQ, DELETED)


def apply_ordered(state: DataFrame, changes_df: DataFrame, key: str, guard_deletes: bool = False) -> MergeResult:
    """``apply_changes`` across batches that arrive out of order.

    ``state`` is the target with ``_seq`` (the change a row last took, NULL for
    none) and ``_deleted``. A change whose ``_seq`` is not above that of its key
    is late and does nothing. DELETE leaves a tombstone, so a late UPDATE does
    not bring a row back, while a later INSERT does. A matched INSERT changes
    nothing, not even ``_seq``. A DELETE of a key never seen inserts it as in
    ``apply_changes``; with ``guard_deletes`` it leaves a tombstone.
    """
    cols = [c for c in state.columns if c not in (key, SEQ, DELETED)]
    last = changes_df.groupBy(key).agg(
        F.max(F.struct(F.col(SEQ), F.col(ACTION), *[F.col(c) for c in cols])).alias("_c"),
        F.max(F.when(F.col(ACTION) == "DELETE", F.col(SEQ))).alias("_gone"))
    j = _facing(state, last, key)
    new, was = F.col("_r")["_c"], F.col("_l")[SEQ]
    action = (F.when((new[ACTION] == "INSERT") & (F.col("_r")["_gone"] > F.coalesce(was, F.lit(-1 << 63))), "UPDATE")
              .otherwise(new[ACTION]))
    known, live = F.col("_l").isNotNull(), F.coalesce(~F.col("_l")[DELETED], F.lit(False))
    delete = action == "DELETE"
    outcome = (F.when(F.col("_r").isNull(), "unchanged")
               .when(known & F.coalesce(was >= new[SEQ], F.lit(False)), "late")
               .when(live & delete, "deleted")
               .when(live & (action == "UPDATE"), "updated")
               .when(live, "unchanged")
               .when(delete & (known | F.lit(guard_deletes)), "buried")
               .otherwise("inserted"))
    j = j.withColumn("_outcome", outcome)
    taken = F.col("_outcome").isin("deleted", "updated", "inserted", "buried")
    pick = lambda ours, theirs: F.when(taken, theirs).otherwise(ours)
    merged = j.select(key, *[pick(F.col("_l")[c], new[c]).alias(c) for c in cols],
                      pick(was, new[SEQ]).alias(SEQ),
                      pick(F.col("_l")[DELETED], F.col("_outcome").isin("deleted", "buried")).alias(DELETED))
    counts = j.agg(*[F.count(F.when(F.col("_outcome") == o, 1)).alias(f"rows_{o}")
                     for o in ("inserted", "updated", "deleted", "late")])
    return MergeResult(merged, counts)


def upsert(target: DataFrame, source: DataFrame, key: str, check_duplicates: bool = True) -> MergeResult:
    """MERGE: matched → update every column, not matched → insert."""
    if check_duplicates:
        dup = source.groupBy(key).count().filter(F.col("count") > 1).limit(1).count()
        if dup:
            raise DuplicateKeyError(f"duplicate keys in MERGE source on {key}")
    cols = [c for c in target.columns if c != key]
    j = _facing(target, source.select(key, *cols), key)
    outcome = F.when(F.col("_r").isNull(), "unchanged").when(F.col("_l").isNull(), "inserted") \
        .otherwise("updated")
    j = j.withColumn("_outcome", outcome)
    given = F.col("_r").isNotNull()
    merged = j.select(key, *[F.when(given, F.col("_r")[c]).otherwise(F.col("_l")[c]).alias(c) for c in cols])
    counts = j.agg(F.count(F.when(F.col("_outcome") == "inserted", 1)).alias("rows_inserted"),
                   F.count(F.when(F.col("_outcome") == "updated", 1)).alias("rows_updated"),
                   F.lit(0).cast("long").alias("rows_deleted"))
    return MergeResult(merged, counts)

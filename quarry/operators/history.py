"""State as of a time, and history retention, over an append-only change
log (M07, M08) — the stand-in for time travel on plain parquet.

A change log row is (key, ts, seq, action, payload...). The state at T is
the last change per key with ``ts <= T`` (AT) or ``ts < T`` (BEFORE),
dropped when that change is a DELETE. "Last" is ``max_by(row, struct(ts,
seq))``: a partial aggregate, so a key with a third of all changes is
reduced inside every task before the shuffle, never gathered in one. The
payload is never compared and may hold VARIANT or map columns.

``SnapshotLog`` stores the log in periods with the state at the start of
each: a state is read from the nearest base and the changes after it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _last_per_key(log: DataFrame, key: str, ts: str, seq: str, action: str) -> DataFrame:
    payload = [c for c in log.columns if c not in (key, ts, seq, action)]
    last = log.groupBy(key).agg(F.max_by(F.struct(ts, seq, action, *payload), F.struct(ts, seq)).alias("_l"))
    return last.select(key, *[F.col(f"_l.{c}").alias(c) for c in (ts, seq, action, *payload)])


def state_where(log: DataFrame, cond: Column, key: str = "key", ts: str = "ts", seq: str = "seq",
                action: str = "action") -> DataFrame:
    last = _last_per_key(log.filter(cond), key, ts, seq, action)
    return last.filter(F.col(action) != "DELETE").drop(action)


def state_at(log: DataFrame, at, **kw) -> DataFrame:
    """AT(TIMESTAMP => at): changes at exactly ``at`` are included."""
    ts = kw.get("ts", "ts")
    return state_where(log, F.col(ts) <= at, **kw)


def state_before(log: DataFrame, before, **kw) -> DataFrame:
    """BEFORE(TIMESTAMP => before): changes at exactly ``before`` excluded."""
    ts = kw.get("ts", "ts")
    return state_where(log, F.col(ts) < before, **kw)


def state_before_batch(log: DataFrame, batch_id: int, batch_col: str = "batch_id", **kw) -> DataFrame:
    """BEFORE(STATEMENT => id): the state before a given write batch."""
    return state_where(log, F.col(batch_col) < batch_id, **kw)


def prune_history(log: DataFrame, horizon, key: str = "key", ts: str = "ts", seq: str = "seq",
                  action: str = "action") -> DataFrame:
    """Retention (M08): changes at or before ``horizon`` collapse to one base
    row per live key (keys deleted by then vanish); later changes stay.
    ``state_at(pruned, t) == state_at(log, t)`` for every t >= horizon."""
    old = log.filter(F.col(ts) <= horizon)
    base = _last_per_key(old, key, ts, seq, action).filter(F.col(action) != "DELETE")
    recent = log.filter(F.col(ts) > horizon)
    return base.select(*log.columns).unionByName(recent)


class SnapshotLog:
    """A change log on disk: ``changes/period=<i>`` holds the changes after cut i-1
    up to and with cut i, ``bases/period=<i>`` the live row of every key at cut i-1
    (period 0 has none), ``index`` one row per period with the cut it starts after."""

    def __init__(self, spark: SparkSession, path: str, key: str = "key", ts: str = "ts", seq: str = "seq",
                 action: str = "action"):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.ts, self.seq, self.action = key, ts, seq, action

    def _last(self, log: DataFrame) -> DataFrame:
        return _last_per_key(log, self.key, self.ts, self.seq, self.action).select(*log.columns)

    def write(self, log: DataFrame, cuts: list[datetime]) -> None:
        """Deal the changes to periods in one pass, then build every base from the
        one before and one period's changes. The number of cuts is the caller's."""
        cuts = sorted(set(cuts))
        period = F.lit(0)
        for i, cut in enumerate(cuts, 1):
            period = F.when(F.col(self.ts) > F.lit(cut), F.lit(i)).otherwise(period)
        (log.withColumn("period", period).repartition("period", F.col(self.key)).write.mode("overwrite")
         .partitionBy("period").parquet(f"{self.path}/changes"))
        for i in range(1, len(cuts) + 1):
            known = self._changes(log.schema, i - 1, i - 1)
            if i > 1:
                known = known.unionByName(self._base(log.schema, i - 1))
            self._last(known).filter(F.col(self.action) != "DELETE").write.mode("overwrite").parquet(
                f"{self.path}/bases/period={i}")
        kind = log.schema[self.ts].dataType.simpleString()
        index = self.spark.createDataFrame([(0, None), *enumerate(cuts, 1)], f"period int, after {kind}")
        index.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/index")

    def _changes(self, schema, first: int, last: int) -> DataFrame:
        """Changes of some periods; files of other periods are never opened."""
        return (self.spark.read.schema(schema).parquet(f"{self.path}/changes")
                .filter(F.col("period").between(first, last)).drop("period"))

    def _base(self, schema, period: int) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/bases/period={period}")

    def period_of(self, at: datetime, inclusive: bool = True) -> tuple[int, int]:
        """The period whose base is nearest before ``at``, and the number of periods."""
        after = F.col("after") <= F.lit(at) if inclusive else F.col("after") < F.lit(at)
        row = self.spark.read.parquet(f"{self.path}/index").agg(
            F.coalesce(F.max(F.when(after, F.col("period"))), F.lit(0)).alias("period"), F.max("period").alias("last")).first()
        return row.period, row.last

    def state_at(self, at: datetime, inclusive: bool = True) -> DataFrame:
        """AT(at), or BEFORE(at) if not ``inclusive``: one base and the changes of its period."""
        period, _ = self.period_of(at, inclusive)
        schema = self.spark.read.parquet(f"{self.path}/changes").drop("period").schema
        upto = F.col(self.ts) <= F.lit(at) if inclusive else F.col(self.ts) < F.lit(at)
        known = self._changes(schema, period, period).filter(upto)
        if period:
            known = known.unionByName(self._base(schema, period))
        return self._last(known).filter(F.col(self.action) != "DELETE").drop(self.action)

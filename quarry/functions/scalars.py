"""Column-level scalar helpers.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen; no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def risk_level(amount: Column) -> Column:
    """``trans_func``: > 500 High, 100..200 Medium (inclusive), else Low.

    The holes — (200, 500], below 100 and NULL all give Low — are the
    definition and are kept.
    """
    return (F.when(amount > 500, "High")
            .when(amount.between(100, 200), "Medium")
            .otherwise("Low"))


def round_half_up(c, digits: int) -> Column:
    """Round on the binary double itself: floor(x * 10^d + 0.5) / 10^d.

    ``round`` goes through the shortest decimal string, so a value printed
    as ...5 rounds differently across engines; this form is bit-identical
    everywhere (the oracle SQL uses the same formula)."""
    if isinstance(c, str):
        c = F.col(c)
    scale = 10 ** digits
    return F.floor(c * scale + F.lit(0.5)) / scale


def default_zip(z: Column, default: str = "00000") -> Column:
    """IFF(z = '' OR z IS NULL, default, z)."""
    return F.when(z.isNull() | (z == ""), F.lit(default)).otherwise(z)


def wrap(c: Column, left: str = "%", right: str = "%") -> Column:
    """CONCAT('%', c, '%'); NULL in gives NULL out."""
    return F.concat(F.lit(left), c, F.lit(right))


def now_ntz() -> Column:
    """TO_TIMESTAMP_NTZ(CURRENT_TIMESTAMP)."""
    return F.localtimestamp()


def hours_before(ts: Column, n: int) -> Column:
    """DATEADD(hour, -n, ts)."""
    return F.timestamp_add("HOUR", F.lit(-n), ts)


SQL_FUNCTIONS = {
    # Scalar SQL functions; Catalyst inlines their bodies like any expression.
    "trans_func": "CREATE OR REPLACE TEMPORARY FUNCTION trans_func(amount DOUBLE) "
                  "RETURNS STRING RETURN CASE WHEN amount > 500 THEN 'High' "
                  "WHEN amount BETWEEN 100 AND 200 THEN 'Medium' ELSE 'Low' END",
}


def register_sql_functions(spark: SparkSession) -> None:
    for ddl in SQL_FUNCTIONS.values():
        spark.sql(ddl)

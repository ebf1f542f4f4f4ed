"""Files in place (W1) and load control: scans, views, unloads, COPY INTO.

Every query first unloads a view derived from the test tables to a fresh
stage folder under the shared root, then works on those files.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.operators import relational as rel
from quarry.plans.oracle_views import VIEWS, view, with_views
from quarry.plans.registry import query
from quarry.schemas import FILE_CUSTOMER_POSITIONS, SCHEMAS, KEYS
from quarry.session import scratch
from quarry.sources import load, scan, sinks
from quarry.sources.scan import CsvFormat

# CREATE FILE FORMAT MY_CSV_FORMAT TYPE=CSV COMPRESSION=AUTO
#   FIELD_OPTIONALLY_ENCLOSED_BY='"' SKIP_HEADER=1
MY_CSV_FORMAT = CsvFormat(compression="gzip", enclosure='"', skip_header=1)

_FIXTURE_ORDER = ["c_customer_sk", "c_customer_id", "c_current_cdemo_sk", "c_current_hdemo_sk",
                  "c_current_addr_sk", "c_first_shipto_date_sk", "c_first_sales_date_sk",
                  "c_salutation", "c_first_name", "c_last_name", "c_preferred_cust_flag",
                  "c_birth_day", "c_birth_month", "c_birth_year", "c_birth_country", "c_login",
                  "c_email_address", "c_last_review_date_sk"]
POSITIONAL_SQL = ", ".join(f"{_FIXTURE_ORDER[p - 1]} AS {n}" for p, n in sorted(FILE_CUSTOMER_POSITIONS.items()))
POSITIONAL_NAMES = [n for _, n in sorted(FILE_CUSTOMER_POSITIONS.items())]


def staged_customer_files(cat) -> str:
    """COPY INTO @stage/Customer_data/ FROM customer_test (gzip CSV)."""
    path = f"{scratch(cat.spark, 'stage')}/Customer_data"
    sinks.unload_csv(cat.file_customer, path, MY_CSV_FORMAT)
    return path


def customer_view(cat):
    """CREATE VIEW CUSTOMER_DATA AS SELECT $1 C_CUSTOMER_SK, ... FROM @stage."""
    df = scan.scan_csv_positional(cat.spark, staged_customer_files(cat), MY_CSV_FORMAT,
                                  FILE_CUSTOMER_POSITIONS)
    return sinks.view_over(df, "CUSTOMER_DATA")


@query("s01_positional_scan", with_views(f"SELECT {POSITIONAL_SQL} FROM file_customer", "file_customer"))
def s01_positional_scan(cat):
    return scan.scan_csv_positional(cat.spark, staged_customer_files(cat), MY_CSV_FORMAT,
                                    FILE_CUSTOMER_POSITIONS)


@query("s14_view_over_files", with_views(f"SELECT {POSITIONAL_SQL} FROM file_customer", "file_customer"))
def s14_view_over_files(cat):
    customer_view(cat)
    return cat.spark.sql("SELECT * FROM CUSTOMER_DATA")


@query("p02_project", with_views(
    "SELECT c_first_name AS first_name, c_email_address AS email FROM file_customer", "file_customer"))
def p02_project(cat):
    v = customer_view(cat)
    return v.select(F.col("C_FIRST_NAME").alias("first_name"), F.col("C_EMAIL_ADDRESS").alias("email"))


@query("p05_filter_alias", with_views(
    f"SELECT * FROM (SELECT {POSITIONAL_SQL} FROM file_customer) WHERE C_CUSTOMER_SK = '1000'", "file_customer"))
def p05_filter_alias(cat):
    return customer_view(cat).filter(F.col("C_CUSTOMER_SK") == "1000")


@query("ag01_group_two_keys", with_views(
    "SELECT c_first_name AS C_FIRST_NAME, c_last_name AS C_LAST_NAME, count(*) AS cnt "
    "FROM file_customer GROUP BY 1, 2", "file_customer"))
def ag01_group_two_keys(cat):
    return customer_view(cat).groupBy("C_FIRST_NAME", "C_LAST_NAME").agg(F.count(F.lit(1)).alias("cnt"))


@query("j03_left_keep_left", with_views(
    f"SELECT b.* FROM (SELECT {POSITIONAL_SQL} FROM file_customer) b "
    f"LEFT JOIN (SELECT {POSITIONAL_SQL} FROM file_customer) a ON a.C_CUSTOMER_SK = b.C_CUSTOMER_SK",
    "file_customer"))
def j03_left_keep_left(cat):
    """Native table B ⟕ file view A, B's columns only. A contributes only its
    key column to the scan; B's rows repeat once per matching A row."""
    a = customer_view(cat)
    b = sinks.ctas(a, f"{scratch(cat.spark, 'native')}/customer_native_table")
    return b.alias("b").join(a.alias("a"), F.col("a.C_CUSTOMER_SK") == F.col("b.C_CUSTOMER_SK"), "left") \
        .select("b.*")


@query("o04_limit_sample", with_views(
    f"SELECT {POSITIONAL_SQL} FROM file_customer LIMIT 10000", "file_customer"))
def o04_limit_sample(cat):
    """CREATE TABLE ... AS SELECT * FROM customer_test LIMIT 10000: a sample,
    not a report — any 10,000 rows satisfy it (the limit is the feature)."""
    return sinks.ctas(customer_view(cat).limit(10000), f"{scratch(cat.spark, 'native')}/sample")


@query("s10_unload_csv", with_views("SELECT * FROM b_transactions", "b_transactions", ts=("transaction_date",)))
def s10_unload_csv(cat):
    """Unload a table as gzip CSV with header, then scan it back typed."""
    path = sinks.unload_csv(cat.b_transactions, f"{scratch(cat.spark, 'unload')}/transactions")
    return scan.read_csv(cat.spark, path, sinks.GZIP_CSV, schema=SCHEMAS["transactions"])


@query("s11_unload_query", with_views("SELECT first_name, email FROM b_customers", "b_customers"))
def s11_unload_query(cat):
    """COPY INTO @stage/select_ FROM (SELECT first_name, email ...)."""
    stage = scratch(cat.spark, "unload")
    path = sinks.unload_csv(cat.b_customers.select("first_name", "email"), stage, prefix="select_")
    return scan.read_csv(cat.spark, path, sinks.GZIP_CSV, schema=StructType.fromDDL(
        "first_name string, email string"))


@query("s12_unload_parquet", with_views("SELECT * FROM b_transactions", "b_transactions", ts=("transaction_date",)))
def s12_unload_parquet(cat):
    path = sinks.unload_parquet(cat.b_transactions, f"{scratch(cat.spark, 'unload')}/parquet_")
    return cat.spark.read.parquet(path)


@query("s13_ctas", with_views(
    "SELECT *, CASE WHEN amount > 500 THEN 'High' WHEN amount BETWEEN 100 AND 200 THEN 'Medium' "
    "ELSE 'Low' END AS risk_level FROM b_transactions", "b_transactions", ts=("transaction_date",)))
def s13_ctas(cat):
    return sinks.ctas(rel.with_risk_level(cat.b_transactions), f"{scratch(cat.spark, 'native')}/transaction_model")


@query("s06_parquet_scan", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-06-01' AND l_returnflag = 'R'""")
def s06_parquet_scan(cat):
    return scan.scan_parquet(cat.spark, f"{cat.sf_dir}/lineitem.parquet",
                             ["l_orderkey", "l_linenumber", "l_quantity"],
                             (F.col("l_shipdate") >= F.lit("1998-06-01").cast("timestamp_ntz"))
                             & (F.col("l_returnflag") == "R"))


# -- formats ------------------------------------------------------------------
NULL_TOKENS_FORMAT = CsvFormat(compression="gzip", enclosure='"', skip_header=1, null_if=("NULL", "null"))


@query("s02_csv_format", with_views(
    "SELECT customer_id, CASE WHEN CAST(customer_id AS BIGINT) % 10 IN (0, 1) THEN NULL ELSE occupation END "
    "AS occupation, city FROM b_customers", "b_customers"))
def s02_csv_format(cat):
    """NULL_IF=('NULL','null'): both tokens read back as NULL."""
    k = F.col("customer_id").cast("long") % 10
    src = cat.b_customers.select(
        "customer_id",
        F.when(k == 0, "NULL").when(k == 1, "null").otherwise(F.col("occupation")).alias("occupation"),
        "city")
    path = sinks.unload_csv(src, f"{scratch(cat.spark, 'fmt')}/tokens", NULL_TOKENS_FORMAT)
    return scan.read_csv(cat.spark, path, NULL_TOKENS_FORMAT,
                         schema=StructType.fromDDL("customer_id string, occupation string, city string"))


DELIM_FORMATS = {
    "tab": CsvFormat(delimiter="\t", skip_header=1),
    "quoted": CsvFormat(enclosure='"', escape="\\", skip_header=1),
    "escaped": CsvFormat(escape_unenclosed="\\", skip_header=1),
}


@query("s03_delimiters", with_views(
    "SELECT v.variant, customer_id, address || ', ' || city AS full_address, "
    "'\"' || occupation || '\" dept' AS department FROM b_customers, "
    "(VALUES ('tab'), ('quoted'), ('escaped')) v(variant)", "b_customers"))
def s03_delimiters(cat):
    """A comma inside the data, handled three ways: another delimiter,
    quote enclosure, or an escape character before the comma."""
    src = cat.b_customers.select(
        "customer_id",
        F.concat_ws(", ", "address", "city").alias("full_address"),
        F.concat(F.lit('"'), F.col("occupation"), F.lit('" dept')).alias("department"))
    names = src.columns
    ddl = StructType.fromDDL("customer_id string, full_address string, department string")
    stage = scratch(cat.spark, "delim")
    out = None
    for variant, fmt in DELIM_FORMATS.items():
        path = f"{stage}/{variant}"
        if fmt.escape_unenclosed:
            scan.write_escaped(src, path, fmt)
            df = scan.scan_escaped(cat.spark, path, fmt, names)
        else:
            src.write.options(**fmt.writer_options(header=True)).csv(path)
            df = scan.read_csv(cat.spark, path, fmt, schema=ddl)
        df = df.select(F.lit(variant).alias("variant"), *names)
        out = df if out is None else out.unionByName(df)
    return out


# -- COPY INTO with error policies ---------------------------------------------
view("emp_source", ("b_customers",), """
SELECT first_name, last_name, email, address AS streetaddress, city,
       CASE WHEN CAST(customer_id AS BIGINT) % 6 = 1 AND CAST(customer_id AS BIGINT) % 13 = 0
            THEN NULL ELSE customer_since END AS start_date,
       'employee' || CAST(CAST(customer_id AS BIGINT) % 6 + 1 AS VARCHAR) AS emp_file,
       CAST(customer_id AS BIGINT) AS ckey,
       (CAST(customer_id AS BIGINT) % 6 = 1 AND CAST(customer_id AS BIGINT) % 13 = 0) AS bad
FROM b_customers""")
assert "emp_source" in VIEWS

EMP_FORMAT = CsvFormat(compression="gzip", enclosure='"', skip_header=1)


def staged_employee_files(cat) -> str:
    """Six gzip CSV files employee1..employee6; employee2 holds rows whose
    start_date does not parse."""
    k = F.col("customer_id").cast("long")
    bad = (k % 6 == 1) & (k % 13 == 0)
    src = cat.b_customers.select(
        "first_name", "last_name", "email", F.col("address").alias("streetaddress"), "city",
        F.when(bad, F.lit("not-a-date")).otherwise(F.col("customer_since").cast("string")).alias("start_date"),
        F.concat(F.lit("employee"), (k % 6 + 1).cast("string")).alias("emp_file"),
        k.alias("ckey"))
    path = f"{scratch(cat.spark, 'emp-stage')}/employees"
    (src.repartition("emp_file").sortWithinPartitions("emp_file", "ckey").drop("ckey")
     .write.partitionBy("emp_file").options(**EMP_FORMAT.writer_options(header=True)).csv(path))
    return path


def copy_employees(cat, on_error: str, pattern: str | None = None) -> load.LoadResult:
    src = staged_employee_files(cat)
    work = scratch(cat.spark, "copy")
    return load.copy_into(cat.spark, src, EMP_FORMAT, SCHEMAS["emp_basic"], f"{work}/emp_basic",
                          f"{work}/_stage", on_error=on_error, pattern=pattern)


EMP_COLS = "first_name, last_name, email, streetaddress, city, start_date"


@query("s09a_continue", with_views(f"SELECT {EMP_COLS} FROM emp_source WHERE NOT bad", "emp_source",
                                   dates=("start_date",)))
def s09a_continue(cat):
    return copy_employees(cat, "continue").loaded


@query("s09b_skip_file", with_views(
    f"SELECT {EMP_COLS} FROM emp_source WHERE emp_file NOT IN (SELECT emp_file FROM emp_source WHERE bad)",
    "emp_source", dates=("start_date",)))
def s09b_skip_file(cat):
    return copy_employees(cat, "skip_file").loaded


@query("s08_pattern", with_views(
    f"SELECT {EMP_COLS} FROM emp_source WHERE NOT bad AND emp_file IN "
    "('employee1', 'employee2', 'employee3', 'employee4', 'employee5')", "emp_source", dates=("start_date",)))
def s08_pattern(cat):
    """PATTERN='.*employee[1-5]...' selects five of the six staged files."""
    return copy_employees(cat, "continue", pattern=r".*employee[1-5]/[^/]*\.csv(\.gz)?$").loaded


@query("s18_load_history", with_views(
    """SELECT emp_file AS file, count(*) AS rows_parsed, count_if(bad) AS errors_seen,
              count(*) - count_if(bad) AS rows_loaded,
              CAST(min(CASE WHEN bad THEN rn END) AS DOUBLE) AS first_error_line,
              CASE WHEN count_if(bad) = 0 THEN 'LOADED' WHEN count(*) > count_if(bad) THEN 'PARTIALLY_LOADED'
                   ELSE 'LOAD_FAILED' END AS status
       FROM (SELECT *, row_number() OVER (PARTITION BY emp_file ORDER BY ckey) AS rn FROM emp_source)
       GROUP BY emp_file""", "emp_source"))
def s18_load_history(cat):
    """Per-file load audit of the loads since an hour ago (parsed, errors, loaded,
    first bad line, status): of two loads one lies outside the window."""
    src, work = staged_employee_files(cat), scratch(cat.spark, "copy")
    now = datetime.now()
    for k, at in enumerate((now - timedelta(hours=5), now)):
        load.copy_into(cat.spark, src, EMP_FORMAT, SCHEMAS["emp_basic"], f"{work}/emp_basic", f"{work}/_stage{k}",
                       on_error="continue", audit_path=f"{work}/_audit", table="emp_basic", load_time=at)
    a = load.load_history(f"{work}/_audit", cat.spark, since=now - timedelta(hours=1), table="emp_basic")
    return a.select(F.regexp_extract("file", r"emp_file=([^/]+)", 1).alias("file"),
                    "rows_parsed", "errors_seen", "rows_loaded",
                    F.col("first_error_line").cast("double").alias("first_error_line"), "status")


@query("s07_copy_once", with_views(
    "SELECT *, CASE WHEN CAST(transaction_id AS BIGINT) % 3 = 0 THEN 2 ELSE 1 END AS copies FROM b_transactions",
    "b_transactions", ts=("transaction_date",)))
def s07_copy_once(cat):
    """COPY with a ledger: run over a first wave, again without news, then with a
    second wave beside the first: every file loads once. A last COPY with FORCE
    loads the third wave's files twice."""
    work = scratch(cat.spark, "copy-once")
    wave = F.pmod(F.col("transaction_id").cast("long"), F.lit(3))
    t = cat.b_transactions

    def copy(source: str, **more) -> load.LoadResult:
        return load.copy_into(cat.spark, source, sinks.GZIP_CSV, SCHEMAS["transactions"], f"{work}/transactions",
                              f"{work}/_stage", on_error="continue", ledger=f"{work}/_ledger", **more)
    sinks.unload_csv(t.filter(wave == 1), f"{work}/files/one")
    copy(f"{work}/files")
    copy(f"{work}/files")
    sinks.unload_csv(t.filter(wave == 2), f"{work}/files/two")
    copy(f"{work}/files")
    sinks.unload_csv(t.filter(wave == 0), f"{work}/files/three")
    copy(f"{work}/files")
    loaded = copy(f"{work}/files/three", force=True).loaded
    return loaded.groupBy(*t.columns).agg(F.count(F.lit(1)).cast("int").alias("copies"))


@query("s07_copy_into", with_views("SELECT * FROM b_transactions", "b_transactions", ts=("transaction_date",)))
def s07_copy_into(cat):
    """Staged transactions CSV → COPY INTO typed table, ON_ERROR=CONTINUE."""
    src = sinks.unload_csv(cat.b_transactions, f"{scratch(cat.spark, 'bank-stage')}/transactions")
    work = scratch(cat.spark, "copy")
    return load.copy_into(cat.spark, src, sinks.GZIP_CSV, SCHEMAS["transactions"], f"{work}/transactions",
                          f"{work}/_stage", on_error="continue").loaded


S16 = {"customers": ("s16_typed_load", "b_customers", {"dates": ("date_of_birth", "customer_since")}),
       "transactions": ("s16_transactions", "b_transactions", {"ts": ("transaction_date",)}),
       "accounts": ("s16_accounts", "b_accounts", {"dates": ("open_date",)}),
       "credit_data": ("s16_credit", "b_credit", {}),
       "watchlist": ("s16_watchlist", "b_watchlist", {"dates": ("listed_date",)})}
assert set(S16) == set(KEYS) - {"person_master"}


def _register_typed_load(table: str) -> None:
    name, source, temporal = S16[table]

    def run(cat):
        src = sinks.unload_csv(getattr(cat, source), f"{scratch(cat.spark, 'bank-stage')}/{table}")
        work = scratch(cat.spark, "raw")
        return load.copy_into(cat.spark, src, sinks.GZIP_CSV, SCHEMAS[table], f"{work}/{table}",
                              f"{work}/_stage", on_error="continue").loaded

    run.__doc__ = f"The banking table {table} staged and loaded against its declared schema (S16)."
    query(name, with_views(f"SELECT * FROM {source}", source, **temporal))(run)


for _t in S16:
    _register_typed_load(_t)


@query("s15_append", with_views(
    "SELECT transaction_id, amount, 'flagged' AS batch FROM b_transactions WHERE is_flagged "
    "UNION ALL SELECT transaction_id, amount, 'high' AS batch FROM b_transactions WHERE amount > 9000",
    "b_transactions"))
def s15_append(cat):
    """INSERT INTO t SELECT ... twice; the second insert appends."""
    path = f"{scratch(cat.spark, 'native')}/alerts"
    t = cat.b_transactions
    sinks.append(t.filter("is_flagged").select("transaction_id", "amount", F.lit("flagged").alias("batch")), path)
    sinks.append(t.filter(F.col("amount") > 9000).select("transaction_id", "amount", F.lit("high").alias("batch")),
                 path)
    return cat.spark.read.parquet(path)

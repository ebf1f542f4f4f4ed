"""The derived workload views of ``quarry.fixtures`` restated in DuckDB SQL.

Used only to build the oracle SQL strings: each oracle query is prefixed
with the CTEs it needs, so it runs on the bare test tables.
"""

from __future__ import annotations

from quarry import fixtures as fx


def case_pick(values: list[str], index_sql: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {index_sql} {arms} END)"


def case_map(mapping: dict[str, str], key_sql: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {key_sql} {arms} END)"


def rnd(expr: str, digits: int) -> str:
    scale = 10 ** digits
    return f"(floor(({expr}) * {scale} + 0.5) / {scale})"


def days_after(start: str, offset_sql: str) -> str:
    return f"(DATE '{start}' + CAST({offset_sql} AS INTEGER))"


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, deps: tuple[str, ...], sql: str) -> None:
    VIEWS[name] = (deps, sql)


view("geo", (), """
SELECT n_nationkey, n_name, r_name AS country
FROM nation JOIN region ON n_regionkey = r_regionkey""")

view("b_customers", ("geo",), f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name,
       {days_after('1940-01-01', '(c_custkey * 37) % 20000')} AS date_of_birth,
       CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
       'customer' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
       '+1-555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone_number,
       CAST(c_custkey % 999 + 1 AS VARCHAR) || ' Main Street' AS address,
       n_name AS city, country,
       lower(c_mktsegment) AS occupation,
       CASE WHEN c_acctbal < 2000 THEN 'Low' WHEN c_acctbal < 6000 THEN 'Medium' ELSE 'High' END AS income_bracket,
       {days_after('2014-01-01', '(c_custkey * 13) % 3650')} AS customer_since
FROM customer JOIN geo ON c_nationkey = n_nationkey""")

view("b_transactions", ("geo",), f"""
SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
       CAST(o_custkey AS VARCHAR) AS customer_id,
       o_orderdate AS transaction_date,
       floor((round(o_totalprice * 100) + 25) / 50) / 100 AS amount,
       {case_map(fx.CURRENCY_BY_COUNTRY, 'l.country')} AS currency,
       {case_pick(fx.TRANSACTION_TYPES, 'o_orderkey % 4')} AS transaction_type,
       {case_pick(fx.CHANNELS, '(o_orderkey // 4) % 4')} AS channel,
       {case_pick(fx.MERCHANTS, 'o_custkey % 5')} AS merchant_name,
       {case_pick(fx.CATEGORIES, 'o_orderkey % 5')} AS merchant_category,
       l.country AS location_country,
       l.n_name AS location_city,
       (o_totalprice > 450000 AND o_orderstatus = 'F') AS is_flagged
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN geo l ON l.n_nationkey = (c_nationkey + 5 * (o_orderkey % 5)) % 25""")

view("b_accounts", ("geo",), f"""
SELECT CAST(c_custkey AS VARCHAR) || '-' || CAST(seq AS VARCHAR) AS account_id,
       CAST(c_custkey AS VARCHAR) AS customer_id,
       {case_pick(fx.ACCOUNT_TYPES, '(c_custkey + seq) % 4')} AS account_type,
       {case_pick(fx.ACCOUNT_STATUSES, '(c_custkey * seq) % 3')} AS account_status,
       {days_after('2015-01-01', '(c_custkey * 7 + seq * 101) % 3000')} AS open_date,
       round(abs(c_acctbal) * seq + 100, 2) AS current_balance,
       {case_map(fx.CURRENCY_BY_COUNTRY, 'country')} AS currency,
       CASE WHEN (c_custkey + seq) % 4 = 2 THEN CAST(1000 + (c_custkey * seq * 97) % 49000 AS DOUBLE)
            ELSE 0.0 END AS credit_limit
FROM (SELECT c_custkey, c_acctbal, country, unnest(range(1, CAST(c_custkey % 3 + 2 AS BIGINT))) AS seq
      FROM customer JOIN geo ON c_nationkey = n_nationkey)""")

view("b_credit", (), """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       CAST(300 + (c_custkey * 37) % 551 AS INTEGER) AS credit_score,
       CAST(c_custkey % 10 + 1 AS INTEGER) AS number_of_credit_accounts,
       CAST(1000 + (c_custkey * 131) % 49000 AS DOUBLE) AS total_credit_limit,
       round(CAST(1000 + (c_custkey * 131) % 49000 AS DOUBLE) * ((c_custkey * 17) % 100) / 100, 2) AS total_credit_used,
       CAST(c_custkey % 6 AS INTEGER) AS number_of_late_payments,
       CAST(CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS bankruptcies
FROM customer""")

view("b_watchlist", (), f"""
SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS entity_id, s_name AS entity_name,
       'Organization' AS entity_type,
       CASE WHEN s_acctbal < 3000 THEN 'Low' WHEN s_acctbal < 7000 THEN 'Medium' ELSE 'High' END AS risk_category,
       {days_after('2012-01-01', '(s_suppkey * 29) % 3650')} AS listed_date,
       {case_pick(fx.WATCHLIST_SOURCES, 's_suppkey % 4')} AS source
FROM supplier
UNION ALL
SELECT 'C' || CAST(c_custkey AS VARCHAR),
       '  ' || upper(split_part(c_name, '#', 1)) || '. ' || split_part(c_name, '#', 2) || ' ',
       'Individual',
       CASE WHEN c_acctbal < 3000 THEN 'Low' WHEN c_acctbal < 7000 THEN 'Medium' ELSE 'High' END,
       {days_after('2012-01-01', '(c_custkey * 29) % 3650')},
       {case_pick(fx.WATCHLIST_SOURCES, 'c_custkey % 4')}
FROM customer WHERE c_custkey % 50 = 0""")

view("c_info", ("geo",), f"""
SELECT c_name AS username,
       CAST((c_custkey * 7) % 1000 AS BIGINT) AS followers,
       n_name AS country,
       {days_after('2010-01-01', '(c_custkey * 11) % 4000')} AS joined,
       n_name || ' city' AS location,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Player ' || CAST(c_custkey AS VARCHAR) END AS name,
       'p' || CAST(c_custkey AS VARCHAR) AS player_id,
       {case_map(fx.PLAYER_STATUS_BY_SEGMENT, 'c_mktsegment')} AS status,
       CASE WHEN c_custkey % 11 = 0 THEN 'GM' WHEN c_custkey % 7 = 0 THEN 'IM' END AS title,
       c_custkey AS primary_key
FROM customer JOIN geo ON c_nationkey = n_nationkey""")

view("c_stats", (), """
SELECT CAST(floor(max(o_totalprice) / 100) AS BIGINT) AS last_blitz,
       count_if(o_orderstatus = 'P') AS draw_blitz,
       count_if(o_orderstatus = 'O') AS loss_blitz,
       count_if(o_orderstatus = 'F') AS win_blitz,
       CAST(floor(min(o_totalprice) / 100) AS BIGINT) AS last_bullet,
       count_if(o_orderpriority = '3-MEDIUM') AS draw_bullet,
       count_if(o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')) AS loss_bullet,
       count_if(o_orderpriority IN ('1-URGENT', '2-HIGH')) AS win_bullet,
       CAST(floor(max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) / 100) AS BIGINT) AS last_rapid,
       count_if(o_totalprice = 250000) AS draw_rapid,
       count_if(o_totalprice < 250000) AS loss_rapid,
       count_if(o_totalprice > 250000) AS win_rapid,
       CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(max(floor(o_totalprice / 200)) AS BIGINT) END AS fide,
       o_custkey AS primary_key
FROM orders GROUP BY o_custkey""")

view("c_list", (), """
SELECT c_name AS username, (c_custkey % 2 = 0) AS is_live
FROM customer WHERE c_custkey IN (SELECT DISTINCT user_id FROM events)""")

view("file_customer", ("geo",), f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_customer_sk,
       'AAAAAAAA' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS c_customer_id,
       CAST((c_custkey * 7) % 1920800 AS VARCHAR) AS c_current_cdemo_sk,
       CAST(c_custkey % 7200 AS VARCHAR) AS c_current_hdemo_sk,
       CAST((c_custkey * 3) % 50000 AS VARCHAR) AS c_current_addr_sk,
       CAST(c_custkey % 3000 + 2449000 AS VARCHAR) AS c_first_shipto_date_sk,
       CAST(c_custkey % 3000 + 2448970 AS VARCHAR) AS c_first_sales_date_sk,
       {case_pick(fx.SALUTATIONS, 'c_custkey % 6')} AS c_salutation,
       upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS c_first_name,
       n_name AS c_last_name,
       CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END AS c_preferred_cust_flag,
       CAST(c_custkey % 28 + 1 AS VARCHAR) AS c_birth_day,
       CAST(c_custkey % 12 + 1 AS VARCHAR) AS c_birth_month,
       CAST(c_custkey % 70 + 1930 AS VARCHAR) AS c_birth_year,
       country AS c_birth_country,
       CAST(NULL AS VARCHAR) AS c_login,
       lower(split_part(c_name, '#', 2)) || '@example.org' AS c_email_address,
       CAST(c_custkey % 500 + 2452000 AS VARCHAR) AS c_last_review_date_sk
FROM customer JOIN geo ON c_nationkey = n_nationkey""")

view("persons", ("geo",), f"""
SELECT c_custkey, c_nationkey,
       CAST(c_custkey AS VARCHAR) AS id,
       c_name AS name,
       CAST(c_custkey % 60 + 18 AS INTEGER) AS age,
       n_name AS location,
       CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 4 = 1 THEN NULL
            ELSE lpad(CAST((c_custkey * 7) % 100000 AS VARCHAR), 5, '0') END AS zip,
       (c_custkey % 2 = 0) AS member,
       strftime({days_after('2015-01-01', '(c_custkey * 3) % 2000')}, '%Y-%m-%d') AS since,
       round(c_acctbal, 2) AS balance
FROM customer JOIN geo ON c_nationkey = n_nationkey""")

view("change_log", (), """
SELECT user_id AS key, ts, event_id AS seq,
       CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPSERT' END AS action,
       event_type, value, CAST(dayofmonth(ts) AS BIGINT) AS batch_id
FROM events""")


TS_FMT = "%Y-%m-%d %H:%M:%S.%f"


def with_views(sql: str, *names: str, ts: tuple[str, ...] = (), dates: tuple[str, ...] = ()) -> str:
    """Prefix ``sql`` with the CTEs for ``names`` and their dependencies.

    ``ts``/``dates`` name output columns to render the way ``present``
    renders them on the Spark side (fixed 6-digit micros; ISO dates).
    """
    if ts or dates:
        reps = [f"strftime({c}, '{TS_FMT}') AS {c}" for c in ts]
        reps += [f"CAST({c} AS VARCHAR) AS {c}" for c in dates]
        sql = f"SELECT * REPLACE ({', '.join(reps)}) FROM ({sql}) AS presented"
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order)
    return f"WITH {ctes}\n{sql}"

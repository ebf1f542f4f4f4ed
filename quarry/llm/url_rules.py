"""Judge urls by host and path rules with a sort-merge range join.

The canonical key of a url is its host with the labels reversed, each
followed by a dot, then the path: ``com.example.www./en/1``. A rule's host
``example.com`` becomes the interval ['com.example.', 'com.example/'), which
holds the host and all its subdomains and nothing else. Urls are dealt by
key quantiles, every rule goes to the parts its interval meets, and a sweep
over each sorted part keeps the stack of nested rules open at the current key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import require_columns, shuffle_parts

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT_VERDICT = "allow"  # of a url that no rule fits

#: fixed values: the rules (host, path, verdict) of the page filter
PAGE_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty without '://' or for NULL. Only A-Z is lowered."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def reversed_host(host: Column) -> Column:
    """'www.example.com' -> 'com.example.www.'; an empty host stays empty."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit(".")))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, key, kind): kind 0 opens a rule, kind 1 is a url.

    The stack holds the hosts whose intervals enclose the key, outermost
    first; each has its rules by path, tried from the longest path down.
    """
    stack: list[tuple[str, str, dict[str, tuple[str, str]], list[int]]] = []
    part = None
    for batch in batches:
        out: dict[str, list] = {"row_id": [], "host": [], "path": [], "rule": [], "verdict": []}
        cols = [batch.column(k).to_pylist() for k in ("_part", "_key", "_kind", "row_id", "host", "path", "verdict")]
        for p, key, kind, row_id, host, path, verdict in zip(*cols):
            if p != part:
                stack, part = [], p
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                if not stack or stack[-1][0] != key:
                    stack.append((key, host, {}, []))
                paths, sizes = stack[-1][2:]
                paths[path] = (host + path, verdict)
                sizes[:] = sorted({len(x) for x in paths}, reverse=True)
                continue
            best = None
            for _, rule_host, paths, sizes in reversed(stack):
                for size in sizes:
                    if size <= len(path) and path[:size] in paths:
                        if best is None or len(rule_host) + size > len(best[0]):
                            best = paths[path[:size]]
                        break
            for name, v in zip(out, (row_id, host, path, *(best or (None, DEFAULT_VERDICT)))):
                out[name].append(v)
        if out["host"]:
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("row_id", batch.schema.field("row_id").type), ("host", pa.string()), ("path", pa.string()),
                ("rule", pa.string()), ("verdict", pa.string())]))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per page: id, host, path, rule (NULL if none fits), verdict.

    ``rules``: host, path, verdict. A rule fits its host and all subdomains if
    the path starts with the rule's; the longest host + path wins, a tie goes
    to the longer host. Of rules repeated with different verdicts, 'block' wins.
    NULL urls and urls without '://' have an empty host and no rule. Repeated
    pages are judged each; extra columns of either table are ignored; no rules
    or no pages give no rule or no rows.
    """
    require_columns(pages, id_col, url_col)
    require_columns(rules, "host", "path", "verdict")
    n = shuffle_parts(pages.sparkSession)
    host, path = url_parts(F.col(url_col))
    urls = (pages.select(F.col(id_col).alias("row_id"), host.alias("host"), path.alias("path"))
            .withColumn("_key", F.concat(reversed_host(F.col("host")), F.col("path"))))
    keyed = (rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
             .withColumn("_key", reversed_host(F.col("host"))))

    # n - 1 cut keys by quantile of the reversed keys; equal cuts mark a hot
    # key, whose urls are spread over all parts between them by id
    order = F.col("_key")
    cuts = _cut_keys(urls, n)
    bound = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<string>")
    lo = lambda k: F.size(F.filter(bound, lambda c: c < k))
    hi = lambda k: F.size(F.filter(bound, lambda c: c <= k))
    urls = urls.withColumn("_lo", lo(order)).withColumn("_hi", hi(order))
    urls = urls.withColumn("_part", (F.col("_lo") + F.pmod(F.xxhash64("row_id"), F.col("_hi") - F.col("_lo") + 1))
                           .cast("int")).drop("_lo", "_hi")
    # the interval of a rule ends just below its key with the last '.' as '/'
    end = F.when(F.col("_key") == "", F.lit("\U0010ffff")).otherwise(
        F.concat(F.expr("substring(_key, 1, length(_key) - 1)"), F.lit("/")))
    opened = keyed.select(
        F.explode(F.sequence(lo(order), hi(end))).alias("_part"), "_key", F.lit(0).alias("_kind"),
        F.lit(None).cast(urls.schema["row_id"].dataType).alias("row_id"), "host", "path", "verdict")
    events = opened.unionByName(urls.select("_part", "_key", F.lit(1).alias("_kind"), "row_id", "host", "path",
                                            F.lit(None).cast("string").alias("verdict")))
    kind = urls.schema["row_id"].dataType.simpleString()
    return (events.repartition(n, "_part").sortWithinPartitions("_part", "_key", "_kind")
            .mapInArrow(_sweep, f"row_id {kind}, host string, path string, rule string, verdict string")
            .withColumnRenamed("row_id", id_col))


def _cut_keys(urls: DataFrame, n: int) -> list[str]:
    """At most n - 1 keys at the quantiles of all keys, ascending.

    Quantiles of strings: the ntile bounds of the keys' counts per prefix would
    need a sort; a reservoir of 64 keys per cut, picked by hash, is enough to
    balance parts, and which cuts are picked never changes a verdict.
    """
    want = 64 * n
    picked = urls.select("_key", F.xxhash64("row_id", "_key").alias("_h")).orderBy("_h").limit(want).collect()
    keys = sorted(r["_key"] for r in picked)
    return [keys[len(keys) * k // n] for k in range(1, n)] if keys else []


def judge_pages(pages: DataFrame) -> DataFrame:
    rules = pages.sparkSession.createDataFrame(PAGE_RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules)


PAGE_ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r(rh, rp, rv) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m AS (
  SELECT p.page_id, r.rh || r.rp AS rule, rv,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(rh) + length(rp) DESC, length(rh) DESC) AS k
  FROM p JOIN r ON (p.host = r.rh OR ends_with(p.host, '.' || r.rh)) AND starts_with(p.path, r.rp)
)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.rv, 'allow') AS verdict
FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.k = 1
"""

"""Find secrets in whole texts with column expressions only.

Base patterns are matched leftmost and without overlaps; the positions follow
from the lengths of the matches and of the text between them. Beside them,
strings of a character class are candidates: a window slides over the string,
the counts of its characters change by one that leaves and one that enters,
and with them the sum of c * log2(c), from which the Shannon entropy follows.
Windows at or above the class's threshold join to spans, unless the allow-list
knows the string. All of a row happens in its own expression: no shuffle, and
a row's cost is in proportion to its text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import require_columns

# The base patterns. Letters stand in both cases where the case is
# free, so that no engine's folding of other alphabets takes part.
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
LEAST_ASSIGNED = 12  # characters of an assigned value
#: every assignment holds a sign of SIGNS and, in lower case, a word of WORDS
SIGNS, WORDS = (":", "="), ("password", "passwd", "secret", "token", "api")

SCALE = 1_000_000  # c * log2(c) in whole millionths, so that no engine rounds differently
CHUNK = 256  # lengths whose running sum is one array


@dataclass(frozen=True)
class EntropyClass:
    """Strings of ``alphabet`` (a regex class of its characters) and the entropy,
    in bits a character, that ``window`` characters in a row must reach."""
    kind: str
    alphabet: str
    window: int
    bits: float

    @property
    def pattern(self) -> str:
        return f"[{''.join(chr(92) + c if c in '-_+/=' else c for c in self.alphabet)}]{{{self.window},}}"

    @property
    def table(self) -> list[int]:
        return [0] + [round(SCALE * c * log2(c)) for c in range(1, self.window + 1)]

    @property
    def most(self) -> int:
        """Largest sum of c * log2(c) of a window that reaches the threshold."""
        return int(SCALE * self.window * (log2(self.window) - self.bits))


_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
CLASSES = (EntropyClass("hex_entropy", _DIGITS + "ABCDEFabcdef", 20, 3.0),
           EntropyClass("base64_entropy", _DIGITS + _LOWER.upper() + _LOWER + "+/=_-", 24, 4.0))

#: strings that are no secrets whatever their entropy: numbers, words joined by
#: marks, runs along the alphabet, placeholders
ALLOWED = ("^[0-9]+$", "^[A-Z]?[a-z]+([-_/=+][A-Z]?[a-z]+)*$", "01234567", "[aA][bB][cC][dD][eE][fF][gG]",
           "[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Ss][Aa][Mm][Pp][Ll][Ee]|[Dd][Uu][Mm][Mm][Yy]"
           "|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Cc][Hh][Aa][Nn][Gg][Ee]_?[Mm][Ee]|[Xx]{6}")


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def _starts(sizes: Column) -> Column:
    """Sum of the sizes before each one: running sums of chunks, then of their totals,
    so the work per row stays in proportion to it."""
    none = F.array().cast("array<long>")
    chunks = F.transform(F.sequence(_long(0), F.floor((F.size(sizes) - 1) / CHUNK)),
                         lambda b: F.slice(sizes, (b * CHUNK + 1).cast("int"), F.lit(CHUNK)))
    inside = F.transform(chunks, lambda c: F.aggregate(
        c, F.struct(_long(0).alias("sum"), none.alias("at")),
        lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["at"], F.array(s["sum"])).alias("at"))))
    return F.flatten(F.aggregate(
        inside, F.struct(_long(0).alias("sum"), F.array().cast("array<array<long>>").alias("all")),
        lambda s, c: F.struct((s["sum"] + c["sum"]).alias("sum"), F.concat(
            s["all"], F.array(F.transform(c["at"], lambda x: x + s["sum"]))).alias("all")))["all"])


def matches(text: Column, pattern: str, *more: Column) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` (never empty ones) in order:
    structs of start, end (code points, end exclusive) and value, and of ``more`` arrays
    of the same order as fields m0, m1, ... NULL where there is none."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    size = lambda x: F.length(x).cast("long")
    between = F.transform(F.split(text, pattern, -1), size)
    # text before match i and all matches and texts before it
    whole = F.zip_with(F.slice(between, F.lit(1), F.size(found)), F.transform(found, size),
                       lambda gap, own: gap + own)
    spans = F.transform(
        F.arrays_zip(_starts(whole), between, found, *more),
        lambda z: F.struct((z["0"] + z["1"]).alias("start"), (z["0"] + z["1"] + size(z["2"])).alias("end"),
                           z["2"].alias("value"), *[z[str(3 + i)].alias(f"m{i}") for i in range(len(more))]))
    # the text behind the last match has no match of its own
    return F.when(F.size(found) > 0, F.slice(spans, F.lit(1), F.size(found)))


def _hot(value: Column, c: EntropyClass) -> Column:
    """Maximal spans (from, to) of ``value`` whose windows all reach the threshold."""
    codes = F.transform(F.split(value, "", -1), lambda ch: F.instr(F.lit(c.alphabet), ch))
    table = F.array(*[F.lit(x) for x in c.table])
    spans = F.array().cast("array<struct<from:int,to:int>>")
    start = F.struct(F.array_repeat(F.lit(0), len(c.alphabet)).alias("counts"), _long(0).alias("sum"),
                     F.lit(-1).alias("from"), F.lit(-1).alias("to"), spans.alias("done"))

    def step(s: Column, at: Column, own: Column) -> Column:
        """The window that ends with the character at ``at`` (1-based)."""
        # one bound at a time: an array of one element and transform
        gone = F.when(at > c.window, F.element_at(own, F.greatest(at - c.window, F.lit(1)))).otherwise(F.lit(0))
        come = F.element_at(own, at)
        moved = F.transform(F.array(F.struct(gone.alias("gone"), come.alias("come"))), lambda m: F.struct(
            F.transform(s["counts"], lambda n, i: n + F.when(i + 1 == m["come"], 1).otherwise(0)
                        - F.when(i + 1 == m["gone"], 1).otherwise(0)).alias("counts"),
            F.when(m["gone"] == m["come"], s["sum"]).otherwise(
                s["sum"] + F.get(table, F.get(s["counts"], m["come"] - 1) + 1)
                - F.get(table, F.get(s["counts"], m["come"] - 1))
                + F.when(m["gone"] > 0, F.get(table, F.get(s["counts"], m["gone"] - 1) - 1)
                         - F.get(table, F.get(s["counts"], m["gone"] - 1))).otherwise(0)).cast("long").alias("sum")))[0]
        return F.transform(F.array(moved), lambda m: F.struct(
            m["counts"].alias("counts"), m["sum"].alias("sum"),
            F.when((at >= c.window) & (m["sum"] <= c.most) & (s["to"] < at - c.window), at - c.window)
            .otherwise(s["from"]).alias("from"),
            F.when((at >= c.window) & (m["sum"] <= c.most), at).otherwise(s["to"]).alias("to"),
            F.when((at >= c.window) & (m["sum"] <= c.most) & (s["to"] < at - c.window) & (s["to"] > 0),
                   F.concat(s["done"], F.array(F.struct(s["from"].alias("from"), s["to"].alias("to")))))
            .otherwise(s["done"]).alias("done")))[0]

    last = lambda s: F.when(s["to"] > 0, F.concat(
        s["done"], F.array(F.struct(s["from"].alias("from"), s["to"].alias("to"))))).otherwise(s["done"])
    return F.flatten(F.transform(F.array(codes), lambda own: F.aggregate(
        F.sequence(F.lit(1), F.size(own)), start, lambda s, at: step(s, at, own), last)))


def _kept(spans: Column, order: int) -> Column:
    return F.coalesce(F.transform(spans, lambda m: F.struct(
        m["start"].alias("start"), F.lit(order).alias("order"), m["end"].alias("end"))),
        F.array().cast("array<struct<start:bigint,order:int,end:bigint>>"))


def _joined(spans: Column, kinds: list[str]) -> Column:
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["order"]), s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, text_col: str = "text", classes: tuple[EntropyClass, ...] = CLASSES,
                 allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """The columns of ``docs`` and n_assign, n_access, n_hex (longs), base_spans and
    spans: kind:start:end by start, then kind (assign, access, hex, then the entropy
    classes), joined by commas; code points, end exclusive.

    A NULL or empty text has no spans (empty strings, zeros). Rows are judged
    each by itself, so repeated rows and ids repeat their results; an empty
    table gives no rows. Columns of the result's names raise ValueError.
    """
    require_columns(docs, text_col)
    kinds = ["assign", "access", "hex", *[c.kind for c in classes]]
    own = {"n_assign", "n_access", "n_hex", "base_spans", "spans"}
    helpers = {f"_{k}" for k in kinds} | {"_text"}
    if (own | helpers) & set(docs.columns):
        raise ValueError(f"columns {sorted((own | helpers) & set(docs.columns))} clash with the result")
    text = F.col("_text")
    value = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    # plain searches spare most texts the costliest pattern
    may_assign = (reduce(Column.__or__, [F.contains(text, F.lit(s)) for s in SIGNS])
                  & reduce(Column.__or__, [F.contains(F.lower(text), F.lit(w)) for w in WORDS]))
    base = [F.when(may_assign, F.filter(matches(text, ASSIGN, value), lambda m: F.length(m["m0"]) >= LEAST_ASSIGNED)),
            F.when(F.contains(text, F.lit("AKIA")), matches(text, ACCESS)), matches(text, HEX)]
    found = (docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
             .withColumns({f"_{k}": x for k, x in zip(kinds, [*base, *[matches(text, c.pattern) for c in classes]])}))

    def entropy_spans(c: EntropyClass) -> Column:
        unknown = F.filter(F.col(f"_{c.kind}"), lambda m: ~reduce(
            Column.__or__, [m["value"].rlike(p) for p in allowed], F.lit(False)))
        return F.flatten(F.transform(unknown, lambda m: F.transform(_hot(m["value"], c), lambda h: F.struct(
            (m["start"] + h["from"]).alias("start"), (m["start"] + h["to"]).alias("end")))))

    found = found.withColumns({f"_{k}": _kept(entropy_spans(c) if c else F.col(f"_{k}"), i) for i, (k, c) in
                               enumerate(zip(kinds, [None, None, None, *classes]))})
    count = lambda k: F.size(f"_{k}").cast("long")
    return found.select(
        *docs.columns, count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        _joined(F.concat("_assign", "_access", "_hex"), kinds).alias("base_spans"),
        _joined(F.concat(*[f"_{k}" for k in kinds]), kinds).alias("spans"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches_sql(kind: str, order: int, pattern: str, keep: str) -> str:
    p = _quoted(pattern)
    return f"""
  SELECT r, '{kind}' AS kind, {order} AS o, v, CAST(ending - length(v) AS BIGINT) AS s, CAST(ending AS BIGINT) AS e
  FROM (SELECT r, v, w, sum(length(gap) + length(v)) OVER (PARTITION BY r ORDER BY i) AS ending
        FROM (SELECT r, unnest(m) AS v, unnest(g) AS w, unnest(gaps[1:len(m)]) AS gap, generate_subscripts(m, 1) AS i
              FROM (SELECT r, regexp_extract_all(t, {p}) AS m, string_split_regex(t, {p}) AS gaps,
                           regexp_extract_all(t, {p}, {2 if kind == "assign" else 0}) AS g FROM d)))
  WHERE {keep}"""


def _hot_sql(order: int, c: EntropyClass, allowed: tuple[str, ...]) -> str:
    known = " OR ".join(f"regexp_matches(v, {_quoted(p)})" for p in allowed)
    return f"""
  SELECT r, '{c.kind}' AS kind, {order} AS o, s + min(a) AS s, s + max(a) + {c.window} AS e
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY r, s ORDER BY a) AS island
        FROM (SELECT *, CAST(coalesce(a - lag(a) OVER (PARTITION BY r, s ORDER BY a) > {c.window}, true) AS INT) AS fresh
              FROM (SELECT r, s, v, unnest(range(0, length(v) - {c.window - 1})) AS a FROM ({_matches_sql(
                  c.kind, order, c.pattern, "true")}) WHERE NOT ({known}))
              WHERE list_sum(list_transform(
                map_values(list_aggregate(string_split(substr(v, a + 1, {c.window}), ''), 'histogram')),
                lambda n: round({SCALE} * n * log2(n)))) <= {c.most}))
  GROUP BY r, s, island"""


SECRETS_ORACLE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
base AS MATERIALIZED (
  {" UNION ALL ".join([_matches_sql("assign", 0, ASSIGN, f"length(w) >= {LEAST_ASSIGNED}"),
                       _matches_sql("access", 1, ACCESS, "true"), _matches_sql("hex", 2, HEX, "true")])}
), every AS (SELECT r, kind, o, s, e FROM base UNION ALL
  {" UNION ALL ".join(_hot_sql(3 + i, c, ALLOWED) for i, c in enumerate(CLASSES))}
), b AS (
  SELECT r, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans FROM base GROUP BY r
), x AS (SELECT r, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o, e) AS spans FROM every GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.spans, '')) AS base_sha256, coalesce(x.spans, '') AS spans
FROM d LEFT JOIN b USING (r) LEFT JOIN x USING (r)
"""

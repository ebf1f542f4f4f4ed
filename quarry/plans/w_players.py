"""Player-statistics workload (W3): joins, averages, top-1."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.scalars import round_half_up

from quarry.operators import relational as rel
from quarry.plans.oracle_views import view, with_views
from quarry.plans.registry import query

view("players", ("c_info", "c_stats"), """
SELECT *, coalesce(name, username) AS shown, CAST(fide AS DOUBLE) AS rating
FROM c_info NATURAL JOIN c_stats""")


def best_sql(measure: str, *columns: str) -> str:
    """Of the players with the highest ``measure`` the one whose username comes first."""
    return (f"SELECT {', '.join(columns)} FROM players QUALIFY row_number() OVER "
            f"(ORDER BY {measure} DESC NULLS LAST, username) = 1")


def mean_sql(column: str, out: str) -> str:
    return f"floor(avg({column}) * 10000 + 0.5) / 10000 AS {out}"


def r4(c):
    return round_half_up(c, 4)


def _register_best(mode: str) -> None:
    measure = f"last_{mode}"

    def run(cat):
        return rel.best_player(cat.c_info, cat.c_stats, measure)

    run.__doc__ = f"The player with the highest {mode} rating (O01)."
    query(f"o01_best_{mode}", with_views(best_sql(measure, "username"), "players"))(run)


MODES = ("blitz", "bullet", "rapid")
for _m in MODES:
    _register_best(_m)


@query("o02_best_named", with_views(best_sql("rating", "shown AS player_name", "rating AS fide"), "players"))
def o02_best_named(cat):
    return rel.best_named(cat.c_info, cat.c_stats).withColumn("fide", F.col("fide").cast("double"))


@query("o03_best_live", with_views(
    "SELECT username, rating AS fide FROM players SEMI JOIN (FROM c_list WHERE is_live) AS live USING (username) "
    "QUALIFY row_number() OVER (ORDER BY rating DESC NULLS LAST, username) = 1", "c_list", "players"))
def o03_best_live(cat):
    return rel.best_live(cat.c_list, cat.c_info, cat.c_stats).withColumn("fide", F.col("fide").cast("double"))


@query("ag02_status_avgs", with_views(
    "SELECT status, " + ", ".join(mean_sql(f"last_{m}", f"avg_{m}_elo") for m in MODES)
    + f", {mean_sql('rating', 'avg_fide_elo')} FROM players GROUP BY ALL "
    "HAVING status IN ('basic', 'premium', 'staff')", "players"))
def ag02_status_avgs(cat):
    df = rel.status_averages(cat.c_info, cat.c_stats)
    return df.select("status", *[r4(c).alias(c) for c in df.columns[1:]])


@query("ag03_titled_count_avg", with_views(
    f"SELECT count(title) AS num_pro_players, {mean_sql('CASE WHEN title IS NOT NULL THEN rating END', 'avg_pro_elo')} "
    "FROM players", "players"))
def ag03_titled_count_avg(cat):
    df = rel.titled_summary(cat.c_info, cat.c_stats)
    return df.select("num_pro_players", r4("avg_pro_elo").alias("avg_pro_elo"))


@query("ag04_title_avg", with_views(
    f"SELECT title, {mean_sql('rating', 'avg_fide_elo')} FROM players GROUP BY ALL", "players"))
def ag04_title_avg(cat):
    df = rel.title_averages(cat.c_info, cat.c_stats)
    return df.select("title", r4("avg_fide_elo").alias("avg_fide_elo"))


@query("j01_inner", with_views(
    "SELECT username, status, last_blitz, last_bullet, rating AS fide FROM players", "players"))
def j01_inner(cat):
    return rel.players(cat.c_info, cat.c_stats).select(
        "username", "status", "last_blitz", "last_bullet", F.col("fide").cast("double").alias("fide"))


@query("j02_three_way", with_views(
    "SELECT username, is_live, title, rating AS fide FROM players JOIN c_list USING (username)", "c_list", "players"))
def j02_three_way(cat):
    j = cat.c_list.join(cat.c_info, "username").join(cat.c_stats, "primary_key")
    return j.select("username", "is_live", "title", F.col("fide").cast("double").alias("fide"))


@query("p06_in_list", with_views(
    "SELECT username, status FROM c_info WHERE status IN ('premium', 'staff', 'basic')", "c_info"))
def p06_in_list(cat):
    return cat.c_info.filter(F.col("status").isin("premium", "staff", "basic")).select("username", "status")


@query("p07_null_tests", with_views(
    "SELECT username, title, name FROM c_info WHERE title IS NOT NULL OR name IS NULL", "c_info"))
def p07_null_tests(cat):
    i = cat.c_info
    return i.filter(F.col("title").isNotNull() | F.col("name").isNull()).select("username", "title", "name")


@query("p08_boolean", with_views("SELECT username FROM c_list WHERE is_live", "c_list"))
def p08_boolean(cat):
    # `is_live = 1` of the reference: a boolean is tested as itself under ANSI.
    return cat.c_list.filter(F.col("is_live")).select("username")


@query("c01_coalesce", with_views(
    "SELECT primary_key, COALESCE(name, username) AS player_name FROM c_info", "c_info"))
def c01_coalesce(cat):
    return cat.c_info.select("primary_key", F.coalesce("name", "username").alias("player_name"))


@query("s05_json_stats_typed", with_views(
    "SELECT primary_key, last_blitz, CAST(fide AS DOUBLE) AS fide FROM c_stats", "c_stats"))
def s05_json_stats_typed(cat):
    """Stats documents unloaded as JSON arrays, then loaded back with the
    declared schema (strip_outer_array): one row per element."""
    from quarry.sources import scan
    from quarry.session import scratch
    stage = scratch(cat.spark, "chess-stage")
    scan.unload_json_arrays(cat.c_stats, f"{stage}/stats", bucket_col="primary_key")
    loaded = scan.scan_json(cat.spark, f"{stage}/stats", scan.SCHEMAS["stats_table"])
    return loaded.select("primary_key", "last_blitz", F.col("fide").cast("double").alias("fide"))


@query("s05_json_info_typed", with_views("SELECT * FROM c_info", "c_info", dates=("joined",)))
def s05_json_info_typed(cat):
    """Info documents unloaded as JSON arrays and loaded back with the declared schema."""
    from quarry.sources import scan
    from quarry.session import scratch
    stage = scratch(cat.spark, "chess-stage")
    scan.unload_json_arrays(cat.c_info, f"{stage}/info")
    return scan.scan_json(cat.spark, f"{stage}/info", scan.SCHEMAS["info_table"])

"""Classifier workload.

``scored`` is a fixed scoring rule over the transactions (prediction =
amount > 9200, score = amount / 10000) so the parsing and metric queries
have an exact SQL oracle. Of the trained-model queries, ids, supports and
ranges are checked exactly (``l02_rows``, ``l04_holdout``, ``l06_holdout``),
the rest on rows. The model trains on a hash-chosen 80% of rows and predicts the other 20%
(hold-out instead of scoring the training table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import ml
from quarry.plans.oracle_views import view, with_views
from quarry.plans.registry import query
from quarry.session import scratch
from quarry.sources import sinks


def scored(cat) -> DataFrame:
    t = cat.b_transactions
    return t.select("transaction_id", F.col("is_flagged").alias("label"),
                    (F.col("amount") > 9200).alias("prediction"),
                    (F.col("amount") / 10000).alias("score"))


view("scored", ("b_transactions",), """
SELECT transaction_id, is_flagged AS label, amount > 9200 AS prediction, amount / 10000 AS score
FROM b_transactions""")


def prediction_objects(cat) -> DataFrame:
    """Rows with a ``predictions`` object as the scoring call returns it."""
    s = scored(cat)
    cls = F.col("prediction").cast("string")
    probs = F.create_map(F.lit("true"), F.col("score"), F.lit("false"), 1 - F.col("score"))
    return s.select("transaction_id", F.struct(cls.alias("class"), probs.alias("probability")).alias("predictions"))


PROB_SQL = "CASE WHEN prediction THEN score ELSE 1 - score END"


@query("l03_parse", with_views(
    f"SELECT transaction_id, CAST(prediction AS VARCHAR) AS class, "
    f"floor(({PROB_SQL}) * 1000 + 0.5) / 1000 AS probability FROM scored", "scored"))
def l03_parse(cat):
    return ml.parse_predictions(prediction_objects(cat))


@query("c11_dynamic_key", with_views(
    f"SELECT transaction_id, {PROB_SQL} AS class_probability FROM scored", "scored"))
def c11_dynamic_key(cat):
    """predictions['probability'][class]: the map key is another field."""
    p = prediction_objects(cat)
    return p.select("transaction_id",
                    F.col("predictions.probability")[F.col("predictions.class")].alias("class_probability"))


@query("l06_confusion", with_views(
    "SELECT label AS actual, prediction AS predicted, count(*) AS n FROM scored GROUP BY ALL", "scored"))
def l06_confusion(cat):
    return ml.confusion(scored(cat))


CLASS_SQL = """
SELECT cls AS class, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
       2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) AS f1,
       tp + fn AS support
FROM (SELECT c.cls,
             count_if(s.label = c.cls AND s.prediction = c.cls) AS tp,
             count_if(s.label != c.cls AND s.prediction = c.cls) AS fp,
             count_if(s.label = c.cls AND s.prediction != c.cls) AS fn
      FROM scored s, (VALUES (true), (false)) c(cls) GROUP BY c.cls)"""


def r6(c):
    return F.floor(F.col(c) * 1000000 + F.lit(0.5)) / 1000000


@query("l04_class_metrics", with_views(
    "SELECT class, " + ", ".join(f"floor({m} * 1000000 + 0.5) / 1000000 AS {m}"
                                 for m in ("precision", "recall", "f1")) + f", support FROM ({CLASS_SQL})",
    "scored"))
def l04_class_metrics(cat):
    m = ml.class_metrics(scored(cat))
    return m.select("class", r6("precision").alias("precision"), r6("recall").alias("recall"),
                    r6("f1").alias("f1"), "support")


GLOBAL_SQL = f"""
WITH cm AS ({CLASS_SQL}),
ranked AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r
           FROM scored),
auc AS (SELECT (sum(CASE WHEN label THEN r END) - count_if(label) * (count_if(label) + 1) / 2.0)
               / (count_if(label) * count_if(NOT label)) AS auc FROM ranked),
rows_ AS (SELECT count_if(label = prediction) / count(*) AS accuracy,
                 -avg(CAST(label AS DOUBLE) * ln(least(greatest(score, 1e-15), 1 - 1e-15))
                      + (1 - CAST(label AS DOUBLE)) * ln(1 - least(greatest(score, 1e-15), 1 - 1e-15))) AS log_loss
          FROM scored),
macro AS (SELECT avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1,
                 sum(precision * support) / sum(support) AS weighted_precision,
                 sum(recall * support) / sum(support) AS weighted_recall,
                 sum(f1 * support) / sum(support) AS weighted_f1 FROM cm)
SELECT {", ".join(f"floor({m} * 1000000 + 0.5) / 1000000 AS {m}" for m in (
    "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1",
    "accuracy", "log_loss", "auc"))}
FROM macro, rows_, auc"""


@query("l05_global_metrics", with_views(f"SELECT * FROM ({GLOBAL_SQL})", "scored"))
def l05_global_metrics(cat):
    g = ml.global_metrics(scored(cat))
    return g.select(*[r6(c).alias(c) for c in g.columns])


#: every fifth of the ids scattered by a fixed multiplier, the same in Spark and DuckDB
TEST_SQL = "CAST(transaction_id AS BIGINT) * 48271 % 2147483647 % 5 = 0"


def holdout(cat) -> tuple[DataFrame, DataFrame]:
    t = cat.b_transactions
    return t.filter(~F.expr(TEST_SQL)), t.filter(F.expr(TEST_SQL))


@query("l01_train")
def l01_train(cat):
    """Train the classifier; returns the model's size and classes."""
    train, _ = holdout(cat)
    model = ml.train(train)
    rf = model.stages[-1]
    return cat.spark.createDataFrame(
        [(rf.getNumTrees, rf.totalNumNodes, ",".join(ml.class_labels(model)))],
        "num_trees int, total_nodes int, classes string")


@query("l01_trained", with_views(
    f"SELECT 20 AS num_trees, string_agg(DISTINCT CAST(is_flagged AS VARCHAR), ',' ORDER BY CAST(is_flagged AS VARCHAR)) "
    f"AS classes, 10 AS num_features, true AS split FROM b_transactions WHERE NOT ({TEST_SQL})", "b_transactions"))
def l01_trained(cat):
    """What is fixed in the trained model: trees, classes, features, and that it splits."""
    train, _ = holdout(cat)
    model = ml.train(train)
    rf = model.stages[-1]
    return cat.spark.createDataFrame(
        [(rf.getNumTrees, ",".join(ml.class_labels(model)), rf.numFeatures, rf.totalNumNodes > rf.getNumTrees)],
        "num_trees int, classes string, num_features int, split boolean")


@query("l02_predict")
def l02_predict(cat):
    """Score the held-out rows; class and rounded probability per row."""
    train, test = holdout(cat)
    model = ml.train(train)
    return ml.parse_predictions(ml.predict(model, test)).select("transaction_id", "is_flagged", "class",
                                                                "probability")


def held_out_predictions(cat) -> DataFrame:
    train, test = holdout(cat)
    return ml.parse_predictions(ml.predict(ml.train(train), test))


@query("l02_rows", with_views(
    f"SELECT transaction_id, is_flagged, true AS scored FROM b_transactions WHERE {TEST_SQL}", "b_transactions"))
def l02_rows(cat):
    """Every held-out row comes back with a known class and a probability."""
    ok = F.col("class").isin("true", "false") & F.col("probability").between(0, 1)
    return held_out_predictions(cat).select("transaction_id", "is_flagged", F.coalesce(ok, F.lit(False)).alias("scored"))


@query("l04_holdout", with_views(
    f"SELECT CAST(is_flagged AS VARCHAR) AS class, count(*) AS support, true AS valid FROM b_transactions "
    f"WHERE {TEST_SQL} GROUP BY ALL", "b_transactions"))
def l04_holdout(cat):
    """Class metrics of the trained model on the held-out rows: support, and
    whether precision, recall and F1 are shares."""
    scored_ = held_out_predictions(cat).withColumn("label", F.col("is_flagged").cast("string"))
    share = F.lit(True)
    for c in ("precision", "recall", "f1"):
        share = share & F.col(c).between(0, 1)
    return ml.class_metrics(scored_, "label", "class").select("class", "support", share.alias("valid"))


@query("l06_holdout", with_views(
    f"SELECT CAST(is_flagged AS VARCHAR) AS actual, count(*) AS n FROM b_transactions WHERE {TEST_SQL} GROUP BY ALL",
    "b_transactions"))
def l06_holdout(cat):
    """Confusion counts of the trained model, summed per actual class."""
    scored_ = held_out_predictions(cat).withColumn("label", F.col("is_flagged").cast("string"))
    return ml.confusion(scored_, "label", "class").groupBy("actual").agg(F.sum("n").alias("n"))


@query("l07_importance")
def l07_importance(cat):
    train, _ = holdout(cat)
    return ml.feature_importance(cat.spark, ml.train(train))


@query("l08_train_log")
def l08_train_log(cat):
    train, _ = holdout(cat)
    return ml.training_log(ml.train(train), train)


#: a seventh of the training ids stops the boosting; every 89th row has no amount and is skipped
VALID_SQL = "CAST(transaction_id AS BIGINT) * 69621 % 2147483647 % 7 = 0"
HOLE_SQL = "CAST(transaction_id AS BIGINT) % 89 = 0"


def boosted(cat) -> ml.Boosted:
    train, _ = holdout(cat)
    return ml.train_boosted(train.withColumn("amount", F.when(~F.expr(HOLE_SQL), F.col("amount"))), F.expr(VALID_SQL))


@query("l08_rounds")
def l08_rounds(cat):
    """The log of boosting rounds: losses, rows and parameters."""
    return boosted(cat).log


@query("l08_rounds_rows", with_views(f"""
SELECT 1 AS first_round, true AS gapless, true AS learnt, count(*) AS rows_in,
       count_if(NOT ({VALID_SQL}) AND NOT ({HOLE_SQL})) AS rows_used,
       count_if({VALID_SQL} AND NOT ({HOLE_SQL})) AS rows_validation, count_if({HOLE_SQL}) AS rows_skipped,
       20 AS max_rounds FROM b_transactions WHERE NOT ({TEST_SQL})""", "b_transactions"))
def l08_rounds_rows(cat):
    """What is fixed in that log: rows given, used, held and skipped, gapless
    rounds within the parameter, a loss below that of the first round."""
    log = boosted(cat).log
    return log.groupBy("rows_in", "rows_used", "rows_validation", "rows_skipped",
                       F.get_json_object("parameters", "$.max_rounds").cast("int").alias("max_rounds")).agg(
        F.min("round").alias("first_round"),
        ((F.max("round") == F.count("round")) & (F.max("round") <= 20)).alias("gapless"),
        ((F.min("train_loss") <= F.min_by("train_loss", "round"))
         & (F.min("validation_loss") <= F.min_by("validation_loss", "round"))).alias("learnt"))


@query("l05_model", with_views(f"""
SELECT count_if(is_flagged) AS p, count_if(NOT is_flagged) AS n, true AS better_than_chance,
       true AS loss_below_prior FROM b_transactions WHERE {TEST_SQL}""", "b_transactions"))
def l05_model(cat):
    """AUC and log loss of the trained model on the held-out rows, against
    chance and against the flat rate of those rows."""
    train, test = holdout(cat)
    pred = ml.predict(ml.train(train), test).select(
        "is_flagged", F.col("predictions.probability")["true"].alias("score"),
        (F.col("predictions.class") == "true").alias("prediction"))
    kept = sinks.ctas(pred, scratch(cat.spark, "model-scores"))
    a = ml.auc(kept, "is_flagged", "score").selectExpr(
        "stack(3, 'p', CAST(p AS DOUBLE), 'n', CAST(n AS DOUBLE), 'auc', auc) AS (k, v)")
    y, s = F.col("is_flagged").cast("double"), F.least(F.greatest("score", F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = kept.agg((-F.avg(y * F.log(s) + (1 - y) * F.log(1 - s))).alias("loss"), F.avg(y).alias("r")).selectExpr(
        "stack(2, 'loss', loss, 'prior', -(r * ln(r) + (1 - r) * ln(1 - r))) AS (k, v)")
    m = a.unionByName(loss)
    g = m.groupBy().pivot("k", ["p", "n", "auc", "loss", "prior"]).agg(F.first("v"))
    return g.select(F.col("p").cast("long").alias("p"), F.col("n").cast("long").alias("n"),
                    (F.col("auc") > 0.6).alias("better_than_chance"),
                    (F.col("loss") < F.col("prior")).alias("loss_below_prior"))


@query("l09_text")
def l09_text(cat):
    """Text classification of documents against their quality labels;
    every document is scored, labelled or not."""
    docs = cat.table("documents")
    labelled = docs.join(cat.table("labels"), "doc_id").select(
        "doc_id", "text", F.col("quality").cast("double").alias("label"))
    model = ml.text_classifier(labelled)
    from pyspark.ml.functions import vector_to_array
    out = model.transform(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("prediction").cast("int").alias("predicted_quality"),
                      vector_to_array("probability")[1].alias("p_quality"))

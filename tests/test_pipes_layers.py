"""JSON pipes into declared tables; written layers and their reject table."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.operators import layers
from quarry.streaming.pipes import REASON, JsonPipe

DDL = "id long, joined date, name string"


def land(pipe, name, text):
    os.makedirs(pipe.landing, exist_ok=True)
    with open(f"{pipe.landing}/{name}", "w") as f:
        f.write(text)


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_elements_that_do_not_fit_are_rejected_alone(spark, tmp_path):
    pipe = JsonPipe(spark, str(tmp_path), StructType.fromDDL(DDL), {"id": "ID"})
    land(pipe, "a.json", '[{"ID": 1, "joined": "2020-01-31", "name": "x"}, {"ID": "one", "joined": "soon"}, 7, null]\n'
                         '{"ID": 2, "name": null, "more": [1]}\n\n[]\n{"ID": 3\n{"id": 4}\n')
    pipe.refresh()
    assert rows(pipe.table().drop("joined", "run_id")) == ["(1, 'x')", "(2, None)", "(None, None)"]
    assert pipe.table().filter("id = 1").select(F.col("joined").cast("string")).first()[0] == "2020-01-31"
    got = {r.record: tuple(r[REASON]) for r in pipe.rejected().collect()}
    assert got.pop('{"ID":"one","joined":"soon"}') == ("id", "joined")
    assert got == {"7": ("not an object",), "null": ("not an object",), '{"ID": 3': ("not an object",)}


def test_a_landed_file_is_loaded_once_and_new_ones_by_the_next_run(spark, tmp_path):
    pipe = JsonPipe(spark, str(tmp_path), StructType.fromDDL(DDL))
    land(pipe, "a.json", '{"id": 1}\n')
    pipe.refresh()
    pipe.refresh()
    land(pipe, "b.json", '[{"id": 2}, {"id": 3}]\n')
    pipe.refresh()
    assert rows(pipe.table().select("id", "run_id")) == ["(1, 1)", "(2, 3)", "(3, 3)"]
    pipe._batch(spark.createDataFrame([('{"id": 9}', "f")], "value string, _file string"), 1)  # batch 1 again
    assert rows(pipe.table().select("id")) == ["(1,)", "(9,)"]


def test_documents_over_several_lines(spark, tmp_path):
    pipe = JsonPipe(spark, str(tmp_path), StructType.fromDDL(DDL), whole_files=True)
    land(pipe, "a.json", '[\n  {"id": 1,\n   "name": "a"},\n  {"id": 2}\n]\n')
    pipe.refresh()
    assert rows(pipe.table().select("id", "name")) == ["(1, 'a')", "(2, None)"] and pipe.rejected().count() == 0


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(
        [("1", " 10 ", "a", 1), ("1", "11", "b", 2), ("1", "bad", "c", 3), ("2", "x", "d", 1), (None, None, " e ", 1),
         (None, "5", "f", 1), ("3", "7", "z", None), ("3", "8", "y", None)], "k string, n string, t string, s long")


def test_layers_are_written_and_a_second_run_replaces_them(spark, raw, tmp_path):
    schema = StructType.fromDDL("k string, n int, t string")
    for _ in range(2):
        wh = layers.write_layers(raw, schema, "k", "s", str(tmp_path / "w"), {
            "total": lambda c: c.agg(F.sum("n").alias("n")), "rows": lambda c: c.agg(F.count("*").alias("n"))})
    read = spark.read.parquet
    assert read(wh.raw).count() == 8
    assert rows(read(wh.cleansed)) == ["('1', 11, 'b')", "('3', 8, 'y')", "(None, 5, 'f')"]
    assert rows(read(wh.rejects).select("k", "n", layers.REASON)) == ["('1', 'bad', ['n'])", "('2', 'x', ['n'])"]
    assert read(wh.report("total")).first().n == 24 and read(wh.report("rows")).first().n == 3


def test_layers_of_variant_columns_and_empty_input(spark, tmp_path):
    schema = StructType.fromDDL("k string, v variant, d date")
    raw = spark.createDataFrame([("1", '{"a":1}', "2020-02-30", 1), ("1", '{"a":2}', "2020-02-28", 2),
                                 ("1", '{"a":3}', None, 1)], "k string, j string, d string, s long") \
        .withColumn("v", F.parse_json("j"))
    lay = layers.cleanse(raw, schema, "k", "s")
    assert lay.cleansed.select("k", F.to_json("v")).collect() == [("1", '{"a":2}')]
    assert lay.rejects.select(layers.REASON).first()[0] == ["d"]
    wh = layers.write_layers(raw.limit(0), schema, "k", "s", str(tmp_path / "e"), {})
    assert spark.read.parquet(wh.cleansed).count() == 0 and spark.read.parquet(wh.rejects).columns[-1] == layers.REASON


def test_a_hot_key_is_reduced_before_the_shuffle(raw):
    lay = layers.cleanse(raw, StructType.fromDDL("k string, n int, t string"), "k", "s")
    plan = lay.cleansed._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan

"""Inputs that must not lose rows: header lines, null tokens, escapes, rejects, unlabelled scoring."""

import pytest


def test_skip_header_lines_by_position(spark, tmp_path):
    from quarry.sources.scan import CsvFormat, read_csv
    for k in range(2):
        (tmp_path / f"{k}.csv").write_text(f"h1,x\nh2,y\n{k},a\nh2,y\n")
    df = read_csv(spark, str(tmp_path), CsvFormat(skip_header=2))
    assert sorted(tuple(r) for r in df.collect()) == [("0", "a"), ("1", "a"), ("h2", "y"), ("h2", "y")]


@pytest.mark.parametrize("tokens", [("NULL",), ("NULL", "na")])
def test_null_tokens_in_typed_columns(spark, tmp_path, tokens):
    from pyspark.sql.types import IntegerType, StructField, StructType
    from quarry.sources.scan import CsvFormat, read_csv
    (tmp_path / "a.csv").write_text(f"1,{tokens[-1]}\n2,3\nx,4\n")
    schema = StructType([StructField("a", IntegerType()), StructField("b", IntegerType())])
    df = read_csv(spark, str(tmp_path), CsvFormat(null_if=tokens), schema, "_bad")
    got = {(r.a, r.b, r._bad is not None) for r in df.collect()}
    assert {(1, None, False), (2, 3, False)} <= got and any(bad for _, _, bad in got)


def test_escaped_round_trip(spark, tmp_path):
    from quarry.sources.scan import CsvFormat, scan_escaped, write_escaped
    rows = [("a,b", "x\\"), ("id_7", None), ("", "\\,"), ("\\N", "N")]
    fmt = CsvFormat(escape_unenclosed="\\", skip_header=1)
    write_escaped(spark.createDataFrame(rows, "id string, v string"), str(tmp_path / "e"), fmt)
    got = scan_escaped(spark, str(tmp_path / "e"), fmt, ["id", "v"])
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, rows))


def test_metrics_of_a_class_never_predicted(spark):
    from quarry.operators import ml
    df = spark.createDataFrame([(True, False, 0.2), (False, False, 0.1)], "label boolean, prediction boolean, score double")
    got = {r["class"]: r for r in ml.class_metrics(df).collect()}
    assert got[True].precision == 0 and got[True].f1 == 0 and got[False].recall == 1
    assert ml.auc(df.filter("label"), "label", "score").first().auc is None


def test_rejects_keep_padded_and_null_keys(spark):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    from quarry.operators.layers import cleanse
    raw = spark.createDataFrame([(" 1 ", "x", 1), (None, "y", 2), ("3", "4", 3)], "k string, n string, s long")
    lay = cleanse(raw, StructType([StructField("k", StringType()), StructField("n", IntegerType())]), "k", "s")
    assert lay.rejects.count() == 2 and lay.cleansed.count() == 1


def test_unload_round_trip_keeps_spaces_quotes_and_line_ends(spark, tmp_path):
    from quarry.sources import sinks
    rows = [("1", "  padded "), ("2", "two\nlines"), ("3", 'a "quote", and \\'), ("4", None)]
    df = spark.createDataFrame(rows, "id string, v string")
    path = sinks.unload_csv(df, str(tmp_path / "u"))
    back = spark.read.options(**sinks.GZIP_CSV.reader_options()).schema(df.schema).csv(path)
    assert sorted(map(tuple, back.collect())) == rows


@pytest.mark.parametrize("table, column", [("accounts", "credit_limit"), ("transactions", "location_city")])
def test_generated_csv_compares_every_column(cat, monkeypatch, table, column):
    from quarry.plans import w_generate
    assert {r.table_name for r in w_generate.g06_csv(cat).collect()} == {
        "customers", "credit_data", "transactions", "watchlist"}
    unload = w_generate.sinks.unload_csv

    def lossy(df, path):
        return unload(df.withColumn(column, df[column].substr(2, 9)) if path.endswith(table) else df, path)
    monkeypatch.setattr(w_generate.sinks, "unload_csv", lossy)
    with pytest.raises(ValueError, match=table):
        w_generate.g06_csv(cat)


def test_empty_strings_and_nulls_stay_apart_in_csv(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    from quarry.sources import sinks
    from quarry.sources.scan import read_csv
    schema = StructType([StructField("k", IntegerType()), StructField("s", StringType()), StructField("n", IntegerType())])
    rows = [(1, "", 1), (2, None, None), (3, " ", 3), (4, '"', None), (None, "a,b\n", 5)]
    path = sinks.unload_csv(spark.createDataFrame(rows, schema), str(tmp_path / "u"))
    for read in (schema, None):
        got = read_csv(spark, path, sinks.GZIP_CSV, read)
        assert {(r[0] and int(r[0]), r[1], r[2] and int(r[2])) for r in got.collect()} == set(rows)
    assert not any(r._bad for r in read_csv(spark, path, sinks.GZIP_CSV, schema, "_bad").collect())


def test_accounts_open_between_the_customer_and_today(spark):
    import datetime as dt
    from quarry.operators import generate as gen
    c = gen.customers(spark.range(300).withColumnRenamed("id", "c_custkey"))
    rows = gen.accounts(c).join(c.select("customer_id", "customer_since"), "customer_id").collect()
    assert all(r.customer_since <= r.open_date <= dt.date.fromisoformat(gen.TODAY) for r in rows)
    assert len({r.open_date for r in rows}) > 100


def test_provenance_names_every_document_of_sixteen_keys(spark, cat):
    from pyspark.sql import functions as F
    from quarry.plans import registry, w_person  # noqa: F401
    docs = cat.persons.select("c_nationkey", F.floor(F.col("c_custkey") / 16)).distinct().count()
    files = cat.persons.select("c_nationkey", F.floor(F.col("c_custkey") / 2048)).distinct().count()
    got = registry.QUERIES["s17_provenance"](cat)
    assert got.count() == got.distinct().count() == docs > files
    assert got.select("filename").distinct().count() == files

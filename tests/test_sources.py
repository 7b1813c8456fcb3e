import hashlib

import pytest
from frames import six_rows
from pyspark.sql import functions as F

from offerlens.contract import NULL_TOKENS, RAW_COLUMNS
from offerlens.functions.scalars import null_tokens, to_numeric
from offerlens.operators import columns as C
from offerlens.operators import gates as G
from offerlens.sources import files


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


def test_delimited_file_with_mark_blanks_and_tokens(spark, tmp_path):
    path = write(tmp_path / "a.csv", " MES ;X;Y; FLAG_VENTA\n1;NA;a;0\n2;3.5;;1\n", "utf-8-sig")
    table = files.read_delimited(spark, path)
    assert table.dtypes == [("MES", "bigint"), ("X", "double"), ("Y", "string"), ("FLAG_VENTA", "bigint")]
    assert [tuple(r) for r in table.orderBy("MES").collect()] == [(1, None, "a", 0), (2, 3.5, None, 1)]


def test_types_follow_the_data(spark, tmp_path):
    path = write(tmp_path / "a.csv", "i;g;d;t;e;big\n1;1;1.5;x;;9999999999999999999\n-2;;2;7;;1\n")
    kinds = files.infer_types(files.read_text_table(spark, path))
    assert kinds == {"i": "bigint", "g": "double", "d": "double", "t": "string", "e": "double", "big": "double"}


def test_declared_types_turn_bad_text_into_null(spark, tmp_path):
    path = write(tmp_path / "a.csv", "n;t\nabc;x\n4;y\n")
    rows = files.read_delimited(spark, path, {"n": "bigint", "t": "string"}).collect()
    assert [tuple(r) for r in rows] == [(None, "x"), (4, "y")]


def test_a_row_beyond_the_header_is_an_error(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a;b\n1;2\n3\n")
    assert sorted(map(tuple, files.read_text_table(spark, path).collect())) == [("1", "2"), ("3", None)]
    path = write(tmp_path / "b.csv", "a;b\n1;2;3\n")
    with pytest.raises(Exception, match="more than 2 cells"):
        files.read_text_table(spark, path).select("a").collect()


def test_quoted_line_breaks(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a;b\n"x\ny";2\n')
    assert [tuple(r) for r in files.read_text_table(spark, path, multi_line=True).collect()] == [("x\ny", "2")]


def test_missing_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_delimited(spark, str(tmp_path / "absent.csv"))
    assert files.read_document(spark, str(tmp_path / "absent.json"), "a int").isEmpty()


def test_every_token_is_missing(spark):
    texts = [(t,) for t in (*NULL_TOKENS, "x", " NA", "na")]
    left = spark.createDataFrame(texts, "t string").select(null_tokens(F.col("t")).alias("t")).where("t is not null")
    assert {r["t"] for r in left.collect()} == {"x", " NA", "na"}


def test_to_numeric_keeps_numbers_only(spark):
    table = spark.createDataFrame([("1.5",), ("abc",), ("NaN",), (None,), ("",), ("-2e2",)], "t string")
    assert [r[0] for r in table.select(to_numeric(F.col("t"))).collect()] == [1.5, None, None, None, None, -200.0]


def test_written_table_reads_back_equal(spark, tmp_path):
    table = six_rows(spark)
    files.write_delimited(table, str(tmp_path / "t"))
    back = files.read_delimited(spark, str(tmp_path / "t"), RAW_COLUMNS)
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))


def test_file_hash_equals_md5(spark, tmp_path):
    path = write(tmp_path / "a.csv", "x;y\n1;2\n")
    row = files.file_manifest(spark, path).first()
    assert row["md5"] == hashlib.md5((tmp_path / "a.csv").read_bytes()).hexdigest()


def test_manifest_skips_absent_artifacts(spark, tmp_path):
    files.write_delimited(six_rows(spark), str(tmp_path / "one"))
    write(tmp_path / "two.json", "{}")
    rows = files.artifact_manifest(spark, str(tmp_path), ["one", "two.json", "absent"]).collect()
    assert {r["name"] for r in rows} == {"one", "two.json"}


def test_fingerprint_ignores_order_and_partitions_but_not_content(spark):
    table = six_rows(spark)
    same = table.orderBy(F.desc("CLIENTE")).repartition(5)
    other = table.withColumn("EDAD", F.col("EDAD") + 1)
    first = files.table_fingerprint(table).first()
    assert first == files.table_fingerprint(same).first()
    assert first != files.table_fingerprint(other).first()
    doubled = files.table_fingerprint(table.union(table)).first()
    assert doubled["fingerprint"] == str(2 * int(first["fingerprint"]))


def test_fingerprint_tells_cells_and_small_differences_apart(spark):
    def of(rows, shape):
        return files.table_fingerprint(spark.createDataFrame(rows, shape)).first()["fingerprint"]

    assert of([("a|b", "c")], "x string, y string") != of([("a", "b|c")], "x string, y string")
    assert of([(None,)], "x string") != of([("-",)], "x string")
    assert of([(1.0,)], "x double") != of([(1.0000000001,)], "x double")


def test_folder_hash_covers_every_file(spark, tmp_path):
    one = write(tmp_path / "a.csv", "x;y\n1;2\n")
    digest = spark.range(1).select(files.content_md5(spark, one)).first()[0]
    assert digest == hashlib.md5((tmp_path / "a.csv").read_bytes()).hexdigest()
    write(tmp_path / "b.csv", "x;y\n3;4\n")
    assert spark.range(1).select(files.content_md5(spark, str(tmp_path))).first()[0] != digest


def test_json_rows_write_null_for_missing(spark):
    table = spark.createDataFrame([(1, float("nan"), None)], "i bigint, d double, t string")
    assert C.json_rows(table).first()[0] == '{"i":1,"d":null,"t":null}'


def test_document_round_trip(spark, tmp_path):
    files.write_document(spark.createDataFrame([("a", 1.5), ("b", float("nan"))], "k string, v double"), str(tmp_path / "d"))
    back = files.read_document(spark, str(tmp_path / "d"), "k string, v double")
    assert {tuple(r) for r in back.collect()} >= {("a", 1.5)}


def test_names(spark):
    table = spark.createDataFrame([(1, 2)], "`﻿MES ` int, ` FLAG_VENTA` int")
    assert C.clean_column_names(table).columns == ["MES", "FLAG_VENTA"]
    assert "Uso_Linea" in C.rename_columns(six_rows(spark)).columns
    assert C.drop_columns(table, ["absent"]).columns == table.columns


def test_dataset_gate(spark):
    G.enforce(G.dataset_gate(six_rows(spark)))
    with pytest.raises(G.GateError, match="required_columns: FLAG_VENTA"):
        G.enforce(G.dataset_gate(six_rows(spark).drop("FLAG_VENTA")))
    with pytest.raises(G.GateError, match="not_empty"):
        G.enforce(G.dataset_gate(six_rows(spark).limit(0)))
    with pytest.raises(G.GateError, match="several_columns"):
        G.enforce(G.dataset_gate(spark.createDataFrame([("a",)], "`MES;CLIENTE` string")))


def test_digests_of_files_beyond_the_limit_of_whole_reads(spark, tmp_path):
    contents = {"a.bin": b"a", "b c.bin": bytes(range(256)) * 20_000, "d%20\u00e9.bin": b"x" * (3 * (1 << 20) + 1)}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "100")
    try:
        rows = files.file_manifest(spark, str(tmp_path)).collect()
        whole = spark.range(1).select(files.content_md5(spark, str(tmp_path / "b c.bin"))).first()[0]
    finally:
        spark.conf.unset(limit)
    assert {r["md5"]: r["length"] for r in rows} == {hashlib.md5(c).hexdigest(): len(c) for c in contents.values()}
    assert whole == hashlib.md5(contents["b c.bin"]).hexdigest()


def test_documents_with_different_fields_are_read_as_variants(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "one.json").write_text('{"k":1,"n":{"x":2,"y":[3,null]},"z":null,"t":"q","e":{}}\n\n')
    (tmp_path / "a" / "b" / "two.json").write_text('{"k":2,"n":1.50,"deep":{"a":{"b":{"c":1}}}}\n[]\n7\n')
    documents = files.read_variants(spark, str(tmp_path / "a"))
    assert documents.count() == 4
    keyed = documents.select(F.try_variant_get("document", "$.k", "long").alias("k"), "document")
    got = {tuple(r) for r in files.variant_fields(keyed).collect()}
    assert got == {
        (1, "k", "1"), (1, "n.x", "2"), (1, "n.y.0", "3"), (1, "n.y.1", None), (1, "z", None), (1, "t", "q"), (1, "e", "{}"),
        (2, "k", "2"), (2, "n", "1.5"), (2, "deep.a.b", '{"c":1}')}
    assert files.read_variants(spark, str(tmp_path / "absent")).isEmpty()

import io

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from catalog_star.schemas import NA_TOKENS
from catalog_star.sinks.files import export_tables, write_csv, write_table
from catalog_star.sinks.warehouse import FolderWarehouse, JdbcWarehouse, LoadCount, insert_ignore
from catalog_star.sources.csv import probe_csv, read_csv, read_csv_text
from catalog_star.sources.jdbc import JdbcConnection, Split, query_options, table_options

SCHEMA = StructType([StructField("a", LongType()), StructField("b", StringType()), StructField("c", DoubleType())])


def written(tmp_path, content, encoding="utf-8"):
    path = tmp_path / "in.csv"
    path.write_bytes(content.encode(encoding))
    return str(path)


def cells(df):
    return [tuple(r) for r in df.collect()]


def layouts(spark, path):
    return [(x.encoding, x.multiline) for x in probe_csv(spark, path)]


def test_quotes_line_breaks_and_blank_lines(spark, tmp_path):
    content = 'a,b,c\n1,"x ""q"" y",1.5\n\n2,"line\nbreak, and comma",2\n3, padded ,\n'
    path = written(tmp_path, content)
    assert layouts(spark, path) == [("UTF-8", True)]
    wanted = pd.read_csv(io.StringIO(content))
    found = cells(read_csv(spark, path, SCHEMA))
    assert found == [(1, 'x "q" y', 1.5), (2, "line\nbreak, and comma", 2.0), (3, " padded ", None)]
    assert [r[1] for r in found] == wanted["b"].tolist()


def test_splittable_when_no_record_spans_lines(spark, tmp_path):
    assert layouts(spark, written(tmp_path, 'a,b\n1,"x ""q"" y"\n')) == [("UTF-8", False)]


def test_latin1_fallback(spark, tmp_path):
    path = written(tmp_path, "a,b,c\n1,Beyoncé,2\n", "latin-1")
    assert layouts(spark, path) == [("ISO-8859-1", False)]
    assert cells(read_csv(spark, path, SCHEMA)) == [(1, "Beyoncé", 2.0)]


def test_missing_value_tokens(spark, tmp_path):
    words = [*NA_TOKENS, "Nan", "-", "x", " NA", "none", '"NA"', '""']
    content = "a,b,c\n" + "".join(f"{i},{w},1\n" for i, w in enumerate(words))
    wanted = pd.read_csv(io.StringIO(content))["b"]
    found = [r[1] for r in cells(read_csv(spark, written(tmp_path, content), SCHEMA))]
    assert found == [None if pd.isna(x) else x for x in wanted]


def test_bad_lines(spark, tmp_path):
    content = "a,b,c\n1,2\n1,2,3,4\n5,6,7\n"
    path = written(tmp_path, content)
    assert cells(read_csv_text(spark, path, bad_lines="skip")) == [("1", "2", None), ("5", "6", "7")]
    with pytest.raises(PySparkException, match="more than 3 fields"):
        read_csv_text(spark, path).collect()
    with pytest.raises(ValueError):
        read_csv_text(spark, path, bad_lines="warn")


def test_types_index_and_missing_columns(spark, tmp_path):
    path = written(tmp_path, ",c,a,b\n10,1.5,4.0,x\n11,bad,7,y\n")
    schema = StructType([StructField("o", LongType()), *SCHEMA.fields])
    assert cells(read_csv(spark, path, schema, order="o")) == [(10, 4, "x", 1.5), (11, 7, "y", None)]
    flags = written(tmp_path, "f\nTrue\nFALSE\n\"\"\n")
    assert cells(read_csv(spark, flags, StructType([StructField("f", BooleanType())]))) == [(True,), (False,), (None,)]
    with pytest.raises(ValueError, match="lacks"):
        read_csv(spark, path, StructType([StructField("zz", LongType())]))


def test_files_of_one_folder_are_read_each_by_itself(spark, tmp_path):
    for name, content, encoding in (
        ("1.csv", "a,b,c\n1,Beyoncé,1\n2,x,2\n", "utf-8"),
        ("2.csv", "a,b,c\n3,Zoë,3\n", "latin-1"),
        ("3.csv", 'c,b,a\n4,"two\nlines",4\n', "utf-8"),
        ("4.csv", "c,a\n5,5\n", "utf-8"),
    ):
        (tmp_path / name).write_text(content, encoding=encoding)
    schema = StructType([StructField("o", LongType()), *SCHEMA.fields])
    found = sorted(cells(read_csv(spark, str(tmp_path), schema, order="o")))
    assert found == [(0, 1, "Beyoncé", 1.0), (1, 2, "x", 2.0), (2, 3, "Zoë", 3.0), (3, 4, "two\nlines", 4.0), (4, 5, None, 5.0)]
    assert len(probe_csv(spark, str(tmp_path))) == 4


def test_files_with_an_index_each_get_one_order(spark, tmp_path):
    for name in ("1.csv", "2.csv"):
        (tmp_path / name).write_text(",a,b,c\n0,1,x,1\n1,2,y,1\n")
    schema = StructType([StructField("o", LongType()), *SCHEMA.fields])
    assert [r[:2] for r in sorted(cells(read_csv(spark, str(tmp_path), schema, order="o")))] == [(0, 1), (1, 2), (2, 1), (3, 2)]


def test_cells_lost_to_casts_are_counted(spark, tmp_path):
    from catalog_star.operators.quality import Audit

    path, audit = written(tmp_path, "a,b,c\nabc,x,1\n4.7,y,z\n4.0,NA,\n"), Audit(spark)
    assert cells(read_csv(spark, path, SCHEMA, audit=audit)) == [(None, "x", 1.0), (None, "y", None), (4, None, None)]
    assert audit.figures()["csv: cells lost to casts"] == {"a": 2, "b": 0, "c": 1}


def test_csv_written_like_a_data_frame_library(spark, tmp_path):
    data = [(1, " pad ", True, 1.5), (2, None, False, None), (3, 'q"q', None, 2.0), (4, "a,b\nc", True, 0.1)]
    df = spark.createDataFrame(data, "i long, s string, f boolean, d double").coalesce(1)
    write_csv(df, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("*.csv")))
    wanted = pd.DataFrame(data, columns=["i", "s", "f", "d"]).to_csv(index=False)
    assert text == wanted


def test_export(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    export_tables({"x": df, "y": df}, str(tmp_path), "parquet")
    assert spark.read.parquet(str(tmp_path / "y")).count() == 1
    with pytest.raises(ValueError):
        write_table(df, str(tmp_path / "z"), "xml")


def test_jdbc_options(monkeypatch):
    monkeypatch.setenv("CATALOG_DB_USER", "u")
    monkeypatch.setenv("CATALOG_DB_PASSWORD", "p")
    place = JdbcConnection("db.host", "awards")
    assert place.url == "jdbc:mysql://db.host:3306/awards"
    assert table_options(place, "t", Split("id", 1, 100, 8)) == {
        "url": place.url, "driver": place.driver, "user": "u", "password": "p", "dbtable": "t",
        "fetchsize": "10000", "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "8",
    }
    assert query_options(place, "SELECT * FROM t;")["query"] == "SELECT * FROM t"
    house = JdbcWarehouse(None, place, {"t": Split("id", 1, 100, 8)}, connections=4)
    assert house.read_options("t")["numPartitions"] == "8" and "numPartitions" not in house.read_options("small")
    assert house.write_options("t")["numPartitions"] == "4" and house.write_options("t")["batchsize"] == "10000"
    monkeypatch.delenv("CATALOG_DB_PASSWORD")
    assert "password" not in place.options()


def test_insert_ignore_keeps_what_is_there_and_the_first_new_row(spark, tmp_path):
    house = FolderWarehouse(spark, str(tmp_path))
    assert house.read("t") is None
    house.replace(spark.createDataFrame([(1, "old")], "k long, v string"), "t")
    offered = spark.createDataFrame([(1, "new", 0), (2, "second", 5), (2, "first", 4), (3, "x", 1)], "k long, v string, o int")
    assert insert_ignore(offered, house, "t", "k", order="o") == LoadCount("t", 4, 2)
    assert sorted(cells(house.read("t"))) == [(1, "old"), (2, "first"), (3, "x")]


def test_only_a_missing_table_counts_as_missing(spark, tmp_path):
    broken = tmp_path / "t"
    broken.mkdir()
    (broken / "part.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        FolderWarehouse(spark, str(tmp_path)).read("t")

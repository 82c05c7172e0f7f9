import pytest

from batchgauge.config import SourceSpec
from batchgauge.sources import readers


def spec(path, **more):
    return SourceSpec("file", {"path": str(path), **more})


def test_source_name_is_case_insensitive_and_unknown_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amount\n1,2.5\n2,3.5\n")
    assert readers.fetch(spark, SourceSpec("FILE", {"path": str(tmp_path / "a.csv")}), "2024-01-01").count() == 2
    with pytest.raises(ValueError, match="no reader for 'mongodb'.*'file'.*'mysql'"):
        readers.fetch(spark, SourceSpec("mongodb"), "2024-01-01")


def test_csv_tsv_and_parquet(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amount,risk\n1,2.5,0.1\n2,3.5,0.2\n")
    (tmp_path / "a.tsv").write_text("id\tname\n1\tx,y\n")
    csv = readers.fetch(spark, spec(tmp_path / "a.csv"), "2024-01-01")
    assert csv.columns == ["id", "amount", "risk"] and csv.schema["amount"].dataType.simpleString() == "double"
    assert readers.fetch(spark, spec(tmp_path / "a.tsv"), "2024-01-01").collect()[0]["name"] == "x,y"
    csv.write.parquet(str(tmp_path / "b.parquet"))
    assert readers.fetch(spark, spec(tmp_path / "b.parquet"), "2024-01-01").count() == 2


def test_explicit_schema_needs_no_inference(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amount\n007,2\n")
    row = readers.fetch(spark, spec(tmp_path / "a.csv", schema="id string, amount double"), "2024-01-01").head()
    assert (row["id"], row["amount"]) == ("007", 2.0)


def test_date_in_path(spark, tmp_path):
    (tmp_path / "data_2024-01-02.csv").write_text("id,val\n1,9\n")
    got = readers.fetch(spark, spec(tmp_path / "data_{run_date}.csv"), "2024-01-02").head()
    assert got["val"] == 9


def test_query_field_serves_as_path(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n")
    assert readers.fetch(spark, SourceSpec("file", query=str(tmp_path / "a.csv")), "2024-01-02").count() == 1


def test_file_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no such path"):
        readers.fetch(spark, spec(tmp_path / "absent.csv"), "2024-01-02")
    (tmp_path / "a.xlsx").write_text("x")
    with pytest.raises(ValueError, match="not in '.xlsx'"):
        readers.fetch(spark, spec(tmp_path / "a.xlsx"), "2024-01-02")
    with pytest.raises(ValueError, match="connection.path"):
        readers.fetch(spark, SourceSpec("file"), "2024-01-02")


def test_sql_date_is_a_parameter(spark):
    spark.sql("SELECT 1 AS id, DATE '2024-01-02' AS d UNION ALL SELECT 2, DATE '2024-01-03'").createOrReplaceTempView("t_src")
    query = "SELECT id FROM t_src WHERE d = '{run_date}'"
    assert [r["id"] for r in readers.fetch(spark, SourceSpec("sql", query=query), "2024-01-03").collect()] == [2]
    with pytest.raises(ValueError):
        readers.fetch(spark, SourceSpec("sql", query=query), "2024-01-03' OR '1'='1")
    with pytest.raises(ValueError, match="without a query"):
        readers.fetch(spark, SourceSpec("sql"), "2024-01-03")


def test_sql_without_date_and_with_braces(spark):
    query = "SELECT 'x{y}' AS s"
    assert readers.fetch(spark, SourceSpec("sql", query=query), "2024-01-03").head()["s"] == "x{y}"


def test_sql_filter_reaches_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "date_add(DATE '2024-01-01', cast(id as int)) AS d").write.parquet(str(tmp_path / "t"))
    spark.read.parquet(str(tmp_path / "t")).createOrReplaceTempView("t_push")
    df = readers.fetch(spark, SourceSpec("sql", query="SELECT id FROM t_push WHERE d = '{run_date}'"), "2024-01-03")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(d,2024-01-03)" in plan


def test_jdbc_options():
    plain = SourceSpec("mysql", {"host": "db", "port": 3307, "database": "w", "user": "u"},
                       "SELECT * FROM t WHERE d = '{run_date}';")
    got = readers.jdbc_options(plain, "2024-01-02")
    assert got == {"url": "jdbc:mysql://db:3307/w", "user": "u", "query": "SELECT * FROM t WHERE d = '2024-01-02'"}
    split = SourceSpec("jdbc", {"url": "jdbc:x", "partitionColumn": "id", "lowerBound": 0, "upperBound": 9,
                                "numPartitions": 3}, "SELECT * FROM t")
    got = readers.jdbc_options(split, "2024-01-02")
    assert got["dbtable"] == "(SELECT * FROM t) batch" and got["numPartitions"] == "3" and "query" not in got
    with pytest.raises(ValueError, match="without a query"):
        readers.jdbc_options(SourceSpec("mysql"), "2024-01-02")


def test_object_store_needs_both_fields(spark):
    with pytest.raises(ValueError, match="bucket"):
        readers.fetch(spark, SourceSpec("s3", bucket="b"), "2024-01-02")


def test_templated_sources():
    assert readers.is_templated(SourceSpec("file", {"path": "a_{run_date}.csv"}))
    assert not readers.is_templated(SourceSpec("file", {"path": "a.csv"}))

import pytest
from pyspark.sql import Column

from quarry.functions.expressions import as_column, bind_run_date, pyspark_expression, substitute_run_date


def test_pyspark_expression_builds_columns(spark):
    df = spark.createDataFrame([(1, "a"), (5, "b")], "x int, s string")
    cond = pyspark_expression("(F.col('x') > 2) & (F.col('s') != F.lit('a'))")
    assert isinstance(cond, Column)
    assert [r.x for r in df.filter(cond).collect()] == [5]
    col = pyspark_expression("F.upper(F.col('s')).alias('u')")
    assert [r.u for r in df.select(col).collect()] == ["A", "B"]
    assert df.select(pyspark_expression("F.col('x').cast(T.StringType())")).schema[0].dataType.typeName() == "string"


@pytest.mark.parametrize(
    "text",
    ["__import__('os').system('true')", "F.col('x').__class__", "open('/etc/passwd')", "[c for c in 'ab']"],
)
def test_pyspark_expression_rejects_code(text):
    with pytest.raises((ValueError, AttributeError, TypeError)):
        pyspark_expression(text)


def test_as_column_forms(spark):
    df = spark.createDataFrame([(2,)], "x int")
    assert df.select(as_column({"expr": "x * 3"}).alias("y")).first().y == 6
    assert df.select(as_column("x + 1").alias("y")).first().y == 3
    assert df.select(as_column("F.col('x') * 2").alias("y")).first().y == 4


def test_bind_run_date_spellings():
    assert bind_run_date("a >= '${run_date}'", "2024-01-02") == ("a >= :run_date", {"run_date": "2024-01-02"})
    assert bind_run_date("a >= {$run_date}", "2024-01-02") == ("a >= :run_date", {"run_date": "2024-01-02"})
    assert bind_run_date("a >= :run_date", 7) == ("a >= :run_date", {"run_date": 7})
    assert bind_run_date("select 1", "2024-01-02") == ("select 1", {})
    text, args = bind_run_date("select * from t_${run_date}", "20240102")
    assert text == "select * from t_20240102" and args == {}
    assert bind_run_date("x = '${run_date}'", None) == ("x = '${run_date}'", {})


def test_parameter_binding_in_spark(spark):
    text, args = bind_run_date("SELECT DATE'2024-01-03' > '{$run_date}' AS later", "2024-01-02")
    assert spark.sql(text, args=args).first().later is True


def test_substitute_for_source_sql():
    assert substitute_run_date("(select * from t where d = '${run_date}') q", "2024-01-02") == (
        "(select * from t where d = '2024-01-02') q"
    )


def test_placeholders_in_typed_and_longer_literals(spark):
    text, args = bind_run_date("SELECT DATE '${run_date}' AS d, TIMESTAMP_NTZ '{$run_date}' AS t", "2024-01-02")
    assert text == "SELECT CAST(:run_date AS DATE) AS d, CAST(:run_date AS TIMESTAMP_NTZ) AS t"
    row = spark.sql(text, args=args).first()
    assert str(row.d) == "2024-01-02" and str(row.t) == "2024-01-02 00:00:00"
    # part of a longer literal: substituted as text, never turned into a parameter
    text, args = bind_run_date("SELECT '${run_date} 12:00' AS s, 'x' LIKE '%{$run_date}%' AS m", "2024-01-02")
    assert text == "SELECT '2024-01-02 12:00' AS s, 'x' LIKE '%2024-01-02%' AS m" and args == {}
    text, args = bind_run_date("SELECT 'it''s ${run_date}' AS s, c >= '${run_date}'", "2024-01-02")
    assert text == "SELECT 'it''s 2024-01-02' AS s, c >= :run_date" and args == {"run_date": "2024-01-02"}


def test_column_item_access(spark):
    df = spark.createDataFrame([("a,b", {"k": 1})], "s string, m map<string,int>")
    first = pyspark_expression("F.split(F.col('s'), ',')[0]")
    value = pyspark_expression("F.col('m')['k']")
    assert tuple(df.select(first, value).first()) == ("a", 1)
    with pytest.raises(ValueError):
        pyspark_expression("F.__dict__['col']")
    with pytest.raises(ValueError):
        pyspark_expression("[F.col][0]")


@pytest.mark.parametrize(
    "text",
    [
        "F.builtin.sys.modules.get('os').getcwd()", "F.sys", "F.udf('x')", "F.pandas_udf('int')", "T.json", "F.Any", "F.lit(1).__class__",
        "F.col('a')._jc", "T.StringType().typeName.__func__", "(1).bit_length()", "'x'.format(1)", "F.functools.reduce", "F.col.__globals__",
        "F", "T.StructType().fields",
    ],
)
def test_nothing_but_exported_names_and_column_methods(spark, text):
    with pytest.raises(ValueError):
        pyspark_expression(text)


def test_whens_windows_and_types_still_work(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    got = df.select(
        pyspark_expression("F.when(F.col('a') == 1, 'one').otherwise('none').alias('w')"),
        pyspark_expression("F.col('a').cast(T.StringType()).alias('s')"),
        pyspark_expression("F.coalesce(F.col('a'), F.lit(7)).between(1, 7).alias('b')"),
    )
    assert sorted(map(tuple, got.collect()), key=repr) == [("none", None, True), ("one", "1", True)]


def test_double_quoted_run_dates(spark):
    for text in ('SELECT "${run_date}" AS d', 'SELECT "{$run_date}" AS d', "SELECT '${run_date}' AS d"):
        sql, args = bind_run_date(text, "2024-01-02")
        assert spark.sql(sql, args=args).first().d == "2024-01-02"
    sql, args = bind_run_date('SELECT "on ${run_date}, 12:00" AS d, DATE "${run_date}" AS e', "2024-01-02")
    row = spark.sql(sql, args=args or None).first()
    assert row.d == "on 2024-01-02, 12:00" and str(row.e) == "2024-01-02"


def test_both_placeholders_in_source_side_sql():
    assert substitute_run_date("(SELECT '${run_date}', '{$run_date}') q", "2024-01-02") == "(SELECT '2024-01-02', '2024-01-02') q"


import pytest
from pyspark.sql import types as T

from tidewater.functions.typemap import SourceColumn, ddl_type, map_type, match_columns, typed_projection

CASES = [
    ("NVARCHAR", 100, None, "VARCHAR(100)"),
    ("NVARCHAR", 5000, None, "STRING"),
    ("ALPHANUM", None, None, "VARCHAR(255)"),
    ("SHORTTEXT", 0, None, "VARCHAR(255)"),
    ("VARCHAR", 8000, None, "VARCHAR(8000)"),
    ("VARCHAR", 8001, None, "STRING"),
    ("NCHAR", 9000, None, "CHAR(4000)"),
    ("NCHAR", None, None, "CHAR(1)"),
    ("CHAR", 9000, None, "CHAR(8000)"),
    ("TINYINT", None, None, "SMALLINT"),
    ("SMALLINT", None, None, "SMALLINT"),
    ("INTEGER", None, None, "INT"),
    ("INT", None, None, "INT"),
    ("BIGINT", None, None, "BIGINT"),
    ("DECIMAL", None, None, "DECIMAL(38,10)"),
    ("DECIMAL", 50, 60, "DECIMAL(38,38)"),
    ("DEC", 10, -2, "DECIMAL(10,0)"),
    ("SMALLDECIMAL", None, 2, "DECIMAL(38,2)"),
    ("DOUBLE", None, None, "DOUBLE"),
    ("REAL", None, None, "FLOAT"),
    ("DATE", None, None, "DATE"),
    ("TIME", None, None, "STRING"),
    ("TIMESTAMP", None, None, "TIMESTAMP_NTZ"),
    ("SECONDDATE", None, None, "TIMESTAMP_NTZ"),
    ("BOOLEAN", None, None, "BOOLEAN"),
    ("CLOB", None, None, "STRING"),
    ("NCLOB", None, None, "STRING"),
    ("TEXT", None, None, "STRING"),
    ("BINTEXT", None, None, "STRING"),
    ("BLOB", None, None, "BINARY"),
    ("VARBINARY", None, None, "BINARY"),
    ("BINARY", None, None, "BINARY"),
    ("ST_GEOMETRY", None, None, "STRING"),
    ("nvarchar", 10, None, "VARCHAR(10)"),
]


@pytest.mark.parametrize("name,length,scale,want", CASES)
def test_ddl_type(name, length, scale, want):
    assert ddl_type(SourceColumn("c", name, length, scale)) == want


def test_unsigned_tinyint_keeps_255(spark):
    df = spark.createDataFrame([(255,), (0,)], "v int")
    out = typed_projection(df, [SourceColumn("v", "TINYINT", position=1)])
    assert out.schema["v"].dataType == T.ShortType()
    assert sorted(r.v for r in out.collect()) == [0, 255]


def test_projection_orders_by_position_and_drops_missing(spark):
    df = spark.createDataFrame([(1, "x", 2.5)], "a int, b string, c double")
    cols = [
        SourceColumn("C", "DECIMAL", 10, 2, 1),
        SourceColumn("a", "BIGINT", None, None, 2),
        SourceColumn("zz", "INT", None, None, 3),
    ]
    out = typed_projection(df, cols)
    assert out.columns == ["C", "a"]
    assert out.schema["C"].dataType == T.DecimalType(10, 2)
    assert map_type(SourceColumn("x", "NVARCHAR", 10)) == T.StringType()


def test_column_match_is_case_insensitive_ordered_and_strict_when_empty():
    assert match_columns(["a", "B", "c"], ["b", "A", "missing"]) == ["B", "a"]
    assert match_columns(["a", "b"], []) == ["a", "b"]
    with pytest.raises(ValueError):
        match_columns(["a"], ["x"])


def test_time_as_text_from_timestamp_or_text(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-01-01 10:11:12' a, timestamp_ntz'2024-01-01 10:11:12.5' b, '07:08:09' c"
    )
    cols = [SourceColumn(n, "TIME", position=i) for i, n in enumerate("abc")]
    row = typed_projection(df, cols).collect()[0]
    assert (row.a, row.b, row.c) == ("10:11:12", "10:11:12.500000", "07:08:09")


def test_declared_width_is_enforced(spark):
    df = spark.createDataFrame([("abc",), ("abcdef",)], "v string")
    ok = typed_projection(df, [SourceColumn("v", "NVARCHAR", 6, position=1)])
    assert sorted(r.v for r in ok.collect()) == ["abc", "abcdef"]
    too_long = typed_projection(df, [SourceColumn("v", "NVARCHAR", 5, position=1)])
    with pytest.raises(Exception, match="longer than 5"):
        too_long.collect()
    loose = typed_projection(df, [SourceColumn("v", "NVARCHAR", 5, position=1)], enforce_width=False)
    assert loose.count() == 2

"""Exact text round trips through the dataset CSV contract."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from sqlhaul import DatasetRef, append, read_dataset, stringify
from sqlhaul.operators.result import DuplicateColumns
from sqlhaul.sources.datasets import DatasetNotFound, read_result_csv
from sqlhaul.sources.uploads import UploadRefused

EDGE_VALUES = [
    None,
    "",
    "007",
    "NA",
    "nan",
    "  outer blanks  ",
    'say "hi"',
    '\\"',
    "\\",
    "a,b",
    "cr\rhere",
    "lf\nhere",
    "crlf\r\nhere",
    "#not a comment",
    "ünïcødé ✓ 漢字",
    "\t tab",
]

REF = DatasetRef("t", "edge")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_edge_values_round_trip(spark, lake):
    data = [(str(i), v) for i, v in enumerate(EDGE_VALUES)]
    df = spark.createDataFrame(data, "id string, v string")
    append(spark, df, lake, REF, "u1", epoch=100)
    back = read_dataset(spark, lake, REF)
    assert back.columns == ["id", "v"]
    assert _rows(back) == _rows(df)


def test_null_token_text_is_refused(spark, lake):
    """The literal text \\N is the null marker: a load that holds it raises."""
    df = spark.createDataFrame([("1", "\\N")], "id string, v string")
    with pytest.raises(UploadRefused):
        append(spark, df, lake, REF, "u1", epoch=100)
    with pytest.raises(DatasetNotFound):
        read_dataset(spark, lake, REF)


def test_malformed_result_rows_raise(spark, tmp_path):
    for i, body in enumerate(("a,b\n1,2,3\n", "a,b\n4\n")):
        (tmp_path / f"{i}.csv").write_text(body)
        with pytest.raises(Exception, match="MALFORMED|FAILED_READ|Malformed"):
            read_result_csv(spark, str(tmp_path / f"{i}.csv")).collect()


def test_nested_values_are_exact(spark, lake):
    df = spark.sql(
        "SELECT named_struct('a', null, 't', timestamp_ntz'2024-01-01 00:00:00.123456') s, "
        "array(timestamp_ntz'2024-01-01 00:00:00.000001', null) l, map('k', named_struct('t', timestamp_ntz'2024-01-01 00:00:00.5')) m, "
        "CAST(null AS struct<t timestamp_ntz>) n"
    )
    got = stringify(df).first()
    assert got["s"] == '{"a":null,"t":"2024-01-01 00:00:00.123456"}' and got["l"] == '["2024-01-01 00:00:00.000001",null]'
    assert got["m"] == '{"k":{"t":"2024-01-01 00:00:00.5"}}' and got["n"] is None


def test_documents_round_trip(spark, lake, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ref = DatasetRef("t", "docs")
    res = append(spark, docs, lake, ref, "u1", epoch=100)
    assert res.rows == docs.count()
    back = read_dataset(spark, lake, ref)
    assert _rows(back) == _rows(stringify(docs))


def test_empty_upload_reads_zero_rows(spark, lake):
    df = spark.createDataFrame([], "id string, v string")
    res = append(spark, df, lake, REF, "u1", epoch=100, skip_empty=False)
    assert res.rows == 0 and not res.skipped
    back = read_dataset(spark, lake, REF)
    assert back.columns == ["id", "v"] and back.count() == 0


def test_stringify_types(spark):
    schema = T.StructType(
        [
            T.StructField("arr", T.ArrayType(T.IntegerType())),
            T.StructField("m", T.MapType(T.StringType(), T.IntegerType())),
            T.StructField("s", T.StructType([T.StructField("a", T.IntegerType())])),
            T.StructField("b", T.BinaryType()),
            T.StructField("d", T.DecimalType(10, 2)),
            T.StructField("flag", T.BooleanType()),
            T.StructField("day", T.DateType()),
            T.StructField("ts", T.TimestampNTZType()),
        ]
    )
    row = ([1, 2], {"k": 1}, (3,), bytearray(b"\x00\xff"), Decimal("12.30"), True, dt.date(2024, 2, 29),
           dt.datetime(2024, 1, 1, 0, 0, 7, 179575))
    out = stringify(spark.createDataFrame([row, (None,) * 8], schema)).collect()
    assert tuple(out[0]) == ("[1,2]", '{"k":1}', '{"a":3}', "AP8=", "12.30", "true", "2024-02-29",
                             "2024-01-01 00:00:07.179575")
    assert tuple(out[1]) == (None,) * 8


def test_nested_types_survive_append(spark, lake):
    df = spark.createDataFrame([([1, 2], {"k": "v"})], "arr array<int>, m map<string,string>")
    append(spark, df, lake, REF, "u1", epoch=100)
    assert tuple(read_dataset(spark, lake, REF).collect()[0]) == ("[1,2]", '{"k":"v"}')


def test_duplicate_output_names_refused(spark, lake):
    df = spark.sql("SELECT 1 AS id, 2 AS id")
    with pytest.raises(DuplicateColumns):
        append(spark, df, lake, REF, "u1", epoch=100)


text_values = st.one_of(st.none(), st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=30))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(text_values, min_size=1, max_size=6))
def test_round_trip_property(spark, tmp_path_factory, values):
    """read(append(df)) == stringify(df) for arbitrary text (except the null token)."""
    from sqlhaul import Lake

    values = [v for v in values if v != "\\N"] or [None]
    lake = Lake(str(tmp_path_factory.mktemp("prop")))
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id string, v string")
    append(spark, df, lake, REF, "u1", epoch=100)
    assert _rows(read_dataset(spark, lake, REF)) == _rows(df)


def test_awkward_column_names_round_trip(spark, lake):
    names = ["a,b", 'q"x', "sp ace", "ünï", "#hash"]
    df = spark.createDataFrame([tuple(f"v{i}" for i in range(len(names)))], [f"c{i}" for i in range(len(names))])
    df = df.toDF(*names)
    append(spark, df, lake, REF, "u1", epoch=100)
    back = read_dataset(spark, lake, REF)
    assert back.columns == names
    assert tuple(back.first()) == tuple(f"v{i}" for i in range(len(names)))


def test_result_csv_from_another_engine(spark, tmp_path):
    from sqlhaul import read_result_csv

    path = tmp_path / "query-0001.csv"
    path.write_text('"id","v","n"\n"1","say ""hi""","007"\n"2","","1.50"\n"3","two\nlines","x"\n', encoding="utf-8")
    df = read_result_csv(spark, str(path))
    assert dict(df.dtypes) == {"id": "string", "v": "string", "n": "string"}
    assert sorted(tuple(r) for r in df.collect()) == [
        ("1", 'say "hi"', "007"),
        ("2", None, "1.50"),
        ("3", "two\nlines", "x"),
    ]


def test_stringify_variant_and_interval(spark):
    df = spark.sql("""SELECT parse_json('{"a": 1, "b": [true, null]}') AS v, INTERVAL 3 DAYS AS d,
                             CAST(NULL AS VARIANT) AS nv""")
    out = stringify(df).first()
    assert out["v"] == '{"a":1,"b":[true,null]}'
    assert out["d"] == "INTERVAL '3' DAY"
    assert out["nv"] is None

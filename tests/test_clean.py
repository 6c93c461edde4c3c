import base64
import datetime as dt
import gzip
import json
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clean, codec
from tidemark.sinks.export import export_rows
from tidemark.sources import files

KEY_A = base64.b64encode(b"a" * 16).decode()
KEY_B = base64.b64encode(b"b" * 32).decode()


def test_export_rows(frame):
    rows = frame(
        "n string, t boolean, f boolean, d date, at timestamp_ntz, s string, i long, x double",
        (None, True, False, "2020-01-02", "2020-01-02 03:04:05", 'say "hi"', 7, 1.5),
        (None, None, None, None, None, None, None, None),
    )
    first, second = (json.loads(r["value"]) for r in export_rows(rows).collect())
    assert first == {"n": "", "t": 1, "f": 0, "d": "2020-01-02", "at": "2020-01-02 03:04:05", "s": 'say "hi"', "i": 7, "x": 1.5}
    assert isinstance(first["i"], int) and set(second.values()) == {""}


def test_export_keeps_nested_records(spark):
    df = spark.sql("SELECT array(named_struct('a', 1, 'b', CAST(NULL AS STRING))) AS items, CAST(NULL AS ARRAY<INT>) AS none")
    assert json.loads(clean.to_ndjson(df).first()["value"]) == {"items": [{"a": 1, "b": None}], "none": ""}


def test_zero_dates_and_temporals_at_every_depth(spark):
    df = spark.sql(
        """SELECT '0000-00-00 00:00:00' AS z, DATE'2020-01-02' AS d, array(named_struct('z', '0000-00-00', 't', TIMESTAMP_NTZ'2020-01-02 03:04:05',
        'deep', array(named_struct('z', '0000-00-00', 'ok', 'x')))) AS list, CAST(NULL AS ARRAY<STRUCT<a: DATE>>) AS nothing"""
    )
    row = clean.stringify_temporals(df).first()
    assert (row["z"], row["d"], row["nothing"]) == (None, "2020-01-02", None)
    inner = row["list"][0]
    assert (inner["z"], inner["t"], inner["deep"][0]["z"], inner["deep"][0]["ok"]) == (None, "2020-01-02 03:04:05", None, "x")
    with pytest.raises(TypeError):
        clean.stringify_temporals(spark.sql("SELECT array('a') AS plain"))


def test_formatted_temporals(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2020-01-02 03:04:05.5' AS t")
    assert clean.stringify_temporals(df, "yyyy-MM-dd HH:mm:ss").first()["t"] == "2020-01-02 03:04:05"


def test_coercion_by_schema(frame):
    target = T.StructType([
        T.StructField("wall", T.TimestampNTZType()), T.StructField("day", T.DateType()), T.StructField("at", T.TimestampType()),
        T.StructField("n", T.LongType()), T.StructField("new", T.StringType()),
    ])
    rows = frame(
        "wall string, day string, at string, n string",
        ("2019-01-26T17:34:26.000Z", "2020-01-31T14:52:40.000+05:30", "2020-01-31T14:52:40.000+05:30", "12"),
        ("soon", "01/31/2020", None, "x1"),
    )
    good, bad = clean.coerce(rows, target, rejects="bad").collect()
    assert good["wall"] == dt.datetime(2019, 1, 26, 17, 34, 26) and good["day"] == dt.date(2020, 1, 31)
    assert good["at"].timestamp() == dt.datetime(2020, 1, 31, 9, 22, 40, tzinfo=dt.timezone.utc).timestamp()
    assert good["n"] == 12 and good["new"] is None and good["bad"] == []
    assert bad["wall"] is None and bad["day"] == dt.date(2020, 1, 31) and sorted(bad["bad"]) == ["n", "wall"]


def test_long_texts_are_packed_and_come_back(frame):
    long_text = "wörds " * 400
    rows = frame("s string, m decimal(19,4), z string", (long_text, None, "0000-00-00"), ("short", None, "x"))
    packed = clean.clean_relational(rows)
    first, second = packed.collect()
    assert zlib.decompress(base64.b64decode(first["s"])).decode() == long_text
    assert (first["z"], second["s"], second["z"]) == (None, "short", "x")
    assert [r[0] for r in packed.select(codec.inflate_text(F.col("s"))).collect()] == [long_text, "short"]


def test_inflate_takes_gzip_and_gives_back_what_it_cannot_read(frame):
    packed = base64.b64encode(gzip.compress(b"{}")).decode()
    got = frame("s string", (packed,), ("plain text",), ("abcd",), (None,)).select(codec.inflate_text(F.col("s")).alias("s"))
    assert [r["s"] for r in got.collect()] == ["{}", "plain text", "abcd", None]


def test_key_rotation(frame):
    sealed = frame("value string", ('{"a": 1}',)).select(codec.encrypt_line(F.col("value"), KEY_B).alias("value"))
    text = sealed.first()["value"]
    iv, body = text.split(":")
    assert len(iv) == 32 and len(body) % 32 == 0
    given = frame("value string", (text,))
    assert files.decrypt_lines(given, [KEY_A, KEY_B]).first()["value"] == '{"a": 1}'


def test_lines_no_key_opens(frame):
    given = frame("value string", ("00" * 16 + ":" + "11" * 16,), ("no line at all",))
    assert [r["value"] for r in files.decrypt_lines(given, [KEY_A], on_failure="null").collect()] == [None, None]
    with pytest.raises(Exception, match="no key decrypts"):
        files.decrypt_lines(given, [KEY_A]).collect()


def test_corrupt_json_is_kept(frame):
    schema = T.StructType([T.StructField("a", T.LongType())])
    rows = clean.parse_json(frame("value string", ('{"a": 1}',), ("{oops",)), schema).collect()
    assert [(r["a"], r["_corrupt"]) for r in rows] == [(1, None), (None, "{oops")]

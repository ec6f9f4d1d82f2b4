"""Column functions: decoding, JSON parsing semantics, event time, record encoding."""

import datetime as dt

from pyspark.sql import functions as F

from tideline.functions import TRANSACTION_DDL, decode, parse_json, to_event_time, to_kv_json


def _values(spark, texts):
    return spark.createDataFrame([(None if t is None else bytearray(t.encode()),) for t in texts], "value BINARY")


def test_decode_then_parse_permissive(spark):
    texts = [
        '{"timestamp": 1.5, "user_id": 3, "item": "laptop", "quantity": 2}',
        "not json",
        None,
        '{"user_id":3}',
        '{"timestamp":"2024-11-22T08:52:10.000+00:00","user_id":"123","item":"headphones","quantity":1}',
        '{"user_id":99999999999,"quantity":1.5}',
        '{"item": 5, "extra": true}',
    ]
    rows = parse_json(decode(_values(spark, texts), key=False)).collect()
    assert rows[0].asDict() == {"timestamp": 1.5, "user_id": 3, "item": "laptop", "quantity": 2}
    assert all(v is None for v in rows[1].asDict().values())
    assert all(v is None for v in rows[2].asDict().values())
    assert rows[3].user_id == 3 and rows[3].item is None
    # wrong JSON types: that field NULL, the others kept
    assert rows[4].timestamp is None and rows[4].user_id is None
    assert rows[4].item == "headphones" and rows[4].quantity == 1
    # INT overflow and a fraction into INT: NULL
    assert rows[5].user_id is None and rows[5].quantity is None
    # number into STRING keeps its text; extra fields ignored
    assert rows[6].item == "5"


def test_parse_needs_string(spark):
    import pytest

    df = _values(spark, ['{"user_id": 1}'])
    with pytest.raises(Exception):
        parse_json(df).collect()


def test_corrupt_column_keeps_malformed_text(spark):
    df = decode(_values(spark, ["not json", '{"user_id": 1}']), key=False)
    rows = parse_json(df, corrupt_column="_bad").collect()
    assert rows[0]["_bad"] == "not json"
    assert rows[1]["_bad"] is None and rows[1].user_id == 1


def test_event_time_drops_fraction(spark):
    df = spark.createDataFrame([(1732301581.733,), (-1.9,), (None,)], "timestamp DOUBLE")
    secs = [r.timestamp for r in to_event_time(df).select(F.col("timestamp").cast("timestamp_ntz").alias("timestamp")).collect()]
    assert secs[0] == dt.datetime(1970, 1, 1) + dt.timedelta(seconds=1732301581)
    assert secs[1] == dt.datetime(1969, 12, 31, 23, 59, 59)
    assert secs[2] is None
    micros = to_event_time(df, precision="micros").select(F.col("timestamp").cast("timestamp_ntz")).first()[0]
    assert micros == dt.datetime(1970, 1, 1) + dt.timedelta(seconds=1732301581, microseconds=733000)


def test_kv_json_omits_nulls(spark):
    df = spark.createDataFrame([("laptop", 5), (None, 5)], "item STRING, count BIGINT")
    rows = to_kv_json(df, "item", ["item", "count"]).collect()
    assert rows[0].key == "laptop" and rows[0].value == '{"item":"laptop","count":5}'
    assert rows[1].key is None and rows[1].value == '{"count":5}'


def test_transaction_ddl():
    assert TRANSACTION_DDL == "timestamp DOUBLE, user_id INT, item STRING, quantity INT"

import json

import pytest
from pyspark.sql import functions as F

from helpers import trade
from tradeloom.operators.anomaly import anomaly_self_join
from tradeloom.operators.projections import bronze_enrich
from tradeloom.operators.quality import dq_schema_complete
from tradeloom.operators.vwap import vwap
from tradeloom.schema import WIRE
from tradeloom.sources.feed import parse_trade_json, payload_column, quarantine, resolve_payload, stream_source, wire_rows
from tradeloom.sources.vendor import normalize_vendor_trades


def raw(spark, *payloads, name="value"):
    texts = [p if isinstance(p, str) or p is None else json.dumps(p) for p in payloads]
    return spark.createDataFrame([(t,) for t in texts], f"`{name}` string")


def test_bytes_and_text_parse_alike(spark):
    df = raw(spark, trade(1))
    as_bytes = df.select(F.col("value").cast("binary").alias("value"))
    assert parse_trade_json(df, "value").collect() == parse_trade_json(as_bytes, "value").collect()


@pytest.mark.parametrize("quantity", [1.5, 3_000_000_000])
def test_quantity_that_is_no_int_is_null(spark, quantity):
    row = parse_trade_json(raw(spark, trade(1, quantity=quantity)), "value").first()
    assert row["quantity"] is None and row["price"] == 100.0


def test_missing_fields_are_null(spark):
    short = {k: v for k, v in trade(1).items() if k in ("trade_id", "ticker", "price")}
    row = parse_trade_json(raw(spark, short), "value").first()
    assert row["ticker"] == "A" and row["side"] is None


def test_broken_payload_stays_in_bronze_and_leaves_silver_and_gold(spark):
    wire = parse_trade_json(raw(spark, "{oops", trade(1), trade(2, price=200.0)), "value")
    assert bronze_enrich(wire).where("trade_id IS NULL AND year IS NULL").count() == 1
    assert vwap(wire, "1 minute").select("trade_count").collect()[0][0] == 2
    assert {r["trade_id"] for r in anomaly_self_join(wire).collect()} == {"t1", "t2"}


def test_timestamps(spark):
    wire = parse_trade_json(
        raw(spark, trade(1, timestamp="2026-06-06T10:00:00+02:00"), trade(2, timestamp="bad")), "value"
    )
    got = {r["trade_id"]: r["t"] for r in bronze_enrich(wire).select("trade_id", F.col("event_time").cast("string").alias("t")).collect()}
    assert got == {"t1": "2026-06-06 08:00:00", "t2": None}


def test_resolve_takes_parsed_columns_in_schema_order(spark):
    df = parse_trade_json(raw(spark, trade(1)), "value")
    shuffled = df.select(F.lit("x").alias("$offset"), *reversed(WIRE.names))
    assert resolve_payload(shuffled).columns == WIRE.names


@pytest.mark.parametrize("fmt, column", [("kafka", "value"), ("kinesis", "data"), ("text", "value")])
def test_the_format_names_the_payload_column(spark, fmt, column):
    df = raw(spark, trade(7), name=column).select(F.lit("k").alias("key"), column, F.lit("x").alias("source"))
    assert resolve_payload(df, fmt).first()["trade_id"] == "t7"


def test_one_column_of_text_or_bytes_is_the_payload(spark):
    df = raw(spark, trade(7), name="body").withColumn("offset", F.lit(1))
    assert payload_column(df) == "body" and resolve_payload(df).first()["trade_id"] == "t7"
    as_bytes = df.select(F.col("body").cast("binary").alias("$body$"), "offset")
    assert resolve_payload(as_bytes).first()["trade_id"] == "t7"


def test_a_feed_with_wire_fields_is_parsed(spark):
    df = spark.createDataFrame([("t1", "A", 5)], "trade_id string, ticker string, quantity long")
    assert payload_column(df) is None
    got = resolve_payload(df)
    assert [(f.name, f.dataType) for f in got.schema.fields] == [(f.name, f.dataType) for f in WIRE.fields]
    assert (got.first()["quantity"], got.first()["price"]) == (5, None)


@pytest.mark.parametrize("columns", ["a string, b binary", "a long, b double"])
def test_an_unclear_payload_is_an_error(spark, columns):
    with pytest.raises(ValueError, match="name the payload column"):
        payload_column(spark.createDataFrame([], columns))


def test_the_caller_may_name_the_payload(spark):
    df = raw(spark, trade(7), name="b c").withColumn("a", F.lit("x"))
    assert wire_rows(df, "b c").first()["trade_id"] == "t7"


def test_vendor_messages(spark):
    msg = {"type": "trade", "data": [
        {"s": "AAPL", "p": 1.5, "v": 100, "t": 1780740600123},
        {"s": "AAPL", "p": 1.6, "v": 0.25, "t": 1780740600123},
        {"s": "V", "p": 2, "v": 7.0, "t": 1780740600000},
    ]}
    text = json.dumps(msg).replace("7.0", "7.00e0")
    df = normalize_vendor_trades(raw(spark, text, {"type": "ping"}, {"type": "news", "data": msg["data"]}, "{oops"), "value")
    got = df.orderBy("item").collect()
    assert [r["trade_id"] for r in got] == ["fh-1780740600123-AAPL"] * 2 + ["fh-1780740600000-V"]
    assert [(r["quantity"], r["quantity_raw"]) for r in got] == [(100, 100.0), (None, 0.25), (7, 7.0)]
    assert [r["item"] for r in got] == [0, 1, 2]
    assert got[0]["timestamp"] == "2026-06-06T10:10:00.123000+00:00"
    assert {(r["side"], r["trade_type"], r["bid_price"], r["ask_price"]) for r in got} == {("unknown", "market", None, None)}
    assert df.columns[:11] == WIRE.names


@pytest.mark.parametrize("volume, quantity", [("100", 100), ("100.0", 100), ("1e2", 100), ("1.5", None), ("3e9", None), ("-1e10", None), ("0", 0), ("null", None)])
def test_vendor_volumes(spark, volume, quantity):
    text = '{"type":"trade","data":[{"s":"A","p":1.0,"v":%s,"t":0}]}' % volume
    assert normalize_vendor_trades(raw(spark, text), "value").first()["quantity"] == quantity


def test_quarantine_names_what_was_lost(spark):
    df = raw(spark, trade(1), trade(2, quantity=1.5), trade(3, timestamp="bad"), "{oops", None)
    got = sorted(tuple(r["lost_fields"]) for r in quarantine(df, "value").collect())
    required = tuple(f.name for f in WIRE.fields if not f.nullable)
    assert got == sorted([("quantity",), ("timestamp",), required, required])


def test_null_fields_are_present_but_absent_ones_are_not(spark):
    absent = {k: v for k, v in trade(2).items() if k != "exchange"}
    df = raw(spark, trade(1), absent, "{oops", "[1]")
    assert dq_schema_complete(df, "value").first()["violations"] == 3


def test_stream_source_reads_files_with_the_given_schema(spark, tmp_path):
    df = stream_source(spark, "json", {"path": str(tmp_path)})
    assert df.isStreaming and df.columns == WIRE.names

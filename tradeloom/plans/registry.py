"""Every operator as a named query over the given tables.

Each callable takes (spark, folder of the tables) and gives a DataFrame. Timestamps are shown without a
zone and doubles to six decimals, since the order of a distributed sum moves the last digits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.config import SESSION_SETTINGS, Config, shared_dir
from tradeloom.functions import columns as fn
from tradeloom.operators import alerts, anomaly, jumps, profiles, projections, quality, stats, vwap
from tradeloom.plans.medallion import medallion_run
from tradeloom.schema import BRONZE_PARTITIONS, GOLD, PARTIALS, SILVER, TABLES
from tradeloom.sources import commits, feed, replay, state, tables, vendor
from tradeloom.streaming import progress, sinks

DAY = date(2026, 6, 6)
AS_OF = datetime(2026, 6, 6, 23, 58)
FROM_TIME = "2026-06-07 00:01:00"
KNOWN_TICKERS = tuple(f"TK{i:02d}" for i in range(20))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    def shown(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        return c.alias(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def query(*names: str):
    def register(make: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", SESSION_SETTINGS["spark.sql.session.timeZone"])
            return present(make(spark, sf_dir))

        for name in names:
            QUERIES[name] = run
        return make

    return register


# --- inputs -------------------------------------------------------------------------------------


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.trades_of(replay.events(spark, sf_dir)).drop("event_type", "value")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.dirtied(replay.trades_of(replay.events(spark, sf_dir)), AS_OF)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trades as stored, with the replay's own ingest time."""
    return projections.bronze_enrich(trades(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str, duration: str = "1 minute") -> DataFrame:
    return projections.window_flatten(vwap.vwap(trades(spark, sf_dir), duration), AS_OF)


def silver_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """1-minute and 5-minute windows, merged from the same partial results: one pass over the trades for both.

    The partial results are written down: filters that a join pushes into each side would keep Spark from reusing a shuffle.
    """
    shared_dir(spark)
    partials = vwap.vwap_partials(trades(spark, sf_dir)).checkpoint()
    return tuple(projections.window_flatten(vwap.merge_partials(partials, d), AS_OF) for d in ("1 minute", "5 minutes"))


def gold(spark: SparkSession, sf_dir: str, threshold: float = 0.01) -> DataFrame:
    return anomaly.anomaly_by_bucket(trades(spark, sf_dir), "30 seconds", threshold, AS_OF)


def gold_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts with the bucket they were found in as their file."""
    name = F.concat(F.lit("alerts-"), F.date_format("bucket", "yyyy-MM-dd HH:mm:ss"))
    return gold(spark, sf_dir).withColumn("file", name)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.wire_of(trades(spark, sf_dir)).select(feed.trade_payload().alias("value"))


def rough_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trades as payloads; sign-ups send six fields only and small errors send no JSON."""
    rows = replay.trades_of(replay.events(spark, sf_dir))
    wire = rows.withColumn("timestamp", F.date_format("event_time", replay.ISO))
    short = F.to_json(F.struct("trade_id", "ticker", "price", "quantity", "side", "timestamp"))
    broken = (F.col("event_type") == "error") & (F.col("value") < 50)
    return wire.select(
        F.when(F.col("event_type") == "signup", short).when(broken, "{oops").otherwise(feed.trade_payload()).alias("value")
    )


def vendor_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message of two items per trade; views come as pings and errors with a fractional volume."""
    rows = replay.trades_of(replay.events(spark, sf_dir))
    kind = F.when(F.col("event_type") == "view", "ping").otherwise("trade")
    tail = F.when(F.col("event_type") == "error", ".5").when(F.col("event_type") == "click", ".0").otherwise("")
    volume = F.concat(F.col("quantity").cast("string"), tail)
    ms = F.unix_millis("event_time")

    def item(price: Column, at: Column) -> Column:
        return F.concat(
            F.lit('{"s":"'), "ticker", F.lit('","p":'), price.cast("string"), F.lit(',"v":'), volume,
            F.lit(',"t":'), at.cast("string"), F.lit("}"),
        )

    both = F.concat_ws(",", item(F.col("price"), ms), item(F.col("price") + 1, ms + 1))
    return rows.select(F.concat(F.lit('{"type":"'), kind, F.lit('","data":['), both, F.lit("]}")).alias("message"))


def wire_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trades as a live feed of JSON payloads, parsed."""
    rows = replay.wire_of(replay.trades_of(replay.events_stream(spark, sf_dir)))
    return feed.wire_rows(rows.select(feed.trade_payload().alias("value")), "value")


def delivered(spark: SparkSession, cfg: Config, files: int | None = None) -> DataFrame:
    """The feed that a run has in its own folder, parsed; ``files`` limits a micro-batch."""
    options = replace(cfg, max_files_per_trigger=files).source_options()
    return feed.wire_rows(feed.stream_source(spark, "text", {"path": cfg.table_path("feed"), **options}), "value")


def new_run(spark: SparkSession) -> Config:
    return Config(root=f"{shared_dir(spark)}/tradeloom", trigger=None)


def stored(spark: SparkSession, cfg: Config, table: str) -> DataFrame:
    return tables.read_table(spark, cfg.table_path(table), table)


def _halves(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The trades up to the middle of their time, and those after it."""
    rows = trades(spark, sf)
    ends = rows.agg(F.min(F.unix_micros("event_time")).alias("a"), F.max(F.unix_micros("event_time")).alias("b")).first()
    first = F.unix_micros("event_time") <= (ends["a"] + ends["b"]) // 2
    return rows.where(first), rows.where(~first)


def finish(*streams) -> None:
    for s in streams:
        s.awaitTermination()


# --- sources and sinks --------------------------------------------------------------------------


def _parsed_stream(spark: SparkSession, wire: DataFrame, cfg: Config) -> DataFrame:
    """Let a wire stream run to its end into a table of its own."""
    path = cfg.table_path("parsed")
    finish(
        wire.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", cfg.checkpoint_path("parsed")).trigger(availableNow=True).start()
    )
    return spark.read.schema(wire.schema).parquet(path)


@query("stream_source")
def _(spark, sf):
    cfg = new_run(spark)
    payloads(spark, sf).write.text(cfg.table_path("feed"))
    raw = feed.stream_source(spark, "text", {"path": cfg.table_path("feed")})
    return _parsed_stream(spark, feed.resolve_payload(raw, "text"), cfg)


@query("stream_replay_earliest")
def _(spark, sf):
    cfg = new_run(spark)
    payloads(spark, sf).write.text(cfg.table_path("feed"))
    raw = feed.stream_replay_earliest(spark, "json", {"path": cfg.table_path("feed")})
    return _parsed_stream(spark, feed.resolve_payload(raw), cfg)


@query("resolve_payload")
def _(spark, sf):
    raw = payloads(spark, sf).select(F.length("value").alias("size"), F.col("value").cast("binary").alias("data"))
    return feed.resolve_payload(raw, "kinesis")


@query("parse_trade_json")
def _(spark, sf):
    return feed.parse_trade_json(rough_payloads(spark, sf), "value")


@query("quarantine")
def _(spark, sf):
    lost = feed.quarantine(rough_payloads(spark, sf), "value")
    return lost.groupBy(F.array_join("lost_fields", ",").alias("lost_fields")).agg(F.count("*").alias("rows"))


@query("bronze_append")
def _(spark, sf):
    cfg = new_run(spark)
    finish(sinks.bronze_append(wire_stream(spark, sf), cfg.table_path("bronze_raw_trades"), cfg.checkpoint_path("b"), None))
    return stored(spark, cfg, "bronze_raw_trades").drop("ingested_at")


def _silver_run(spark, sf, duration: str, watermark: str = "10 seconds"):
    cfg = new_run(spark)
    stream = sinks.silver_sink(
        wire_stream(spark, sf), cfg.table_path("silver"), cfg.checkpoint_path("silver"), duration, watermark, None
    )
    finish(stream)
    return stream, spark.read.schema(SILVER).parquet(cfg.table_path("silver")).drop("computed_at")


@query("silver_sink", "tumbling_1min")
def _(spark, sf):
    return _silver_run(spark, sf, "1 minute")[1]


@query("append_finalized", "tumbling_5min")
def _(spark, sf):
    return _silver_run(spark, sf, "5 minutes")[1]


@query("vwap_from_partials")
def _(spark, sf):
    """The closed windows of both lengths out of one stream of partial results, in two deliveries."""
    cfg = new_run(spark)
    for half in _halves(spark, sf):
        replay.wire_of(half).select(feed.trade_payload().alias("value")).write.mode("append").text(cfg.table_path("feed"))
        finish(sinks.partials_sink(delivered(spark, cfg), cfg.table_path("partials"), cfg.checkpoint_path("partials"), trigger=None))
    partials = spark.read.schema(PARTIALS).parquet(cfg.table_path("partials"))
    merged = [
        vwap.closed_by_partials(projections.window_flatten(vwap.merge_partials(partials, d), AS_OF).drop("computed_at"), partials)
        .withColumn("minutes", F.lit(n)) for n, d in ((1, "1 minute"), (5, "5 minutes"))
    ]
    return reduce(DataFrame.unionByName, merged)


@query("watermark")
def _(spark, sf):
    return _silver_run(spark, sf, "1 minute", "90 seconds")[1]


@query("batch_written_counts")
def _(spark, sf):
    """The feed comes twice, in 8 files and then in 120. One stream stores it as it comes, a file a micro-batch, the
    other its windows, for which most of the second copy is late."""
    cfg = new_run(spark)
    log = progress.ProgressLog(spark, cfg.table_path("progress"))
    spark.streams.addListener(log)
    try:
        for files in (8, 120):
            payloads(spark, sf).repartition(files).write.mode("append").text(cfg.table_path("feed"))
            streams = {
                "rows": sinks.append_rows(delivered(spark, cfg, 1), cfg.table_path("rows"), cfg.checkpoint_path("rows"), None),
                "windows": sinks.silver_sink(
                    delivered(spark, cfg), cfg.table_path("silver"), cfg.checkpoint_path("silver"), "1 minute", trigger=None),
            }
            finish(*streams.values())
            for stream in streams.values():
                log.settle(stream)
    finally:
        spark.streams.removeListener(log)
    counts = progress.batch_written_counts(spark, log.path)
    name = reduce(lambda a, item: F.when(F.col("query_id") == str(item[1].id), item[0]).otherwise(a), streams.items(), F.lit("?"))
    return counts.groupBy(name.alias("stream")).agg(
        F.count_if(F.col("rows_read") > 0).alias("batches"), F.sum("rows_read").alias("rows_read"),
        F.sum("rows_written").alias("rows_written"), (F.sum("rows_late") > 0).alias("some_late"))


def _gold_run(spark, sf) -> Config:
    cfg = new_run(spark)
    finish(sinks.gold_sink(wire_stream(spark, sf), cfg.table_path("gold_anomaly_alerts"), cfg.checkpoint_path("g"), trigger=None))
    return cfg


@query("gold_sink")
def _(spark, sf):
    return stored(spark, _gold_run(spark, sf), "gold_anomaly_alerts").drop("detected_at", "alert_day")


@query("alert_digest_stream")
def _(spark, sf):
    """The blocks of the digests of all new alert files; a file holds the alerts of a day."""
    cfg = _gold_run(spark, sf)
    files = tables.alert_file_stream(spark, cfg.table_path("gold_anomaly_alerts"))
    finish(sinks.digest_sink(files, cfg.table_path("digests"), cfg.checkpoint_path("d"), trigger=None))
    schema = "file string, ticker string, subject string, body string"
    return spark.read.schema(schema).parquet(cfg.table_path("digests")).where("ticker IS NOT NULL").select("ticker", "body")


@query("stream_profile")
def _(spark, sf):
    """Profiles of a feed that comes in three files, one a micro-batch, summed over the batches."""
    cfg = new_run(spark)
    payloads(spark, sf).repartition(3).write.text(cfg.table_path("feed"))
    finish(sinks.profile_sink(delivered(spark, cfg, 1), cfg.table_path("profiles"), cfg.checkpoint_path("p"), None))
    profiles = spark.read.schema("section string, name string, trades long, batch_id long").parquet(cfg.table_path("profiles"))
    sampled = F.col("section") == "sample"
    return profiles.where("section IN ('rows', 'source', 'sample')").groupBy(
        "section", F.when(~sampled, F.col("name")).alias("name")).agg(
        F.sum(F.when(sampled, 1).otherwise(F.col("trades"))).alias("trades"), F.count_distinct("batch_id").alias("batches"))


@query("alert_file_scan")
def _(spark, sf):
    found = tables.alert_file_scan(spark, _gold_run(spark, sf).table_path("gold_anomaly_alerts"))
    return found.groupBy("ticker").agg(F.count_if(F.col("file").contains("/batch_id=0/")).alias("alerts"))


def _two_drops(spark, sf, start: Callable[[DataFrame, Config], object]) -> Config:
    """A feed that arrives in two deliveries, buys before sells, with a restart between them and one
    more restart that finds nothing new."""
    cfg = new_run(spark)
    rows = replay.wire_of(trades(spark, sf))
    for side in ("buy", "sell", None):
        if side:
            drop = rows.where(F.col("side") == side).select(feed.trade_payload().alias("value"))
            drop.write.mode("append").text(cfg.table_path("feed"))
        finish(start(delivered(spark, cfg), cfg))
    return cfg


@query("checkpoint_resume")
def _(spark, sf):
    def start(wire: DataFrame, cfg: Config):
        return sinks.bronze_append(wire, cfg.table_path("bronze_raw_trades"), cfg.checkpoint_path("b"), None)

    return stored(spark, _two_drops(spark, sf, start), "bronze_raw_trades").drop("ingested_at")


def _gold_into(cfg: Config, wire: DataFrame):
    return sinks.gold_sink(wire, cfg.table_path("gold_anomaly_alerts"), cfg.checkpoint_path("g"), trigger=None)


@query("foreach_batch_anomaly")
def _(spark, sf):
    cfg = _two_drops(spark, sf, lambda wire, cfg: _gold_into(cfg, wire))
    return stored(spark, cfg, "gold_anomaly_alerts").drop("detected_at", "alert_day")


@query("skip_empty_batch")
def _(spark, sf):
    """Between the buys and the sells comes a delivery without a single row; it makes a micro-batch and no alerts."""
    cfg = new_run(spark)
    rows = replay.wire_of(trades(spark, sf)).select("side", feed.trade_payload().alias("value"))
    for part in (rows.where("side = 'buy'"), rows.limit(0), rows.where("side = 'sell'")):
        # A frame without rows still leaves a file, so that there is something to deliver.
        part.select("value").write.mode("append").text(cfg.table_path("feed"))
        finish(_gold_into(cfg, delivered(spark, cfg)))
    return stored(spark, cfg, "gold_anomaly_alerts").drop("detected_at", "alert_day")


@query("anomaly_rate_stream")
def _(spark, sf):
    """Flagged and all trades of each micro-batch, buys before sells, as the gold sink has counted and committed them."""
    cfg = _two_drops(spark, sf, lambda wire, cfg: _gold_into(cfg, wire))
    return anomaly.batch_rates(commits.commits(spark, cfg.table_path("gold_anomaly_alerts")))


@query("anomaly_by_bucket_stream")
def _(spark, sf):
    """The first half of the feed, a restart, the second half, and a restart that finds nothing new."""
    cfg = new_run(spark)
    for half in (*_halves(spark, sf), None):
        if half is not None:
            replay.wire_of(half).select(feed.trade_payload().alias("value")).write.mode("append").text(cfg.table_path("feed"))
        finish(sinks.bucket_alerts_sink(delivered(spark, cfg), cfg.table_path("bucket_alerts"), cfg.checkpoint_path("ba"), trigger=None))
    return spark.read.parquet(cfg.table_path("bucket_alerts")).drop("detected_at")


def _late_run(spark, sf) -> Config:
    """The feed is delivered twice, the second time with sells a tenth dearer: all that is late for a closed window, so
    silver keeps the first prices while bronze holds both."""
    cfg = new_run(spark)
    rows = replay.wire_of(trades(spark, sf))
    dearer = F.when(F.col("side") == "sell", F.col("price") * 1.1).otherwise(F.col("price"))
    for delivery in (rows, rows.withColumn("price", dearer)):
        delivery.select(feed.trade_payload().alias("value")).write.mode("append").text(cfg.table_path("feed"))
        wire = delivered(spark, cfg)
        finish(
            sinks.bronze_append(wire, cfg.table_path("bronze_raw_trades"), cfg.checkpoint_path("b"), None),
            sinks.silver_sink(wire, cfg.table_path("silver_vwap_1min"), cfg.checkpoint_path("s"), "1 minute", trigger=None),
        )
    return cfg


@query("late_drop")
def _(spark, sf):
    """In the feed delivered twice, the trades of each window in bronze and in silver."""
    cfg = _late_run(spark, sf)
    kept = stored(spark, cfg, "silver_vwap_1min").select("window_start", "ticker", F.col("trade_count").alias("in_silver"))
    all_rows = stored(spark, cfg, "bronze_raw_trades").groupBy(
        F.date_trunc("minute", "event_time").alias("window_start"), "ticker"
    ).agg(F.count("*").alias("in_bronze"))
    return all_rows.join(kept, ["window_start", "ticker"], "left")


@query("trigger_30s")
def _(spark, sf):
    cfg = new_run(spark)
    stream = sinks.bronze_append(
        wire_stream(spark, sf), cfg.table_path("bronze_raw_trades"), cfg.checkpoint_path("b"), "30 seconds"
    )
    stream.processAllAvailable()
    sinks.bounded_run([stream], 0)
    return stored(spark, cfg, "bronze_raw_trades").drop("ingested_at")


@query("trigger_cadence")
def _(spark, sf):
    """Five deliveries to a stream that starts its micro-batches on the second: what it read, and how many starts lay off
    the interval (by more than half of it) or came sooner than it after the one before."""
    cfg = new_run(spark)
    rows = replay.wire_of(trades(spark, sf)).select(F.pmod(F.xxhash64("trade_id"), F.lit(5)).alias("part"), feed.trade_payload().alias("value"))
    rows.limit(0).select("value").write.text(cfg.table_path("feed"))
    log = progress.ProgressLog(spark, cfg.table_path("progress"))
    spark.streams.addListener(log)
    try:
        stream = sinks.append_rows(delivered(spark, cfg), cfg.table_path("rows"), cfg.checkpoint_path("rows"), "1 second")
        for part in range(5):
            rows.where(F.col("part") == part).select("value").write.mode("append").text(cfg.table_path("feed"))
            stream.processAllAvailable()
        log.settle(stream)
        sinks.bounded_run([stream], 0)
    finally:
        spark.streams.removeListener(log)
    starts = progress.trigger_starts(spark, log.path, 1000)
    return starts.where("rows_read > 0").agg(
        F.sum("rows_read").alias("rows_read"), (F.count("*") >= 5).alias("a_batch_for_each"),
        # The first micro-batch starts with the stream, whatever the time.
        F.count_if((F.col("batch_id") > 0) & (F.col("after_ms") > 500)).alias("off_interval"),
        F.count_if((F.col("batch_id") > 1) & (F.col("since_ms") < 500)).alias("too_soon"))


@query("open_windows")
def _(spark, sf):
    """The windows that a stopped stream has not closed yet."""
    cfg = new_run(spark)
    finish(sinks.silver_sink(wire_stream(spark, sf), cfg.table_path("silver"), cfg.checkpoint_path("s"), "1 minute", trigger=None))
    return state.open_windows(spark, cfg.checkpoint_path("s"))


@query("bounded_run")
def _(spark, sf):
    cfg = new_run(spark)
    stream = sinks.bronze_append(wire_stream(spark, sf), cfg.table_path("bronze_raw_trades"), cfg.checkpoint_path("b"), None)
    sinks.bounded_run([stream], 3600)
    return stored(spark, cfg, "bronze_raw_trades").drop("ingested_at")


@query("reset_checkpoints")
def _(spark, sf):
    """Two runs from scratch: each reads the whole feed into tables of its own."""
    first = new_run(spark)
    counts = []
    for n, cfg in enumerate((first, first.fresh())):
        finish(sinks.bronze_append(wire_stream(spark, sf), cfg.table_path("bronze_raw_trades"), cfg.checkpoint_path("b"), None))
        counts.append(stored(spark, cfg, "bronze_raw_trades").agg(F.lit(n + 1).alias("run"), F.count("*").alias("rows")))
    return reduce(DataFrame.unionByName, counts)


@query("fan_out")
def _(spark, sf):
    cfg = new_run(spark)
    finish(*sinks.fan_out(wire_stream(spark, sf), cfg))
    names = ("bronze_raw_trades", "silver_vwap_1min", "silver_vwap_5min", "gold_anomaly_alerts")
    return stats.layer_counts({t: stored(spark, cfg, t) for t in names})


@query("medallion_run")
def _(spark, sf):
    done = medallion_run(spark, wire_stream(spark, sf), new_run(spark), 3600, strict=False)
    return done.drop("run_id")


def _batch_layer(spark, sf, table: str) -> DataFrame:
    if table == "bronze_raw_trades":
        return bronze(spark, sf).hint("rebalance", *BRONZE_PARTITIONS)
    if table == "gold_anomaly_alerts":
        dated = gold(spark, sf).withColumns({"alert_day": F.to_date("event_time"), "batch_id": F.lit(0).cast("long")})
        return dated.select(*GOLD.names)
    return silver(spark, sf, "1 minute" if table == "silver_vwap_1min" else "5 minutes")


def _stored_batch(spark, sf, *names: str) -> Config:
    """Tables written from the trades by batch jobs, and registered."""
    cfg = new_run(spark)
    for table in names:
        _batch_layer(spark, sf, table).write.partitionBy(*TABLES[table][1]).parquet(cfg.table_path(table))
    tables.table_register(spark, cfg)
    return cfg


def _stored_stream(spark, sf) -> Config:
    """Tables written by the four streams, and registered."""
    cfg = new_run(spark)
    finish(*sinks.fan_out(wire_stream(spark, sf), cfg))
    tables.table_register(spark, cfg)
    return cfg


@query("partition_pruned_scan")
def _(spark, sf):
    name = f"{_stored_stream(spark, sf).database}.bronze_raw_trades"
    return tables.partition_pruned_scan(spark, name, 2026, 6, 6, "TK07").drop("ingested_at")


@query("table_register")
def _(spark, sf):
    cfg = _stored_stream(spark, sf)
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {cfg.database}").collect()]
    return stats.layer_counts({n: spark.table(f"{cfg.database}.{n}") for n in names})


@query("compact_bronze")
def _(spark, sf):
    """The compacted table under the name of the one that the batch job wrote."""
    cfg = _stored_batch(spark, sf, "bronze_raw_trades")
    tables.compact_bronze(spark, cfg.table_path("bronze_raw_trades"), cfg.table_path("bronze_compacted"))
    return spark.table(tables.table_repoint(spark, cfg, "bronze_raw_trades", cfg.table_path("bronze_compacted")))


# --- projections --------------------------------------------------------------------------------


@query("bronze_enrich")
def _(spark, sf):
    return bronze(spark, sf)


@query("filter_partition")
def _(spark, sf):
    """The first of the stored days."""
    cfg = _stored_batch(spark, sf, "bronze_raw_trades")
    return spark.table(f"{cfg.database}.bronze_raw_trades").where(vwap.on_day(DAY))


@query("notional")
def _(spark, sf):
    return trades(spark, sf).select("trade_id", fn.notional(F.col("price"), F.col("quantity")).alias("notional"))


@query("scalar_functions")
def _(spark, sf):
    """The scalar functions of the stored layers, one column each."""
    at, ingested = F.col("event_time"), F.col("ingested_at")
    return trades(spark, sf).select(
        "trade_id",
        F.year(at).alias("year"),
        F.month(at).alias("month"),
        F.dayofmonth(at).alias("day"),
        F.date_trunc("minute", at).alias("minute"),
        (F.unix_micros(ingested) / 1e6 - F.unix_micros(at) / 1e6).alias("seconds_to_ingest"),
        F.timestamp_millis(F.unix_millis(at)).alias("from_millis"),
        F.abs(F.col("price") - 200).alias("distance"),
        F.round(F.col("price") * F.col("quantity"), 2).alias("amount"),
        F.try_divide("price", F.when(F.col("side") == "buy", 4).otherwise(0)).alias("quarter_price"),
        F.concat_ws("-", F.lit("id"), "ticker", "trade_id").alias("joined_id"),
        fn.percent_text(F.col("price") / 10000).alias("as_percent"),
        fn.money_text(F.col("price")).alias("as_money"),
        fn.alert_subject(F.col("quantity"), F.col("quantity"), 43).alias("subject"),
        F.col("side").isin("buy", "unknown").alias("listed"),
    )


@query("silver_project")
def _(spark, sf):
    return projections.silver_project(trades(spark, sf))


@query("gold_project")
def _(spark, sf):
    return projections.gold_project(replay.wire_of(trades(spark, sf)))


@query("window_flatten", "vwap_1min")
def _(spark, sf):
    return silver(spark, sf)


@query("vwap_5min")
def _(spark, sf):
    return silver(spark, sf, "5 minutes")


@query("buy_ratio")
def _(spark, sf):
    return silver(spark, sf).select("window_start", "ticker", "buy_ratio")


@query("buy_pct")
def _(spark, sf):
    return silver(spark, sf).select("window_start", "ticker", fn.buy_pct(F.col("buy_ratio")).alias("buy_pct"))


@query("window_source")
def _(spark, sf):
    return silver(spark, sf).select("window_start", "ticker", "source")


@query("filter_time_from")
def _(spark, sf):
    return silver(spark, sf).where(F.col("window_start") >= F.lit(FROM_TIME).cast("timestamp"))


@query("deviation")
def _(spark, sf):
    return gold(spark, sf, -1.0).select("trade_id", "deviation_pct")


@query("direction")
def _(spark, sf):
    return gold(spark, sf, -1.0).select("trade_id", "direction")


def _late_layers(spark, sf) -> tuple[DataFrame, DataFrame]:
    cfg = _late_run(spark, sf)
    return stored(spark, cfg, "bronze_raw_trades"), stored(spark, cfg, "silver_vwap_1min")


@query("vwap_diff_pct")
def _(spark, sf):
    rows = vwap.reconcile_all_windows(*_late_layers(spark, sf))
    return rows.select("ticker", "minute", "diff_pct")


@query("reconcile_verdict")
def _(spark, sf):
    """The 5-minute VWAP in the place of the streamed one, so that the verdicts differ."""
    rows = vwap.window_divergence(*silver_pair(spark, sf))
    return rows.select("ticker", "minute", fn.reconcile_verdict(F.col("divergence_pct") * 5).alias("verdict"))


@query("divergence_pct")
def _(spark, sf):
    return vwap.window_divergence(*silver_pair(spark, sf))


@query("normalize_vendor_trades", "filter_message_type")
def _(spark, sf):
    return vendor.normalize_vendor_trades(vendor_messages(spark, sf), "message")


# --- filters and quality ------------------------------------------------------------------------


@query("filter_threshold")
def _(spark, sf):
    return gold(spark, sf, 0.02)


def _violating(*checks: str):
    def run(spark, sf):
        hit = reduce(lambda a, b: a | b, [quality.row_rules(AS_OF)[c] for c in checks])
        return dirty(spark, sf).where(hit)

    return run


query("filter_null")(_violating("null_trade_id", "null_ticker", "null_timestamp"))
query("filter_nonpositive")(_violating("negative_price", "zero_quantity"))
query("filter_domain")(_violating("invalid_side"))
query("filter_future")(_violating("future_trades"))


@query("having_duplicates", "duplicate_ids")
def _(spark, sf):
    return stats.duplicate_ids(dirty(spark, sf))


@query("duplicate_count")
def _(spark, sf):
    return stats.duplicate_count(dirty(spark, sf))


def _check(*checks: str):
    return lambda spark, sf: quality.dq_checks(dirty(spark, sf), checks, AS_OF, KNOWN_TICKERS)


for _name in (*quality.ALL, "spread", "ticker_domain"):
    query(f"dq_{_name}")(_check(_name))
query("dq_checks")(_check(*quality.ALL))
query("dq_validation")(_check(*quality.VALIDATION))


@query("dq_gate")
def _(spark, sf):
    reports = [
        quality.gate_report(rows).select(F.lit(name).alias("input"), "*")
        for name, rows in (("clean", trades(spark, sf)), ("dirty", dirty(spark, sf)))
    ]
    return reduce(DataFrame.unionByName, reports)


def _profiled(spark, sf) -> str:
    """The dirty trades stored in three deliveries, each of all days; after each, the days that it touched are profiled."""
    cfg = new_run(spark)
    table, path = cfg.table_path("bronze_raw_trades"), cfg.table_path("quality_profiles")
    rows = projections.bronze_enrich(dirty(spark, sf))
    side = F.coalesce("side", F.lit("none"))
    for part in (side == "buy", side == "sell", ~side.isin("buy", "sell")):
        drop = rows.where(part)
        drop.hint("rebalance", *BRONZE_PARTITIONS).write.mode("append").partitionBy(*BRONZE_PARTITIONS).parquet(table)
        touched = [r["day"] for r in drop.select(F.to_date("event_time").alias("day")).distinct().collect()]  # a row a day
        profiles.profile_days(stored(spark, cfg, "bronze_raw_trades"), touched, path, AS_OF, KNOWN_TICKERS)
    return path


@query("dq_checks_profiled")
def _(spark, sf):
    return profiles.profiled_checks(spark, _profiled(spark, sf), [*quality.ALL, "spread", "ticker_domain"])


@query("dq_gate_profiled")
def _(spark, sf):
    return quality.report_of(profiles.profiled_checks(spark, _profiled(spark, sf), quality.GATE))


@query("table_describe")
def _(spark, sf):
    """The columns of the four registered tables; of their place, what does not depend on the run."""
    cfg = _stored_batch(spark, sf, *TABLES)
    found = [tables.table_describe(spark, f"{cfg.database}.{t}") for t in TABLES]
    rows = reduce(DataFrame.unionByName, found)
    name, place = (F.element_at(F.split(c, "[./]" if c == "table_name" else "/"), -1).alias(c) for c in ("table_name", "location"))
    return rows.select("position", "col_name", "data_type", "is_partition", name, place)


@query("dq_schema_complete")
def _(spark, sf):
    return quality.dq_schema_complete(rough_payloads(spark, sf), "value")


@query("dq_timestamp_iso")
def _(spark, sf):
    rows = replay.trades_of(replay.events(spark, sf))
    text = F.date_format("event_time", replay.ISO)
    kind, value = F.col("event_type"), F.col("value")
    sent = F.when((kind == "click") & (value < 100), "bad").when((kind == "view") & (value < 10), F.lit(None))
    return quality.dq_timestamp_iso(rows.select(sent.otherwise(text).alias("timestamp")))


@query("dq_ticker_coverage")
def _(spark, sf):
    return quality.dq_ticker_coverage(trades(spark, sf), 25, "5 seconds")


# --- joins, aggregates, windows, sorts ----------------------------------------------------------


@query("anomaly_self_join")
def _(spark, sf):
    return anomaly.anomaly_self_join(trades(spark, sf), 0.01, AS_OF)


@query("anomaly_by_bucket")
def _(spark, sf):
    return gold(spark, sf)


@query("vwap_reconcile")
def _(spark, sf):
    """The 50 windows of all stored days that differ most."""
    return vwap.vwap_reconcile(*_late_layers(spark, sf))


@query("vwap_reconcile_coverage")
def _(spark, sf):
    """Every stored day; of the last, silver lacks the windows still open."""
    return vwap.vwap_reconcile_coverage_by_day(*_late_layers(spark, sf))


@query("vwap_1m_vs_5m")
def _(spark, sf):
    return vwap.vwap_1m_vs_5m(*silver_pair(spark, sf))


@query("ticker_batch_avg")
def _(spark, sf):
    return anomaly.ticker_batch_avg(trades(spark, sf))


@query("batch_vwap_recompute")
def _(spark, sf):
    return vwap.batch_vwap_recompute(bronze(spark, sf))


@query("anomaly_summary")
def _(spark, sf):
    return anomaly.anomaly_summary(gold(spark, sf))


@query("anomaly_timeline")
def _(spark, sf):
    return anomaly.anomaly_timeline(gold(spark, sf), "event_time")


@query("anomaly_rate")
def _(spark, sf):
    return anomaly.anomaly_rate(trades(spark, sf), gold(spark, sf))


@query("ticker_stats")
def _(spark, sf):
    return stats.ticker_stats(bronze(spark, sf))


@query("totals")
def _(spark, sf):
    return stats.totals(bronze(spark, sf))


@query("source_distribution")
def _(spark, sf):
    return stats.source_distribution(bronze(spark, sf))


@query("pipeline_latency")
def _(spark, sf):
    return stats.pipeline_latency(bronze(spark, sf))


@query("layer_counts")
def _(spark, sf):
    """From the footers of the stored files."""
    cfg = _stored_batch(spark, sf, *TABLES)
    return tables.footer_counts(spark, {t: cfg.table_path(t) for t in TABLES})


@query("distinct_tickers")
def _(spark, sf):
    return stats.distinct_tickers(trades(spark, sf))


@query("batch_profile")
def _(spark, sf):
    return stats.batch_profile(trades(spark, sf))


@query("top_tickers")
def _(spark, sf):
    return stats.top_tickers(trades(spark, sf))


@query("price_jump")
def _(spark, sf):
    return jumps.price_jump(trades(spark, sf))


@query("vwap_latest")
def _(spark, sf):
    return vwap.vwap_latest(silver(spark, sf))


@query("vwap_dashboard")
def _(spark, sf):
    return vwap.vwap_dashboard(silver(spark, sf))


@query("ingest_throughput")
def _(spark, sf):
    raw = replay.events(spark, sf).select(F.timestamp_micros(replay.event_micros()).alias("event_time"), "props")
    return stats.ingest_throughput(raw, "props")


# --- alert digest -------------------------------------------------------------------------------


@query("alert_summary")
def _(spark, sf):
    return alerts.alert_summary(gold_files(spark, sf), "file")


@query("alert_direction_hint")
def _(spark, sf):
    hint = fn.alert_direction_hint(F.col("avg_price"), F.col("avg_window_price")).alias("hint")
    return alerts.alert_summary(gold_files(spark, sf), "file").select("file", "ticker", hint)


@query("alert_digest")
def _(spark, sf):
    return alerts.alert_digest(gold_files(spark, sf), "file")


@query("alert_subject")
def _(spark, sf):
    return alerts.alert_digest(gold_files(spark, sf), "file").where("ticker IS NULL").select("file", "subject")

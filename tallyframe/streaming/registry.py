"""Live operators on the test bed's ``events`` table, registered as queries.

Mapping: ``event_type`` is the region, ``user_id`` the ballot box, ``value``
the box counter, ``ts`` the event time.  Each entry streams the table from
``sf_dir`` (file source, only ``events.parquet``), runs to completion with an
``availableNow`` trigger, and returns the sink's files as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.plans.registry import query
from tallyframe.plans.testbed import TESTBED, results_wide
from tallyframe.sources.parquet import read_table
from tallyframe.sources.tables import materialize
from tallyframe.streaming import live
from tallyframe.streaming.accounts import late_rows
from tallyframe.streaming.replay import feed_stream, sent_twice, staged_feed
from tallyframe.streaming.runner import run_available, table_stream

EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")
WINDOW = "1 hour"
SLIDE_SIZE, SLIDE_STEP = "2 hours", "1 hour"
DELAY = "10 minutes"
SESSION_GAP = "30 minutes"
# Part files of one micro-batch: a long history is caught up in steps of bounded size.
MAX_FILES_PER_TRIGGER = 1000


def _state_partitions(spark) -> int:
    """State stores per stateful operator: one per core of the cluster, so they grow with it."""
    try:
        return max(1, spark.sparkContext.defaultParallelism)
    except Exception:  # a session without a local SparkContext (e.g. Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _run(stream, name, **kw):
    return run_available(stream, name, state_partitions=_state_partitions(stream.sparkSession), **kw).result


def events_stream(spark, sf_dir):
    # Event times are timestamp_ntz; the cast to timestamp (needed by the
    # watermark) and back is the identity only in UTC.
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
        spark = spark.newSession()        # the caller's session keeps its own setting
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return live.with_event_time(table_stream(spark, sf_dir, "events", EVENTS_SCHEMA, MAX_FILES_PER_TRIGGER), "ts")


@query
def stream_tumbling_counts(spark, sf_dir):
    s = live.tumbling_counts(events_stream(spark, sf_dir), ["event_type"], WINDOW, DELAY, value="value")
    return _run(s, "tumbling")


@query
def stream_sliding_counts(spark, sf_dir):
    s = live.sliding_counts(events_stream(spark, sf_dir), ["event_type"], SLIDE_SIZE, SLIDE_STEP, DELAY,
                            value="value")
    return _run(s, "sliding")


@query
def stream_running_totals(spark, sf_dir):
    s = live.running_totals(events_stream(spark, sf_dir), ["event_type"], value="value")
    return _run(s, "running", output_mode="complete")


def placed_events(spark, sf_dir):
    """Each event with its box's province and community (null for a box that is no customer)."""
    s = events_stream(spark, sf_dir)
    spark = s.sparkSession
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    places = (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
                      .join(region, nation.n_regionkey == region.r_regionkey)
                      .select("c_custkey", F.col("n_name").alias(TESTBED.province),
                              F.col("r_name").alias(TESTBED.community)))
    return s.join(places, s.user_id == places.c_custkey, "left")


@query
def stream_level_totals(spark, sf_dir):
    s = live.level_totals(placed_events(spark, sf_dir),
                          {"total": None, "community": TESTBED.community, "province": TESTBED.province,
                           "box": "user_id"}, value="value")
    return _run(s, "levels", output_mode="complete")


@query
def stream_turnout_rate(spark, sf_dir):
    s = placed_events(spark, sf_dir)
    # A stream-static join reads its static side in every micro-batch: store the census, one row per community.
    census = materialize(results_wide(s.sparkSession, sf_dir).groupBy(TESTBED.community)
                         .agg(F.sum(TESTBED.census).alias(TESTBED.census)), "census")
    return _run(live.windowed_turnout(s, census, [TESTBED.community], WINDOW, DELAY, TESTBED.census), "turnout")


@query
def stream_reported_gap(spark, sf_dir):
    # The boxes relay a running total of their group: here the event number, which only grows.
    s = live.latest_counter(events_stream(spark, sf_dir), "user_id", "value", keys=["event_type"],
                            reported="event_id")
    return _run(s, "reported_gap", output_mode="complete",
                batch_transform=lambda b: live.group_from_counters(b, ["event_type"])
                .withColumn("gap", F.round("gap", 6)))


@query
def stream_latest_counter(spark, sf_dir):
    s = live.latest_counter(events_stream(spark, sf_dir), "user_id", "value")
    return _run(s, "latest", output_mode="complete")


@query
def stream_group_from_counters(spark, sf_dir):
    s = live.latest_counter(events_stream(spark, sf_dir), "user_id", "value", keys=["event_type"])
    return _run(s, "group_counters", output_mode="complete",
                         batch_transform=lambda b: live.group_from_counters(b, ["event_type"]))


@query
def stream_windowed_group_counters(spark, sf_dir):
    s = live.windowed_group_from_counters(events_stream(spark, sf_dir), "user_id", "value", ["event_type"],
                                          WINDOW, DELAY)
    s = s.withColumn("sum_counters", F.round("sum_counters", 6))
    return _run(s, "windowed_counters")


@query
def stream_dedup(spark, sf_dir):
    # Every message arrives twice: once on the main feed, once re-sent.
    cols = ["event_id", "ts", "user_id", "event_type", "value", live.EVENT_TIME]
    both = events_stream(spark, sf_dir).select(*cols).unionByName(events_stream(spark, sf_dir).select(*cols))
    s = live.dedup(both, ["event_id"], DELAY).drop(live.EVENT_TIME)
    return _run(s, "dedup")


@query
def stream_sessions(spark, sf_dir):
    s = live.sessions(events_stream(spark, sf_dir), "user_id", SESSION_GAP, DELAY)
    return _run(s, "sessions")



# ----------------------------------------------------------------- feeds with resent, delayed and broken messages
FEED_SLICES = 6                  # at least; a slice is one file and one micro-batch
ROWS_PER_SLICE = 1_000_000
LATE_SLICES = 8
SILENCE = "5 days"
LEVELS = {"total": None, "region": "event_type", "box": "user_id"}


def _slices(events) -> int:
    return max(FEED_SLICES, -(-events.count() // ROWS_PER_SLICE))


def _feed(spark, sf_dir, delivery, slices, name, columns=("event_id", "ts", "user_id", "event_type", "value")):
    events = read_table(spark, sf_dir, "events", list(columns))
    folder = staged_feed(events, "ts", slices or _slices(events), delivery, name)
    schema = ", ".join(f for f in EVENTS_SCHEMA.split(", ") if f.split()[0] in columns)
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
        spark = spark.newSession()
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return live.with_event_time(feed_stream(spark, folder, schema), "ts")


@query
def stream_dedup_totals(spark, sf_dir):
    # Every message is sent again one micro-batch later; the totals count it once.
    feed = _feed(spark, sf_dir, sent_twice, None, "resent")
    return _run(live.dedup_totals(feed, ["event_id"], LEVELS, WINDOW, DELAY, value="value"), "dedup_totals")


@query
def stream_late_rows(spark, sf_dir):
    # Every tenth message arrives two micro-batches late, beyond the delay.
    late = F.when(F.col("event_id") % 10 == 0, 2).otherwise(0)
    feed = _feed(spark, sf_dir, lambda own: F.array(own + late), LATE_SLICES, "delayed")
    once = live.dedup(feed, ["event_id"], DELAY).select("event_id")
    run = run_available(once, "late_rows", state_partitions=_state_partitions(spark))
    return late_rows(run.account)


@query
def stream_silent_boxes(spark, sf_dir):
    s = events_stream(spark, sf_dir)
    boxes = materialize(read_table(spark, sf_dir, "customer", ["c_custkey"]).select(F.col("c_custkey").alias("user_id")), "boxes")
    schema = StructType.fromDDL("user_id BIGINT, last_seen TIMESTAMP_NTZ, n_messages BIGINT, as_of TIMESTAMP_NTZ, status STRING")
    return _run(live.latest_counter(s, "user_id", "value"), "silent", output_mode="complete", schema=schema,
                batch_transform=lambda b: live.silent_boxes(b, boxes, "user_id", SILENCE, DELAY))


def raw_messages(spark, sf_dir):
    """Every event as the text that a box would send; by its number, some are broken."""
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    kind = F.col("event_id") % 20
    box, number = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    line = F.to_json(F.struct(
        F.when(kind == 5, "soon").otherwise(F.col("ts").cast("string")).alias("timestamp"),
        F.when(kind != 2, box).alias("mesa_id"), F.col("event_type").alias("municipio_id"),
        F.when(kind == 3, F.concat(F.lit("-"), number)).when(kind == 4, F.concat(number, F.lit("x"))).otherwise(number).alias("mesa_participacion"),
        F.when(kind != 6, number).alias("total_municipio")))
    return events.select("ts", F.when(kind == 1, F.substring(line, 1, 30)).when(kind != 7, line).alias("line"))


@query
def stream_message_intake(spark, sf_dir):
    messages = raw_messages(spark, sf_dir)
    folder = staged_feed(messages, "ts", _slices(messages), name="messages")
    parsed = live.parse_messages(feed_stream(spark, folder, "ts TIMESTAMP_NTZ, line STRING"))
    s = parsed.select(live.ntz("timestamp").alias("sent_at"), "mesa_id", "municipio_id", "mesa_participacion", "total_municipio",
                      F.col("raw").isNotNull().alias("kept_raw"), "reason", "status")
    return _run(s, "intake", partition_by=["status"])


@query
def stream_turnout_curve(spark, sf_dir):
    s = placed_events(spark, sf_dir)
    levels = {"total": None, "community": TESTBED.community, "province": TESTBED.province}
    base = materialize(results_wide(s.sparkSession, sf_dir).select(TESTBED.community, TESTBED.province, TESTBED.census), "census_base")
    census = materialize(live.at_levels(base, levels).groupBy("level", "key").agg(F.sum(TESTBED.census).alias("census")), "census")
    closed = live.windowed_level_counts(s, levels, WINDOW, DELAY)
    schema = StructType.fromDDL(live.CURVE_SCHEMA)
    return _run(closed, "turnout_curve", batch_fold=live.turnout_so_far(census), schema=schema)

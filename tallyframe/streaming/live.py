"""Live participation operators on Structured Streaming.

Each function takes a streaming DataFrame of messages and returns a
streaming DataFrame; :mod:`tallyframe.streaming.runner` runs them.  State is
bounded: windowed aggregates and sessions are evicted by the watermark, and
the non-windowed ones are keyed by box or region (a fixed population of
keys: 60,000 boxes for a national election).

Event times arrive as ``timestamp_ntz`` in the test tables; ``withWatermark``
needs ``timestamp``, so :func:`with_event_time` casts (the session time zone
must be UTC for the cast to be the identity) and :func:`ntz` casts back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from tallyframe.functions.numeric import pct

# The live message of a ballot box (one per vote); counters are cumulative and
# never fall.
MESSAGE_SCHEMA = StructType([
    StructField("timestamp", TimestampType()),
    StructField("mesa_id", StringType()),
    StructField("municipio_id", StringType()),
    StructField("provincia", StringType()),
    StructField("comunidad", StringType()),
    StructField("mesa_participacion", LongType()),
    StructField("total_municipio", LongType()),
])

EVENT_TIME = "event_time"


def with_event_time(df: DataFrame, ts: str, out: str = EVENT_TIME) -> DataFrame:
    return df.withColumn(out, F.col(ts).cast("timestamp"))


def ntz(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def _value_aggs(value: str | None) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("n_events")]
    if value:
        aggs.append(F.sum(value).alias("_sum"))
    return aggs


def _finish(df: DataFrame, value: str | None, digits: int = 6) -> DataFrame:
    return df.withColumn("sum_value", F.round("_sum", digits)).drop("_sum") if value else df


def tumbling_counts(stream: DataFrame, keys: Sequence[str], size: str, delay: str,
                    value: str | None = None, ts: str = EVENT_TIME) -> DataFrame:
    """Messages (and Σ value) per fixed window and key; a window is emitted once
    the watermark passes its end (append mode), then its state is dropped."""
    agg = (stream.withWatermark(ts, delay)
                 .groupBy(F.window(ts, size).alias("w"), *keys)
                 .agg(*_value_aggs(value)))
    out = agg.select(ntz("w.start").alias("window_start"), ntz("w.end").alias("window_end"), *keys,
                     "n_events", *(["_sum"] if value else []))
    return _finish(out, value)


def sliding_counts(stream: DataFrame, keys: Sequence[str], size: str, slide: str, delay: str,
                   value: str | None = None, ts: str = EVENT_TIME) -> DataFrame:
    """Overlapping windows (``size`` every ``slide``): a moving rate."""
    agg = (stream.withWatermark(ts, delay)
                 .groupBy(F.window(ts, size, slide).alias("w"), *keys)
                 .agg(*_value_aggs(value)))
    out = agg.select(ntz("w.start").alias("window_start"), ntz("w.end").alias("window_end"), *keys,
                     "n_events", *(["_sum"] if value else []))
    return _finish(out, value)


def running_totals(stream: DataFrame, keys: Sequence[str], value: str | None = None) -> DataFrame:
    """Totals since the start per key (complete or update mode; state = one row per key)."""
    agg = stream.groupBy(*keys).agg(*_value_aggs(value))
    return _finish(agg, value)


def level_totals(stream: DataFrame, levels: Mapping[str, str | None], value: str | None = None) -> DataFrame:
    """Totals since the start at several levels at once (complete or update mode).

    ``levels`` maps a level's name to its column, or to None for the grand
    total (key ``""``).  Each message counts once at every level; the map-side
    combine leaves one row per task and key, so the grand total is no hot key.
    A message without a place at some level counts under a null key there.
    """
    return running_totals(at_levels(stream, levels).select("level", "key", *([value] if value else [])), ["level", "key"], value)


def at_levels(stream: DataFrame, levels: Mapping[str, str | None]) -> DataFrame:
    """Each message once per level, with ``level`` and ``key`` (``""`` for a level without a column)."""
    entries = [F.struct(F.lit(name).alias("level"), (F.lit("") if c is None else F.col(c).cast("string")).alias("key"))
               for name, c in levels.items()]
    return stream.withColumn("at", F.explode(F.array(*entries))).select("*", "at.level", "at.key").drop("at")


def dedup_totals(stream: DataFrame, ids: Sequence[str], levels: Mapping[str, str | None], size: str, delay: str,
                 value: str | None = None, ts: str = EVENT_TIME) -> DataFrame:
    """Totals per fixed window at several levels that survive resends (append mode).

    Two chained stateful operators under one watermark: the first copy of every
    message (by ``ids``) passes, later copies within ``delay`` are dropped as
    duplicates and those beyond it as late; what passes is counted per window,
    level and key.  Both states are evicted by the watermark.
    """
    once = dedup(stream.select(*dict.fromkeys([*ids, ts, *[c for c in levels.values() if c], *([value] if value else [])])), ids, delay, ts)
    agg = at_levels(once, levels).groupBy(F.window(ts, size).alias("w"), "level", "key").agg(*_value_aggs(value))
    out = agg.select(ntz("w.start").alias("window_start"), ntz("w.end").alias("window_end"), "level", "key",
                     "n_events", *(["_sum"] if value else []))
    return _finish(out, value)


def silent_boxes(latest: DataFrame, boxes: DataFrame, box: str, gap: str, delay: str) -> DataFrame:
    """Batch step over the latest-counter table: the state of every box of the static list ``boxes`` (column ``box``).

    ``as_of`` is the watermark, the latest message of all boxes less ``delay``.
    A box is ``silent`` if it sent nothing in the ``gap`` before ``as_of``,
    ``never`` if it was never heard of, ``unlisted`` if it sends without being
    on the list, else ``active``.  Before any message every box is ``never``.
    """
    newest = latest.agg(F.max("last_seen")).first()[0]            # one row of an aggregate with one row per box
    as_of = F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
    listed = boxes.select(F.col(box).alias("_listed")).distinct()
    known = latest.select(F.col(box).alias("_seen"), "last_seen", "n_messages")
    both = listed.join(known, F.col("_listed") == F.col("_seen"), "full")
    status = (F.when(F.col("_listed").isNull(), "unlisted").when(F.col("_seen").isNull(), "never")
              .when(F.col("last_seen") + F.expr(f"INTERVAL {gap}") <= as_of, "silent").otherwise("active"))
    return both.select(F.coalesce("_listed", "_seen").alias(box), "last_seen",
                       F.coalesce("n_messages", F.lit(0)).alias("n_messages"), as_of.alias("as_of"), status.alias("status"))


def windowed_level_counts(stream: DataFrame, levels: Mapping[str, str | None], size: str, delay: str, ts: str = EVENT_TIME) -> DataFrame:
    """Messages per fixed window, level and key, once the window is closed (append mode)."""
    return tumbling_counts(at_levels(stream, levels).select(ts, "level", "key"), ["level", "key"], size, delay, ts=ts)


def turnout_so_far(census: DataFrame):
    """Fold for ``run_available``: votes up to the end of every closed window over the census (``level``, ``key``, ``census``).

    The carry holds the votes of all earlier batches, one row per level and
    key.  Windows close in order, so a batch's windows come after those of the
    carry; inside a batch a running sum per key goes over its few windows.
    """
    def fold(batch: DataFrame, carry: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        if carry is None:
            carry = batch.select("level", "key", F.lit(0).cast("long").alias("votes")).limit(0)
        same = lambda a, b: a["level"].eqNullSafe(b["level"]) & a["key"].eqNullSafe(b["key"])      # noqa: E731
        running = F.sum("n_events").over(Window.partitionBy("level", "key").orderBy("window_end"))
        closed = batch.select("window_start", "window_end", "level", "key", F.col("n_events").alias("n_votes"), running.alias("_in_batch"))
        sofar = closed.join(carry, same(closed, carry), "left").select(
            closed["*"], (F.col("_in_batch") + F.coalesce("votes", F.lit(0))).alias("votes_so_far"))
        rows = sofar.join(census, same(sofar, census), "left").select(
            "window_start", "window_end", sofar["level"], sofar["key"], "n_votes", "votes_so_far", "census",
            pct("votes_so_far", "census").alias("turnout"))
        added = batch.select("level", "key", F.col("n_events").alias("votes")).unionByName(carry)
        return rows, added.groupBy("level", "key").agg(F.sum("votes").alias("votes"))

    return fold


CURVE_SCHEMA = ("window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, level STRING, key STRING, n_votes BIGINT, "
                "votes_so_far BIGINT, census BIGINT, turnout DOUBLE")


def parse_messages(lines: DataFrame, line: str = "line") -> DataFrame:
    """Typed messages of :data:`MESSAGE_SCHEMA` from JSON text, each row ``good`` or ``bad`` (``status``) with the ``reason``.

    A line that is no JSON object, lacks its time, box or counter, has one that
    does not parse, or a counter below zero is bad: it keeps its text in ``raw``
    and has no fields.  The first reason in this order counts: malformed,
    missing, bad time, bad number, negative.  Other fields may be missing.  Written with
    ``partition_by=["status"]``, both branches are one commit of the file sink.
    """
    names = [f.name for f in MESSAGE_SCHEMA]
    texts = StructType([StructField(n, StringType()) for n in [*names, "_corrupt"]])
    parsed = lines.withColumn("_m", F.from_json(line, texts, {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}))
    typed = {f.name: (F.col(f"_m.{f.name}").try_cast(f.dataType)) for f in MESSAGE_SCHEMA}
    required, counters = ("timestamp", "mesa_id", "mesa_participacion"), ("mesa_participacion", "total_municipio")

    def any_of(conditions: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, conditions)

    unread = lambda c: F.col(f"_m.{c}").isNotNull() & typed[c].isNull()      # noqa: E731
    reason = (F.when(F.col(line).isNull() | F.col("_m").isNull() | F.col("_m._corrupt").isNotNull(), "malformed")
              .when(any_of([F.col(f"_m.{c}").isNull() for c in required]), "missing")
              .when(unread("timestamp"), "bad time")
              .when(any_of([unread(c) for c in counters]), "bad number")
              .when(any_of([F.coalesce(typed[c] < 0, F.lit(False)) for c in counters]), "negative"))
    return parsed.withColumn("reason", reason).select(
        *[F.when(F.col("reason").isNull(), typed[n]).alias(n) for n in names],
        F.when(F.col("reason").isNull(), "good").otherwise("bad").alias("status"), "reason",
        F.when(F.col("reason").isNotNull(), F.col(line)).alias("raw"))


def windowed_turnout(stream: DataFrame, census: DataFrame, keys: Sequence[str], size: str, delay: str,
                     census_col: str = "census", ts: str = EVENT_TIME) -> DataFrame:
    """Votes per fixed window and key over the key's census: the live participation rate.

    ``census`` is a static table, one row per key; it is joined to the closed
    windows, not to the messages.  Keys without a census have no rate (null).
    """
    votes = tumbling_counts(stream, keys, size, delay, ts=ts).withColumnRenamed("n_events", "n_votes")
    joined = votes.join(census.select(*keys, census_col), on=list(keys), how="left")
    return joined.select("window_start", "window_end", *keys, "n_votes", census_col,
                         pct("n_votes", census_col).alias("turnout"))


def latest_counter(stream: DataFrame, box: str, counter: str, keys: Sequence[str] = (),
                   ts: str = EVENT_TIME, reported: str | None = None) -> DataFrame:
    """Latest cumulative counter per box.  Counters only grow, so ``max`` is the
    latest value whatever order messages arrive in, and a resent message
    changes nothing.  ``reported`` (a cumulative total the box relays for its
    group, such as the municipality's count) is kept the same way."""
    aggs = [F.max(counter).alias("counter"), ntz(F.max(ts)).alias("last_seen"),
            F.count(F.lit(1)).alias("n_messages")]
    if reported:
        aggs.append(F.max(reported).alias("reported"))
    return stream.groupBy(*keys, box).agg(*aggs)


def group_from_counters(latest: DataFrame, group: Sequence[str], digits: int = 6) -> DataFrame:
    """Batch step over the latest-counter table: Σ of the boxes' counters per group.

    When the table carries ``reported`` (see :func:`latest_counter`), the
    group's latest reported total and the gap to the summed counters are added:
    a check that the group total relayed by the boxes agrees with the boxes.
    """
    aggs = [F.count(F.lit(1)).alias("n_boxes"), F.round(F.sum("counter"), digits).alias("sum_counters")]
    has_reported = "reported" in latest.columns
    if has_reported:
        aggs.append(F.max("reported").alias("reported_total"))
    out = latest.groupBy(*group).agg(*aggs)
    if has_reported:
        out = out.withColumn("gap", F.col("reported_total") - F.col("sum_counters"))
    return out


def windowed_group_from_counters(stream: DataFrame, box: str, counter: str, group: Sequence[str],
                                 size: str, delay: str, ts: str = EVENT_TIME) -> DataFrame:
    """Per window: the latest counter of every box active in it, summed per group.

    Two chained stateful aggregates in append mode: the first keeps one row
    per (window, group, box), the second regroups the first's output by the
    same window (``window_time``) and group.  Both are evicted by the
    watermark, so state stays bounded.  This counts only boxes that sent a
    message in the window; for the running total of all boxes use
    :func:`latest_counter` + :func:`group_from_counters`.
    """
    per_box = (stream.withWatermark(ts, delay)
                     .groupBy(F.window(ts, size).alias("w"), *group, box)
                     .agg(F.max(counter).alias("counter")))
    per_group = (per_box.groupBy(F.window(F.window_time("w"), size).alias("w2"), *group)
                        .agg(F.count(F.lit(1)).alias("n_boxes"), F.sum("counter").alias("sum_counters")))
    return per_group.select(ntz("w2.start").alias("window_start"), ntz("w2.end").alias("window_end"), *group,
                            "n_boxes", "sum_counters")


def dedup(stream: DataFrame, keys: Sequence[str], delay: str, ts: str = EVENT_TIME) -> DataFrame:
    """Drop resent messages: the first copy of each key within the watermark
    delay passes; state for a key is dropped once the watermark passes it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def sessions(stream: DataFrame, key: str, gap: str, delay: str, ts: str = EVENT_TIME) -> DataFrame:
    """Activity sessions per key: a silence longer than ``gap`` closes a session
    (a box that went quiet)."""
    agg = (stream.withWatermark(ts, delay)
                 .groupBy(F.session_window(ts, gap).alias("s"), key)
                 .agg(F.count(F.lit(1)).alias("n_events")))
    return agg.select(key, ntz("s.start").alias("session_start"), ntz("s.end").alias("session_end"), "n_events")

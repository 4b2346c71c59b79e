"""Live feeds with resent, delayed and broken messages, over several micro-batches."""

import datetime as dt
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from tallyframe.streaming import live
from tallyframe.streaming.accounts import late_rows, read_account
from tallyframe.streaming.replay import SLICE, feed_stream, on_time, sent_twice, staged_feed
from tallyframe.streaming.runner import run_available, start_live
from tests.conftest import rows
from tests.test_streaming import HOUR1, HOUR2, HOUR3, hourly, msg, stage, stream_of

T0 = dt.datetime(2024, 1, 1)


def messages(spark, n, minutes=7):
    return spark.createDataFrame([(k, T0 + dt.timedelta(minutes=minutes * k), k % 4, "ab"[k % 2]) for k in range(n)],
                                 "id BIGINT, ts TIMESTAMP_NTZ, box BIGINT, region STRING")


SCHEMA = "id BIGINT, ts TIMESTAMP_NTZ, box BIGINT, region STRING"


def feed(spark, folder):
    return live.with_event_time(feed_stream(spark, folder, SCHEMA), "ts")


def test_staged_feed_delivers_slices_in_order(spark):
    df = messages(spark, 100)
    folder = staged_feed(df, "ts", 5, sent_twice)
    back = spark.read.parquet(folder)
    assert back.count() == 200 and {r[0] for r in back.select(SLICE).distinct().collect()} == set(range(6))
    run = run_available(feed_stream(spark, folder, SCHEMA), "t_feed")
    sizes = [r["input_rows"] for r in run.account.orderBy("batch_id").collect() if r["input_rows"]]
    assert sizes == [20, 40, 40, 40, 40, 20]
    empty = staged_feed(df.limit(0), "ts", 5, on_time)
    assert not os.path.isdir(empty) or spark.read.schema(SCHEMA).parquet(empty).count() == 0


def test_totals_survive_resends_in_other_batches(spark):
    folder = staged_feed(messages(spark, 200), "ts", 6, sent_twice)
    levels = {"total": None, "region": "region", "box": "box"}
    run = run_available(live.dedup_totals(feed(spark, folder), ["id"], levels, "1 hour", "10 minutes"), "t_totals")
    closed = T0 + dt.timedelta(minutes=7 * 199 - 10)
    want = {}
    for k in range(200):
        start = T0 + dt.timedelta(hours=7 * k // 60)
        if start + dt.timedelta(hours=1) <= closed:
            for level, key in (("total", ""), ("region", "ab"[k % 2]), ("box", str(k % 4))):
                want[start, level, key] = want.get((start, level, key), 0) + 1
    assert {(r["window_start"], r["level"], r["key"]): r["n_events"] for r in run.result.collect()} == want
    twice = run_available(live.windowed_level_counts(feed(spark, folder), levels, "1 hour", "10 minutes"), "t_totals_plain")
    assert twice.result.agg(F.sum("n_events")).first()[0] > sum(want.values())      # without the dedup some count double


def test_late_rows_are_exact_over_150_batches(spark):
    """More batches than the progress updates that Spark keeps."""
    df = messages(spark, 450)
    late = F.when(F.col("id") % 5 == 0, 2).otherwise(0)
    folder = staged_feed(df, "ts", 152, lambda own: F.array(own + late))
    run = run_available(live.dedup(feed(spark, folder), ["id"], "1 minute").select("id"), "t_late_rows", state_partitions=1)
    assert len(run.progress) <= 100
    got = {r["batch_id"]: (r["input_rows"], r["late_rows"]) for r in late_rows(run.account).collect()}
    slices = {}
    for r in spark.read.parquet(folder).collect():
        slices.setdefault(r[SLICE], []).append(r["ts"])
    want, marks = {}, []
    for batch, (_, times) in enumerate(sorted(slices.items())):
        mark = marks[batch - 2] if batch > 1 else dt.datetime.min
        want[batch] = (len(times), sum(t <= mark for t in times))
        marks.append(max([*marks[-1:], max(times) - dt.timedelta(minutes=1)]))
    assert len(want) >= 150 and got == want
    assert run.input_rows == 450 and run.rows_dropped_by_watermark == sum(n for _, n in want.values()) == 450 - run.result.count() > 50


def test_account_of_a_live_query_that_is_started_again(spark, scratch):
    folder, base = stage(os.path.join(scratch, "in"), [HOUR1]), os.path.join(scratch, "q")
    for batch, more in enumerate(([], [HOUR2, HOUR3])):
        stage(folder, more, first=1)
        query = start_live(hourly(spark, folder), "t_again", base, trigger="0 seconds")
        query.processAllAvailable()
        query.stop()
    deadline = dt.datetime.now() + dt.timedelta(seconds=30)
    while read_account(spark, f"{base}/account").agg(F.sum("input_rows")).first()[0] != 9 and dt.datetime.now() < deadline:
        threading.Event().wait(0.2)
    account = late_rows(read_account(spark, f"{base}/account")).orderBy("batch_id").collect()
    assert [r["input_rows"] for r in account] == [3, 3, 3]


def test_two_streams_started_at_once_keep_their_own_state_partitions(spark, scratch):
    found, before = {}, spark.conf.get("spark.sql.shuffle.partitions")

    def go(n):
        folder = stage(os.path.join(scratch, f"in{n}"), [HOUR1, HOUR2])
        run = run_available(hourly(spark, folder), f"t_parts{n}", state_partitions=n)
        found[n] = {int(op["numShufflePartitions"]) for p in run.progress for op in p.get("stateOperators", [])}

    threads = [threading.Thread(target=go, args=(n,)) for n in (2, 3, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert found == {2: {2}, 3: {3}, 5: {5}} and spark.conf.get("spark.sql.shuffle.partitions") == before


def test_silent_never_and_unlisted_boxes(spark, scratch):
    batches = [[msg(0, "a", 1), msg(1, "b", 1)], [msg(100, "b", 2), msg(101, "x", 1)]]
    s = live.with_event_time(stream_of(spark, stage(os.path.join(scratch, "in"), batches)), "timestamp")
    boxes = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), (None,)], "mesa_id STRING")
    run = run_available(live.latest_counter(s, "mesa_id", "mesa_participacion"), "t_silent", output_mode="complete",
                        batch_transform=lambda b: live.silent_boxes(b, boxes.where("mesa_id IS NOT NULL"), "mesa_id", "1 hour", "10 minutes"),
                        schema=spark.createDataFrame([], "mesa_id STRING, last_seen TIMESTAMP_NTZ, n_messages BIGINT, as_of TIMESTAMP_NTZ, status STRING").schema)
    assert rows(run.result, "mesa_id", "n_messages", "status") == [("a", 1, "silent"), ("b", 2, "active"), ("c", 0, "never"), ("x", 1, "unlisted")]
    assert {r["as_of"].minute for r in run.result.collect()} == {31}                # 10:41 less ten minutes
    nothing = spark.createDataFrame([], "mesa_id STRING, counter BIGINT, last_seen TIMESTAMP_NTZ, n_messages BIGINT")
    out = live.silent_boxes(nothing, boxes.where("mesa_id IS NOT NULL"), "mesa_id", "1 hour", "10 minutes")
    assert rows(out, "mesa_id", "status") == [("a", "never"), ("b", "never"), ("c", "never")]


def test_turnout_so_far_carries_votes_and_replays_a_batch(spark):
    census = spark.createDataFrame([("total", "", 10), ("region", "a", 4), ("region", "z", 3)], "level STRING, key STRING, census BIGINT")
    fold = live.turnout_so_far(census)
    w = [T0 + dt.timedelta(hours=k) for k in range(5)]

    def closed(*votes):
        return spark.createDataFrame([(w[k], w[k + 1], lv, key, n) for k, lv, key, n in votes],
                                     "window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, level STRING, key STRING, n_events BIGINT")

    first, carry = fold(closed((0, "total", "", 3), (0, "region", "a", 2), (0, "region", None, 1), (1, "total", "", 1)), None)
    assert rows(first.where("level = 'total'"), "n_votes", "votes_so_far", "turnout") == [(1, 4, 40.0), (3, 3, 30.0)]
    later = closed((3, "total", "", 2), (3, "region", None, 1), (2, "region", "a", 2))
    for _ in range(2):                                                               # the same carry gives the same rows again
        second, total = fold(later, carry)
        assert sorted((r["level"], "?" if r["key"] is None else r["key"], r["votes_so_far"], r["turnout"]) for r in second.collect()) == [
            ("region", "?", 2, None), ("region", "a", 4, 100.0), ("total", "", 6, 60.0)]
    assert sorted((r["level"], "?" if r["key"] is None else r["key"], r["votes"]) for r in total.collect()) == [("region", "?", 2), ("region", "a", 4), ("total", "", 6)]


def test_turnout_curve_over_several_batches(spark):
    folder = staged_feed(messages(spark, 300), "ts", 7)
    census = spark.createDataFrame([("total", "", 300)], "level STRING, key STRING, census BIGINT")
    closed = live.windowed_level_counts(feed(spark, folder), {"total": None}, "1 hour", "10 minutes")
    from pyspark.sql.types import StructType

    run = run_available(closed, "t_curve", batch_fold=live.turnout_so_far(census), schema=StructType.fromDDL(live.CURVE_SCHEMA))
    got = [(r["window_end"], r["votes_so_far"]) for r in run.result.orderBy("window_end").collect()]
    ends = [T0 + dt.timedelta(hours=h) for h in range(1, 100) if T0 + dt.timedelta(hours=h) <= T0 + dt.timedelta(minutes=7 * 299 - 10)]
    assert got == [(e, sum(T0 + dt.timedelta(minutes=7 * k) < e for k in range(300))) for e in ends]


def test_message_intake_good_and_bad_add_up(spark):
    ok = {"timestamp": "2024-11-24T09:00:00Z", "mesa_id": "a", "municipio_id": "28079", "provincia": "Madrid", "comunidad": "Madrid",
          "mesa_participacion": "3", "total_municipio": "30"}
    lines = [(json.dumps(ok), None), (json.dumps({**ok, "mesa_participacion": 4, "extra": [1]}), None), (json.dumps({**ok, "total_municipio": None}), None),
             (None, "malformed"), ("", "malformed"), ("{\"timestamp\": \"2024", "malformed"), ("[1, 2]", "malformed"),
             (json.dumps({k: v for k, v in ok.items() if k != "mesa_id"}), "missing"), ("{}", "missing"),
             (json.dumps({**ok, "timestamp": "now-ish"}), "bad time"), (json.dumps({**ok, "mesa_participacion": "3x"}), "bad number"),
             (json.dumps({**ok, "total_municipio": "3.5.1"}), "bad number"), (json.dumps({**ok, "mesa_participacion": "-1"}), "negative")]
    df = spark.createDataFrame([(T0 + dt.timedelta(minutes=k), line, want) for k, (line, want) in enumerate(lines)],
                               "ts TIMESTAMP_NTZ, line STRING, want STRING")
    batch = live.parse_messages(df.select("line")).collect()
    assert sorted((r["raw"] or "") for r in batch if r["status"] == "bad") == sorted((line or "") for line, want in lines if want)
    folder = staged_feed(df, "ts", 4)
    run = run_available(live.parse_messages(feed_stream(spark, folder, "ts TIMESTAMP_NTZ, line STRING, want STRING")), "t_intake",
                        partition_by=["status"])
    got = run.result.collect()
    assert len(got) == len(lines) and sorted((r["reason"] or "") for r in got) == sorted((want or "") for _, want in lines)
    good = [r for r in got if r["status"] == "good"]
    assert len(good) == 3 and {r["mesa_participacion"] for r in good} == {3, 4} and all(r["raw"] is None for r in good)
    assert all(r["mesa_id"] is None and r["timestamp"] is None for r in got if r["status"] == "bad")


def test_fold_needs_append_mode(spark, scratch):
    s = stream_of(spark, stage(os.path.join(scratch, "in"), [HOUR1]))
    with pytest.raises(ValueError, match="batch_fold"):
        run_available(s, "t_bad", output_mode="complete", batch_fold=lambda b, c: (b, b))

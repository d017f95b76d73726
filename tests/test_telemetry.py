import json
import os

import pytest
from pyspark.sql import functions as F

from lodestone.operators.upsert import merge
from lodestone.plans.telemetry import bucket_paths, drop_old_loads, load_tables, refresh_views, run_telemetry
from lodestone.sources import eventlog
from lodestone.streaming.ingest import compact, ingest_new_files, read_ingested


def trace(query_id, **changes):
    return {
        "event_type": "trace", "query_id": query_id, "timestamp": "2026-08-01T10:00:00+00:00",
        "question": "which parts are red?", "sql": "SELECT 2 AS n", "succeeded": True, "error": None,
        "attempt_count": 1, "row_count": 1, "latency_seconds": 0.25, "model": "small-model", "usage": {}, **changes,
    }


def vote(query_id, value, time):
    return {"event_type": "feedback", "query_id": query_id, "timestamp": f"2026-08-01T10:{time}+00:00", "vote": value}


def log(folder, name, *records, extra=""):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records) + extra)
    return str(folder)


def test_usage_is_flattened(spark, tmp_path):
    path = log(tmp_path / "log", "a.json", trace("q1", usage={"total_tokens": 99}))
    row = eventlog.traces_of(eventlog.read_log(spark, path)).first()
    assert (row.usage__total_tokens, row.usage__prompt_tokens) == (99, None)


def test_columns_that_are_null_everywhere_keep_their_type(spark, tmp_path):
    path = log(tmp_path / "log", "a.json", trace("q1", error=None, sql=None))
    types = dict(eventlog.traces_of(eventlog.read_log(spark, path)).dtypes)
    assert types["error"] == types["sql"] == "string" and types["usage__prompt_tokens"] == "bigint"


def test_blank_lines_and_unknown_events_are_passed_over(spark, tmp_path):
    path = log(tmp_path / "log", "a.json", trace("q1"), {"event_type": "other", "query_id": "x"}, extra="\n  \n")
    events = eventlog.read_log(spark, path)
    assert eventlog.traces_of(events).count() == 1 and eventlog.feedback_of(events).count() == 0


def test_malformed_line_fails_or_is_kept_apart(spark, tmp_path):
    path = log(tmp_path / "log", "a.json", trace("q1"), extra="{broken\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        eventlog.read_log(spark, path).collect()
    kept = eventlog.read_log(spark, path, quarantine=True).collect()
    assert [r[eventlog.CORRUPT] for r in kept] == [None, "{broken"]


def test_no_log_means_no_events(spark, tmp_path):
    tables = run_telemetry(spark, str(tmp_path / "absent"), str(tmp_path / "t"))
    assert tables["traces"].count() == tables["feedback"].count() == 0


def test_votes_outside_the_domain_are_rejected(spark, tmp_path):
    votes = spark.createDataFrame(
        [("q1", "up"), ("q2", "sideways"), ("q3", None), ("q4", "down")], "query_id string, vote string")
    eventlog.append_feedback(eventlog.feedback_events(votes), str(tmp_path / "log"), str(tmp_path / "bad"))
    assert {r.query_id for r in eventlog.read_log(spark, str(tmp_path / "log")).collect()} == {"q1", "q4"}
    assert {r.query_id for r in eventlog.read_log(spark, str(tmp_path / "bad")).collect()} == {"q2", "q3"}


def test_a_wrong_vote_fails_without_a_place_for_it(spark, tmp_path):
    votes = spark.createDataFrame([("q1", "sideways")], "query_id string, vote string")
    with pytest.raises(Exception, match="Not a vote: sideways"):
        eventlog.append_feedback(eventlog.feedback_events(votes), str(tmp_path / "log"))


def test_written_events_are_utc_iso_lines(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("q1", "2026-08-01 10:00:00")], "query_id string, timestamp string")
    eventlog.append_events(eventlog.trace_events(rows), path)
    eventlog.append_events(eventlog.trace_events(rows.withColumnRenamed("timestamp", "t")), path)
    texts = [json.loads(r.value)["timestamp"] for r in spark.read.text(path).collect()]
    assert "2026-08-01T10:00:00.000000+00:00" in texts and all(t.endswith("+00:00") for t in texts)


def test_running_twice_changes_nothing_and_new_lines_are_added(spark, tmp_path):
    folder, root = tmp_path / "log", str(tmp_path / "t")
    path = log(folder, "a.json", trace("q1"))
    run_telemetry(spark, path, root)
    assert run_telemetry(spark, path, root)["traces"].count() == 1
    log(folder, "b.json", trace("q2", succeeded=False, error="Query returned no rows."))
    rows = {r.query_id: r.error for r in run_telemetry(spark, path, root)["traces"].collect()}
    assert rows == {"q1": None, "q2": "Query returned no rows."}


def test_rows_the_log_no_longer_has_stay(spark, tmp_path):
    folder, root = tmp_path / "log", str(tmp_path / "t")
    path = log(folder, "a.json", trace("q1"))
    run_telemetry(spark, path, root)
    log(folder, "a.json", trace("q2"))
    assert {r.query_id for r in run_telemetry(spark, path, root)["traces"].collect()} == {"q1", "q2"}


def test_latest_vote_wins(spark, tmp_path):
    path = log(tmp_path / "log", "a.json", vote("q1", "down", "00:10"), vote("q1", "up", "00:05"))
    assert [r.vote for r in run_telemetry(spark, path, str(tmp_path / "t"))["feedback"].collect()] == ["down"]


def test_merge_prefers_the_batch(spark):
    schema = "query_id string, timestamp timestamp, v int"
    target = spark.sql("SELECT 'a' AS query_id, TIMESTAMP'2026-01-02' AS timestamp, 1 AS v")
    batch = spark.sql(
        "SELECT * FROM VALUES ('a', TIMESTAMP'2026-01-01', 2), ('b', TIMESTAMP'2026-01-01', 3), "
        "('b', TIMESTAMP'2026-01-03', 4) AS t(query_id, timestamp, v)")
    assert {r.query_id: r.v for r in merge(target, batch, "query_id").collect()} == {"a": 2, "b": 4}
    assert schema.split()[0] in merge(None, batch, "query_id").columns


def test_stream_takes_only_new_files(spark, tmp_path):
    folder, root = tmp_path / "log", str(tmp_path / "s")
    path = log(folder, "a.json", trace("q1"), vote("q1", "up", "00:05"), vote("q1", "up", "00:01"))
    ingest_new_files(spark, path, root).awaitTermination()
    ingest_new_files(spark, path, root).awaitTermination()
    assert read_ingested(spark, root, "traces").count() == 1
    log(folder, "b.json", trace("q2"), trace("q1", attempt_count=2, timestamp="2026-08-01T11:00:00+00:00"),
        vote("q1", "down", "00:03"))
    ingest_new_files(spark, path, root).awaitTermination()
    assert {r.query_id: r.attempt_count for r in read_ingested(spark, root, "traces").collect()} == {"q1": 2, "q2": 1}
    assert [r.vote for r in read_ingested(spark, root, "feedback").collect()] == ["up"]


def test_compacted_and_unfinished_loads(spark, tmp_path):
    folder, root = tmp_path / "log", str(tmp_path / "s")
    path = log(folder, "a.json", trace("q1"), vote("q1", "down", "00:01"))
    ingest_new_files(spark, path, root).awaitTermination()
    compact(spark, root)
    log(folder, "b.json", trace("q2"), vote("q1", "up", "00:02"))
    ingest_new_files(spark, path, root).awaitTermination()
    read_ingested(spark, root, "traces").withColumn("query_id", F.lit("q9")).write.parquet(f"{root}/load=7/traces")
    for _ in range(2):
        assert {r.query_id for r in read_ingested(spark, root, "traces").collect()} == {"q1", "q2"}
        assert [r.vote for r in read_ingested(spark, root, "feedback").collect()] == ["up"]
        compact(spark, root)


def test_nothing_ingested_yet(spark, tmp_path):
    assert read_ingested(spark, str(tmp_path / "s"), "traces") is None


def test_append_log_accepts_every_derived_event(spark, data, tmp_path):
    from lodestone.plans import derived

    path = str(tmp_path / "log")
    eventlog.append_events(eventlog.trace_events(derived.log_traces(spark, data)), path)
    back = eventlog.traces_of(eventlog.read_log(spark, path))
    direct = eventlog.flatten_usage(eventlog.trace_events(derived.log_traces(spark, data)))
    assert back.exceptAll(direct.select(*back.columns)).isEmpty() and back.count() == 1000


def test_tables_before_the_first_load_are_empty(spark, tmp_path):
    from lodestone.operators import monitoring

    tables = load_tables(spark, str(tmp_path / "t"))
    row = monitoring.summary(monitoring.enriched_traces(tables["traces"]), tables["feedback"]).first()
    assert set(row.asDict().values()) == {0}


def test_refresh_points_views_at_the_new_load(spark, tmp_path):
    own = spark.newSession()
    folder, root = tmp_path / "log", str(tmp_path / "t")
    path = log(folder, "a.json", trace("q1"))
    refresh_views(own, path, root)
    assert own.table("traces").count() == 1 and own.table("feedback").count() == 0
    log(folder, "b.json", trace("q2"), vote("q2", "up", "00:01"))
    refresh_views(own, path, root)
    assert own.table("traces").count() == 2 and own.table("feedback").count() == 1


def shown(tables):
    return {name: sorted(map(str, table.collect())) for name, table in tables.items()}


def test_a_small_load_writes_only_its_buckets(spark, tmp_path):
    folder, root = tmp_path / "log", str(tmp_path / "t")
    path = log(folder, "a.json", *(trace(f"q{i}") for i in range(300)), *(vote(f"q{i}", "up", "00:05") for i in range(300)))
    run_telemetry(spark, path, root)
    first = {name: bucket_paths(spark, root, name) for name in ("traces", "feedback")}
    assert len(first["traces"]) == len(first["feedback"]) == 16
    run_telemetry(spark, path, root)
    assert os.listdir(root) == ["v1"]
    log(folder, "b.json", trace("q7", attempt_count=5, timestamp="2026-08-01T12:00:00+00:00"), trace("q8", attempt_count=6, timestamp="2026-08-01T09:00:00+00:00"), trace("q900"))
    tables = run_telemetry(spark, path, root)
    second = {name: bucket_paths(spark, root, name) for name in ("traces", "feedback")}
    moved = {b for b in second["traces"] if second["traces"][b] != first["traces"][b]}
    assert 1 <= len(moved) <= 3 and second["feedback"] == first["feedback"]
    written = {os.path.relpath(d, f"{root}/v2/rows") for d, _, files in os.walk(f"{root}/v2/rows") if any(f.endswith(".parquet") for f in files)}
    assert written == {f"table_name=traces/bucket={b}" for b in moved} and not os.path.exists(f"{root}/v2/batch")
    counts = {r.query_id: r.attempt_count for r in tables["traces"].collect()}
    assert len(counts) == 301 and (counts["q7"], counts["q8"], counts["q900"]) == (5, 1, 1)
    assert shown(tables) == shown(run_telemetry(spark, path, str(tmp_path / "anew")))


def test_old_loads_keep_the_buckets_still_named(spark, tmp_path):
    folder, root = tmp_path / "log", str(tmp_path / "t")
    for i in range(4):
        path = log(folder, f"{i}.json", *(trace(f"q{i}-{j}") for j in range(100 if i == 0 else 1)))
        run_telemetry(spark, path, root)
    before = shown(load_tables(spark, root))
    assert drop_old_loads(spark, root, keep=1)
    assert shown(load_tables(spark, root)) == before and len(before["traces"]) == 103
    log(folder, "9.json", *(trace(f"z{j}") for j in range(200)))
    run_telemetry(spark, path, root)
    drop_old_loads(spark, root, keep=1)
    assert os.listdir(root) == ["v5"] and load_tables(spark, root)["traces"].count() == 303


def test_buckets_are_halved_as_a_table_grows(spark, tmp_path, monkeypatch):
    from lodestone.plans import telemetry

    folder, root = tmp_path / "log", str(tmp_path / "t")
    path = log(folder, "a.json", *(trace(f"q{i}") for i in range(300)), vote("q1", "up", "00:05"))
    run_telemetry(spark, path, root)
    monkeypatch.setattr(telemetry, "BUCKET_BYTES", 2500)
    log(folder, "b.json", trace("q1", model="other"), trace("p1"))
    tables = run_telemetry(spark, path, root)
    assert len(bucket_paths(spark, root, "traces")) > 16
    assert shown(tables) == shown(run_telemetry(spark, path, str(tmp_path / "anew")))


def test_rows_of_changed_files_win(spark, tmp_path):
    folder, root = tmp_path / "log", str(tmp_path / "t")
    path = log(folder, "a.json", vote("q1", "down", "00:10"), vote("q2", "up", "00:10"))
    run_telemetry(spark, path, root)
    log(folder, "a.json", vote("q1", "up", "00:01"), vote("q3", "up", "00:01"))
    log(folder, "b.json", vote("q2", "down", "00:01"))
    for _ in range(2):
        found = {r.query_id: r.vote for r in run_telemetry(spark, path, root)["feedback"].collect()}
        assert found == {"q1": "up", "q2": "down", "q3": "up"}

import datetime as dt
import random

from pyspark.sql import functions as F

from rosterline.sources.versions import latest, parts_of
from rosterline.streaming import incremental as inc
from rosterline.streaming import keyed


def rows(*items):
    return [("p", i, s, f"s{d}", dt.datetime(2024, 1, d)) for d, i, s in items]


def test_stream_of_rosters(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    stream = spark.readStream.schema(inc.ROSTER).option("maxFilesPerTrigger", 1).parquet(str(src))

    def feed(*items):
        spark.createDataFrame(rows(*items), inc.ROSTER).coalesce(1).write.mode("append").parquet(str(src))
        q = inc.ingest(stream, out).trigger(availableNow=True).start()
        q.awaitTermination()

    feed((1, "A", "active"), (1, "B", "active"), (2, "A", "active"))
    feed((3, "A", "suspended"), (3, "C", "active"))
    feed((2, "Z", "active"))  # late
    ev = spark.read.parquet(f"{out}/events")
    got = sorted((r["provider_id"], r["retrieved_at"].day, r["event_type"]) for r in ev.collect())
    assert got == [("A", 1, "authorized"), ("A", 3, "status_change"), ("B", 1, "authorized"), ("B", 2, "disappeared_from_roster"), ("C", 3, "authorized")]
    assert ev.select("event_id").distinct().count() == 5
    assert [r["provider_id"] for r in spark.read.parquet(f"{out}/late").collect()] == ["Z"]
    got = {r["provider_id"]: (r["in_roster"], r["current_status"], r["first_seen"].day, r["retrieved_at"].day) for r in inc.current_entities(spark, out).collect()}
    assert got == {"A": (True, "suspended", 1, 3), "B": (False, "exited", 1, 1), "C": (True, "active", 3, 3)}
    assert spark.read.parquet(f"{out}/captures").count() == 3


def made(seed, days=10, programs="pqr"):
    """Rosters by day in which providers leave, come back and change, and contents that come again (A, B, A)."""
    r, out = random.Random(seed), []
    for d in range(1, days + 1):
        for p in programs:
            out += [(p, f"{p}{i}", r.choice(["active", "active", "suspended", None]), f"s{p}{d}", dt.datetime(2024, 1, d)) for i in range(8) if r.random() < 0.7 or i == 0]
    return out


def events_of(df):
    return sorted(str(tuple(x)) for x in df.select("event_id", "program_id", "provider_id", "event_type", "new_status", "detail", "snapshot_id", "retrieved_at").collect())


def whole_log(spark, observations):
    obs = spark.createDataFrame(observations, inc.ROSTER)
    return inc.batch_events(obs, spark.createDataFrame([], inc.ROSTER))[0]


def test_ten_batches_equal_one_chain_and_a_rerun_changes_nothing(spark, tmp_path):
    all_rows = made(1)
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for d in range(1, 11):
        spark.createDataFrame([x for x in all_rows if x[4].day == d], inc.ROSTER).coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(inc.ROSTER).option("maxFilesPerTrigger", 1).parquet(str(src))
    inc.ingest(stream, out).trigger(availableNow=True).start().awaitTermination()
    assert events_of(spark.read.parquet(f"{out}/events")) == events_of(whole_log(spark, all_rows))
    version, entities = latest(spark, f"{out}/entities"), sorted(map(str, inc.current_entities(spark, out).collect()))
    assert version.mark == 9
    # The engine forgets that the last batch was committed and runs it again.
    for name in ("9", ".9.crc"):
        (tmp_path / "out" / "progress" / "commits" / name).unlink(missing_ok=True)
    inc.ingest(spark.readStream.schema(inc.ROSTER).option("maxFilesPerTrigger", 1).parquet(str(src)), out).trigger(availableNow=True).start().awaitTermination()
    assert latest(spark, f"{out}/entities") == version and sorted(map(str, inc.current_entities(spark, out).collect())) == entities
    assert events_of(spark.read.parquet(f"{out}/events")) == events_of(whole_log(spark, all_rows))


def test_only_programs_of_a_batch_are_written(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    seen = []
    for d, programs in ((1, "pq"), (2, "q")):
        spark.createDataFrame([x for x in made(2, 2) if x[4].day == d and x[0] in programs], inc.ROSTER).coalesce(1).write.mode("append").parquet(str(src))
        inc.ingest(spark.readStream.schema(inc.ROSTER).parquet(str(src)), out).trigger(availableNow=True).start().awaitTermination()
        seen.append(latest(spark, f"{out}/entities").parts)
    p, q = parts_of(["p", "q"])
    assert seen[0][p] == seen[1][p] and seen[0][q] != seen[1][q]


def test_late_captures_come_back_into_the_log(spark, tmp_path):
    all_rows = made(3)
    late = lambda x: x[4].day % 3 == 0 and x[0] != "r"
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for part in ([x for x in all_rows if not late(x)], [x for x in all_rows if late(x)]):
        spark.createDataFrame(part, inc.ROSTER).coalesce(1).write.mode("append").parquet(str(src))
        inc.ingest(spark.readStream.schema(inc.ROSTER).parquet(str(src)), out).trigger(availableNow=True).start().awaitTermination()
    assert events_of(spark.read.parquet(f"{out}/events")) == events_of(whole_log(spark, [x for x in all_rows if not late(x)]))
    assert events_of(inc.current_log(spark, out)) == events_of(whole_log(spark, all_rows))


def captures_of(rows):
    out = {}
    for p, i, s, name, at in rows:
        out.setdefault((p, name, at), []).append((i, s))
    return [(*k, v) for k, v in out.items()]


def test_keyed_state_equals_the_chain(spark, tmp_path):
    all_rows = made(4)
    src, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    src.mkdir()
    batches = [[c for c in captures_of(all_rows) if c[2].day == d] for d in range(1, 11)]
    batches[4] += [("p", "late", dt.datetime(2024, 1, 2), [("new", "active")]), ("empty", "e1", dt.datetime(2024, 1, 5), [("x", "active"), ("x", "suspended"), (None, "active")])]
    batches[5] += batches[4][:1] + [("empty", "e2", dt.datetime(2024, 1, 6), []), ("empty", "e1", dt.datetime(2024, 1, 7), [("x", "suspended")])]
    batches[7] += [("empty", "e1", dt.datetime(2024, 1, 8), [("x", "ignored, since the bytes are the same")])]
    for batch in batches:
        spark.createDataFrame(batch, keyed.CAPTURE).coalesce(1).write.mode("append").parquet(str(src))
        with keyed.keyed_state(spark):
            events = keyed.roster_events(spark.readStream.schema(keyed.CAPTURE).parquet(str(src)), 3)
            events.writeStream.format("parquet").option("checkpointLocation", progress).trigger(availableNow=True).start(out).awaitTermination()
    got = spark.read.parquet(out)
    assert events_of(got.filter("program_id <> 'empty' and event_type <> 'late_capture'")) == events_of(whole_log(spark, all_rows))
    assert [(x["program_id"], x["snapshot_id"]) for x in got.filter("event_type = 'late_capture'").collect()] == [("p", "late")]
    odd = [(x["event_type"], x["new_status"], x["retrieved_at"].day) for x in got.filter("program_id = 'empty'").orderBy("retrieved_at").collect()]
    assert odd == [("authorized", "suspended", 5), ("disappeared_from_roster", "exited", 6), ("authorized", "suspended", 7)]


def test_batch_equals_one_run(spark):
    all_rows = rows((1, "A", "active"), (2, "B", "active"), (3, "A", "active"), (3, "B", "revoked"))
    empty = spark.createDataFrame([], inc.ROSTER)
    whole, _ = inc.batch_events(spark.createDataFrame(all_rows, inc.ROSTER), empty)
    ids, current = set(), empty
    for day in (1, 2, 3):
        part = spark.createDataFrame([r for r in all_rows if r[4].day == day], inc.ROSTER)
        events, current = inc.batch_events(part, current)
        current = spark.createDataFrame(current.collect(), inc.ROSTER)
        ids |= {r["event_id"] for r in events.collect()}
    assert ids == {r["event_id"] for r in whole.collect()}


def test_unchanged_captures(spark):
    cols = "program_id string, sha256 string, retrieved_at timestamp"
    new = spark.createDataFrame([("p", "a", dt.datetime(2024, 1, 2)), ("p", "b", dt.datetime(2024, 1, 3)), ("p", "a", dt.datetime(2024, 1, 4))], cols)
    last = spark.createDataFrame([("p", "a", dt.datetime(2024, 1, 1))], cols)
    assert [r["retrieved_at"].day for r in inc.unchanged_dedup(new, last).orderBy("retrieved_at").collect()] == [3, 4]


def test_a_lost_version_stops_the_stream(spark, tmp_path):
    import shutil

    import pytest
    from pyspark.errors import PySparkException

    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    stream = spark.readStream.schema(inc.ROSTER).parquet(str(src))
    for day in (1, 2):
        spark.createDataFrame(rows((day, "A", "active")), inc.ROSTER).coalesce(1).write.mode("append").parquet(str(src))
        if day == 2:
            shutil.rmtree(f"{out}/entities")
            with pytest.raises(PySparkException):
                inc.ingest(stream, out).trigger(availableNow=True).start().awaitTermination()
        else:
            inc.ingest(stream, out).trigger(availableNow=True).start().awaitTermination()


def test_changed_captures_of_a_stream(spark, tmp_path):
    cols = "program_id string, sha256 string, retrieved_at timestamp"
    src = tmp_path / "in"
    src.mkdir()
    got = inc.changed_captures(spark.readStream.schema(cols).parquet(str(src))).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    for batch in ([("p", "a", 1), ("p", "a", 2), ("p", "b", 3), ("q", "a", 1)], [("p", "b", 4), ("p", "a", 5), ("q", "a", 2), ("q", "c", 1)]):
        spark.createDataFrame([(p, s, dt.datetime(2024, 1, d)) for p, s, d in batch], cols).coalesce(1).write.mode("append").parquet(str(src))
        got.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    out = sorted((r["program_id"], r["retrieved_at"].day, r["sha256"]) for r in spark.read.schema(cols).parquet(str(tmp_path / "out")).collect())
    assert out == [("p", 1, "a"), ("p", 3, "b"), ("p", 5, "a"), ("q", 1, "a")]


def test_counts_over_event_time(spark, tmp_path):
    t = spark.createDataFrame([("x", dt.datetime(2024, 1, 1, h)) for h in (1, 2)] + [("x", dt.datetime(2024, 1, 5)), ("y", dt.datetime(2024, 1, 9))], "event_type string, ts timestamp")
    t.write.parquet(str(tmp_path / "e"))
    stream = inc.event_counts(spark.readStream.schema(t.schema).parquet(str(tmp_path / "e")))
    q = stream.writeStream.format("memory").queryName("counts").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r["event_type"], r["window_start"].day): r["n"] for r in spark.table("counts").collect()}
    assert got[("x", 1)] == 2 and got[("x", 5)] == 1
    assert {r["n"] for r in inc.event_counts(t).filter(F.col("event_type") == "y").collect()} == {1}


def test_rows_of_a_replayed_stream_are_made_once(spark, tmp_path):
    from pyspark.sql import functions as F

    from rosterline.plans.streams import _files

    seen = spark.sparkContext.accumulator(0)

    def each(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    rows = spark.range(30).select("id", F.expr("date_add(DATE '2024-01-01', cast(id as int))").alias("snap_date")).mapInPandas(each, "id long, snap_date date")
    _files(rows, str(tmp_path / "in"), 6)
    assert seen.value == 30
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "in")).collect()) == list(range(30))

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterline.operators import diff, revise, status

OBS = "program_id string, snap_date date, provider_id string, status string"
CAPTURE = "program_id string, snap_date date, snapshot_id string"


def day(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def numbered(snaps):
    return snaps.withColumn("seq", F.row_number().over(Window.partitionBy("program_id").orderBy("snap_date")))


def log_of(obs, snaps):
    return diff.with_event_id(diff.diff_chain(obs, numbered(snaps))).select(*revise.EVENT, "snap_date", "event_id")


def made(seed, n=14):
    """Rosters of several programs, some of them empty, with a null status here and there; and which captures are late."""
    r = random.Random(seed)
    obs, snaps, late = [], [], set()
    for p in ("p", "q", "r"):
        for k in range(n):
            snaps.append((p, day(k), f"s{p}{k}"))
            if r.random() < 0.4 or p == "r":
                late.add((p, day(k)))
            if r.random() < 0.85:
                obs += [(p, day(k), f"{p}{i}", r.choice(["active", "active", "suspended", None])) for i in range(7) if r.random() < 0.7]
    return obs, snaps, late


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_revised_log_equals_a_rebuild(spark, seed):
    obs, snaps, late = made(seed)
    of = lambda rows, schema, want: spark.createDataFrame([x for x in rows if ((x[0], x[1]) in late) == want], schema)
    log = log_of(of(obs, OBS, False), of(snaps, CAPTURE, False)).cache()
    whole = {tuple(x) for x in log_of(spark.createDataFrame(obs, OBS), spark.createDataFrame(snaps, CAPTURE)).collect()}
    before = {tuple(x) for x in log.collect()}
    r = revise.revise(log, of(obs, OBS, False), of(snaps, CAPTURE, False), of(obs, OBS, True), of(snaps, CAPTURE, True))
    assert {tuple(x) for x in r.retractions.collect()} == before - whole and {tuple(x) for x in r.insertions.collect()} == whole - before
    after = revise.apply_revision(log, r)
    assert sorted(map(str, map(tuple, after.select(*log.columns).collect()))) == sorted(map(str, whole))
    again = revise.apply_revision(after, r)
    assert again.count() == len(whole)
    assert {(x[0], x[1], x[3]) for x in r.snapshots.collect()} == {(p, day(k), k + 1) for p in "pqr" for k in range(14)}


def test_late_captures_that_come_again_change_nothing(spark):
    obs, snaps, _ = made(4)
    all_obs, all_snaps = spark.createDataFrame(obs, OBS), spark.createDataFrame(snaps, CAPTURE)
    log = log_of(all_obs, all_snaps)
    r = revise.revise(log, all_obs, all_snaps, all_obs.filter("day(snap_date) = 3"), all_snaps.filter("day(snap_date) = 3"))
    assert r.retractions.isEmpty() and r.insertions.isEmpty()
    none = revise.revise(log, all_obs, all_snaps, all_obs.limit(0), all_snaps.limit(0))
    assert none.retractions.isEmpty() and none.insertions.isEmpty()


def test_only_neighbours_are_open(spark):
    kept = spark.createDataFrame([("p", day(k), f"s{k}") for k in (0, 2, 4, 6)], CAPTURE)
    late = spark.createDataFrame([("p", day(3), "s3"), ("p", day(7), "s7")], CAPTURE)
    got = {x["snapshot_id"]: (x["before"], x["open"]) for x in revise.neighbours(kept, late).collect()}
    assert {k for k, (_, open_) in got.items() if open_} == {"s3", "s4", "s7"} and got["s4"][0] == day(3) and got["s3"][0] == day(2)


def test_status_of_touched_entities(spark):
    obs, snaps, late = made(5)
    of = lambda rows, schema, want: spark.createDataFrame([x for x in rows if ((x[0], x[1]) in late) == want], schema)
    log = log_of(of(obs, OBS, False), of(snaps, CAPTURE, False))
    r = revise.revise(log, of(obs, OBS, False), of(snaps, CAPTURE, False), of(obs, OBS, True), of(snaps, CAPTURE, True))
    after = revise.apply_revision(log, r).withColumnRenamed("snap_date", "event_date")
    entities = after.select("program_id", "provider_id").distinct().withColumn("current_status", F.lit("stale")).withColumn("name", F.lit("n"))
    key = F.struct("program_id", "provider_id")
    want = {tuple(x) for x in status.recompute_status(entities.withColumn("k", key), after.withColumn("k", key), "k").select("program_id", "provider_id", "current_status").collect()}
    got = revise.revised_status(entities, after, r)
    touched = {tuple(x) for x in r.retractions.select("program_id", "provider_id").unionByName(r.insertions.select("program_id", "provider_id")).collect()}
    rows = {tuple(x) for x in got.select("program_id", "provider_id", "current_status").collect()}
    assert got.columns == entities.columns and {x for x in rows if x[:2] in touched} == {x for x in want if x[:2] in touched}
    assert {x[2] for x in rows if x[:2] not in touched} <= {"stale"}

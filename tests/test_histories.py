import datetime as dt
import random

from pyspark.sql import functions as F

from rosterline.operators import quality, status


def plan_of(df):
    return df._jdf.queryExecution().toString()


def day(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def test_counts_at_dates_equal_a_plain_reading(spark):
    r = random.Random(1)
    events = [(r.choice("pq"), r.randint(1, 30), day(r.randint(0, 60)), f"e{i:03}", r.choice(["active", "suspended", "exited", None])) for i in range(300)]
    wanted = [day(k) for k in range(-5, 80, 3)] + [day(4), day(4)]
    last = {}
    want = {}
    for d in set(wanted):
        last = {}
        for p, i, on, event, st in sorted(events, key=lambda e: (e[2], e[3])):
            if on <= d:
                last[p, i] = st
        for (p, _), st in last.items():
            want[d, p, st] = want.get((d, p, st), 0) + 1
    df = spark.createDataFrame(events, "program_id string, provider_id int, event_date date, event_id string, new_status string")
    dates = spark.createDataFrame([(d,) for d in wanted] + [(None,)], "as_of date")
    got = status.status_asof(df, dates)
    assert {tuple(x)[:3]: x["n"] for x in got.collect()} == want and got.count() == len(want)
    assert status.status_asof(df, dates.limit(0)).count() == 0 and status.status_asof(df.limit(0), dates).count() == 0


def test_ten_thousand_dates_cost_no_row_for_each_interval(spark):
    events = spark.range(2000).select(
        F.lit("p").alias("program_id"), (F.col("id") % 500).alias("provider_id"), F.expr("timestamp_ntz'2020-01-01' + make_interval(0,0,0,cast(id as int))").alias("event_date"),
        F.col("id").cast("string").alias("event_id"), F.when(F.col("id") % 3 == 0, "active").otherwise("suspended").alias("new_status"),
    )
    dates = spark.range(10_000).select(F.expr("timestamp_ntz'2020-01-01' + make_interval(0,0,0,0,cast(id*6 as int))").alias("as_of"))
    out = status.status_asof(events, dates)
    assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)
    by_date = out.groupBy("as_of").agg(F.sum("n").alias("n"))
    assert by_date.count() == 10_000 and by_date.agg(F.max("n")).first()[0] == 500


def test_gaps_from_bitmaps(spark):
    r = random.Random(2)
    ids = [r.randint(-200_000, 200_000) for _ in range(3000)] + [-1, 0, 1, 32_767, 32_768, 5 * 2**30, 5 * 2**30 + 3, None, None]
    ids += ids[:100]
    have = sorted({i for i in ids if i is not None})
    want = sorted((a + 1, b - 1) for a, b in zip(have, have[1:]) if b - a > 1)
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = status.sequence_gaps(df, "id")
    assert sorted(map(tuple, got.collect())) == want
    assert "partial_bitmap_construct_agg" in plan_of(got)
    for few in ([], [7], [None], [3, 3], [0, 32_767, 32_768]):
        have = sorted({i for i in few if i is not None})
        want = [(a + 1, b - 1) for a, b in zip(have, have[1:]) if b - a > 1]
        assert sorted(map(tuple, status.sequence_gaps(spark.createDataFrame([(i,) for i in few], "id long"), "id").collect())) == want


ROW = "k int, v string, x double, l array<string>"


def test_drift_equals_signed_counts(spark):
    from collections import Counter

    r = random.Random(3)
    row = lambda: (r.randint(0, 40), r.choice(["a", None, "b"]), r.choice([None, 1.5]), r.choice([None, ("t",), ()]))
    base = [row() for _ in range(300)]
    a, b = base + [row() for _ in range(5)] + base[:3], base + [(None, None, "y" and None, None)] * 3 + [row() for _ in range(4)]
    want = Counter({("only_first", *x): n for x, n in (Counter(a) - Counter(b)).items()}) + Counter({("only_second", *x): n for x, n in (Counter(b) - Counter(a)).items()})
    df = lambda rows: spark.createDataFrame([tuple(list(c) if isinstance(c, tuple) else c for c in x) for x in rows], ROW)
    for keys in (["k"], None):
        for leaves in (quality.LEAVES, 1, 300):
            got = quality.release_drift(df(a), df(b), keys, leaves).select("side", "k", "v", "x", "l").collect()
            assert Counter((*x[:4], None if x[4] is None else tuple(x[4])) for x in got) == want
    assert quality.release_drift(df(a), df(a[::-1]), ["k"]).isEmpty() and quality.release_drift(df([]), df([])).isEmpty()


def test_fingerprints(spark):
    a = spark.range(10_000).select("id", (F.col("id") % 7).alias("v"))
    one, two = quality.release_fingerprint(a, ["id"]), quality.release_fingerprint(a.orderBy(F.desc("id")), ["id"])
    assert quality.unequal_leaves(one, two).isEmpty()
    changed = a.withColumn("v", F.when(F.col("id") == 77, 99).otherwise(F.col("v")))
    assert quality.unequal_leaves(one, quality.release_fingerprint(changed, ["id"])).count() == 1
    assert quality.unequal_leaves(one, quality.release_fingerprint(a.unionByName(a.filter("id = 5")), ["id"])).count() == 1
    swapped = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert not quality.unequal_leaves(quality.release_fingerprint(swapped.limit(1)), quality.release_fingerprint(swapped.offset(1))).isEmpty()
    assert one.count() < 10_000 and "exceptAll" not in plan_of(quality.release_drift(a, changed, ["id"]))


def test_known_bills_are_found_by_their_parts(spark):
    from rosterline.plans import jobs

    r = random.Random(5)
    text = lambda n: None if r.random() < 0.1 else "".join(r.choices("hB1 2", k=r.randint(0, n)))
    bills = [(i, text(6), r.choice(["x", "y", None])) for i in range(150)] + [(151, "HB 12", "x"), (151, "HB 12", "x")]
    configs = [(f"p{i}", r.choice("xy"), None if i == 3 else [text(4) for _ in range(r.randint(0, 3))]) for i in range(12)]
    flat = lambda s: s.lower().replace(" ", "")
    got = jobs.with_known(spark.createDataFrame(bills, "bill_id int, identifier string, state string"), spark.createDataFrame(configs, "program_id string, state string, known_bills array<string>"))
    want = sorted((i, str(name), str(state), sorted(p for p, s, ks in configs if s == state and name is not None and any(k is not None and flat(k) in flat(name) for k in ks or []))) for i, name, state in bills)
    assert sorted((x["bill_id"], str(x["identifier"]), str(x["state"]), sorted(x["_known"] or [])) for x in got.collect()) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "BroadcastNestedLoop" not in plan and "Contains" not in plan


def test_gaps_of_ids_that_lie_far_apart(spark):
    ids = [-(1 << 60) - 1, -(1 << 60), -7, -5, -5, 0, 1, (1 << 20) - 1, 1 << 20, (1 << 35) + 1, (1 << 60) + 1, (1 << 60) + 3]
    df = spark.createDataFrame([(i,) for i in [*ids, None]], "id long")
    want = [(a + 1, b - 1) for a, b in zip(ids, ids[1:]) if b - a > 1]
    assert sorted(map(tuple, status.sequence_gaps(df, "id").collect())) == want

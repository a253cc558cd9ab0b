"""Roster events from keyed state: a stream of parsed captures against the last roster of each program, held by the engine."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.names import event_id

#: A parsed capture: its rows in order, none if the roster is empty.
CAPTURE = "program_id string, snapshot_id string, retrieved_at timestamp, entries array<struct<provider_id:string,status:string>>"
BUCKETS = 16
_OUT = "program_id string, provider_id string, event_type string, new_status string, detail string, snapshot_id string, retrieved_at timestamp"
_STATE = "retrieved_at timestamp, snapshot_id string, providers array<string>, statuses array<string>"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def keyed_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which ``roster_events`` needs; the session's own choice comes back after."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


class _Rosters(StatefulProcessor):
    """The state of a part of a program's roster: its providers and statuses at the last capture, and that capture."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        program, bucket = key
        captures = pd.concat(list(rows)).sort_values(["retrieved_at", "snapshot_id"], kind="stable")
        held = self.last.get()
        at, snapshot = (held[0], held[1]) if held is not None else (None, None)
        roster = dict(zip(held[2], held[3])) if held is not None else {}
        out = []
        for when, name, providers, statuses in zip(captures["retrieved_at"], captures["snapshot_id"], captures["providers"], captures["statuses"]):
            when = when.to_pydatetime()
            if at is not None and when <= at:
                if bucket == 0 and (when, name) != (at, snapshot):
                    out.append((program, None, "late_capture", None, None, name, when))
                continue
            new = dict(zip(providers, statuses))  # of one provider twice the last row counts
            if name != snapshot:  # the same bytes are the same roster
                for p, s in new.items():
                    if p not in roster:
                        out.append((program, p, "authorized", s, None, name, when))
                    elif roster[p] != s:
                        out.append((program, p, "status_change", s, " → ".join(x for x in (roster[p], s) if x is not None), name, when))
                out += [(program, p, "disappeared_from_roster", "exited", None, name, when) for p in roster if p not in new]
            at, snapshot, roster = when, name, new
        self.last.update((at, snapshot, list(roster), list(roster.values())))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _OUT.split(", ")]).astype({"retrieved_at": "datetime64[ns]"})

    def close(self) -> None:
        pass


def roster_events(captures: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Events (``event_id`` and the columns of a log) of a stream of parsed captures (``CAPTURE``); start it within ``keyed_state``.

    Each capture is dealt to ``buckets`` parts by a hash of the provider, every part also if it is empty, so that exits are seen; the
    state of a (program, part) is the providers and statuses of the last capture. A batch reads and writes the state of the
    programs that it brings and no other, and a program that most captures are of is spread over ``buckets`` keys.

    Captures of a batch count in order of time. One with the snapshot id of the program's last, that is its bytes, has no
    events; A, B, A has them. One that is not newer than the program's last is late: it gives one row ``late_capture``
    without a provider, for the backfill, and changes nothing; the last one again gives none. An empty roster ends all its
    spells. Null statuses are statuses; entries without a provider are left out. Batches that the engine runs again start
    from the state before them.
    """
    part = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda b: F.struct(b.alias("bucket"), F.filter("entries", lambda e: e.provider_id.isNotNull() & (F.pmod(F.xxhash64(e.provider_id), F.lit(buckets)) == b)).alias("entries")))
    dealt = captures.select("program_id", "snapshot_id", "retrieved_at", F.explode(part).alias("p")).select(
        "program_id", F.col("p.bucket").alias("bucket"), "snapshot_id", "retrieved_at",
        F.transform("p.entries", lambda e: e.provider_id).alias("providers"), F.transform("p.entries", lambda e: e.status).alias("statuses"),
    )
    found = dealt.groupBy("program_id", "bucket").transformWithStateInPandas(_Rosters(), outputStructType=_OUT, outputMode="append", timeMode="none")
    named = event_id(F.col("provider_id"), F.concat_ws("@", "program_id", F.col("retrieved_at").cast("string"), "snapshot_id"), F.col("event_type"))
    return found.withColumn("event_id", F.when(F.col("event_type") != "late_capture", named))

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rosterline.llm.lines import line_dedup

SCHEMA = "doc_id long, text string, lines string, key int"
SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows):
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and max(holders[key(x)]) != i for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((i, len(lines), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_equals_brute_force(spark):
    long = "A line that many documents hold"
    rows = [(i, f"own {i}\n{long}\n\n  {long.upper()}\t\nend") for i in range(6)]
    rows += [(10, long), (11, None), (12, ""), (13, "É" * 25), (14, "é" * 25), (15, "É" * 25), (16, "É" * 25 + "\n" + "É" * 25), (17, "x" * 19), (18, "x" * 19), (19, "x" * 19), (20, "\n\n"), (21, f"{long}\r\n\x0b{long}"), (22, "\x1c" + long)]
    rows += [(30, "\n".join(f"shared passage number {k}" for k in range(3000))) for _ in range(2)] + [(i, "\n".join(f"shared passage number {k}" for k in range(0, 3000, 2))) for i in (31, 32)]
    docs = spark.createDataFrame([(i, t, "l", 0) for i, t in rows], SCHEMA)
    got = sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["d"]) for r in line_dedup(docs).withColumn("d", F.sha2("kept", 256)).collect())
    assert got == brute(rows)


def test_null_ids_carried_columns_and_an_empty_table(spark):
    line = "a line of twenty characters and more"
    docs = spark.createDataFrame([(None, line, "l", 1), (1, line, "m", 2), (2, line, "n", None)], SCHEMA)
    got = {r["doc_id"]: (r["n_dropped"], r["lines"], r["key"], r["kept"]) for r in line_dedup(docs, carry=("lines", "key")).collect()}
    assert got == {None: (1, "l", 1, ""), 1: (1, "m", 2, ""), 2: (0, "n", None, line)}
    assert line_dedup(docs.limit(0)).count() == 0

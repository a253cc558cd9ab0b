import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from rosterline.llm import resample as R

SCHEMA = "doc_id long, text string, score string, rank int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, n):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, n=1, buckets=10_000, percent=10, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t, *_ in docs for f in features(t, n)[1])
    t = Counter(bucket(f) for text in target for f in features(text, n)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    rows = []
    for i, text, *_ in docs:
        words, own = features(text, n)
        weight = sum(gain(bucket(f)) for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, words, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    rank = {}
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        rank.setdefault(r, []).append(k + 1)
    return sorted(map(str, ((*r, rank[r].pop() if rank.get(r) else None) for r in rows)))


def corpus():
    r = random.Random(7)
    vocab = [f"w{i}" for i in range(300)] + ["Été", "漢字", "A\xa0b", "x\x85"]
    text = lambda lo, hi: r.choice([" ", ", ", "\n", "_", "\x00"]).join(r.choices(vocab, k=r.randint(lo, hi)))
    rows = [(i, text(0, 60), None, 1) for i in range(400)] + [(500, None, None, 1), (501, "", "x", None), (502, "...", None, None), (503, "-one two-", None, None)]
    rows += [(7, rows[7][1], None, 1)] * 3 + [(None, text(30, 40), None, 1)] * 30 + [(504, "word " * 30_000, None, None)]
    return rows, [text(10, 20).replace("w1", "w2") for _ in range(30)] + [None, ""]


@pytest.mark.parametrize("n,buckets,percent", [(1, 10_000, 10), (3, 97, 50), (2, 10_000, 100)])
def test_equals_brute_force(spark, n, buckets, percent):
    rows, target = corpus()
    docs, wanted = spark.createDataFrame(rows, SCHEMA).repartition(6), spark.createDataFrame([(t,) for t in target], "text string")
    got = R.importance_resample(docs, wanted, n=n, buckets=buckets, percent=percent).collect()
    assert sorted(map(str, map(tuple, got))) == brute(rows, target, n, buckets, percent)
    ranks = sorted(x["rank"] for x in got if x["rank"])
    assert ranks == list(range(1, len(ranks) + 1)) and ranks


def test_slices_change_nothing(monkeypatch):
    texts = pa.array([t or "" for _, t, *_ in corpus()[0]])
    whole = [x.tolist() for x in R.feature_buckets(texts, 2, 1000)]
    monkeypatch.setattr(R, "_SLICE", 300)
    words, owners, found, at = [], [], Counter(), 0
    for part in R._slices(texts):
        w, o, b = R.feature_buckets(part, 2, 1000)
        words += w.tolist()
        found.update(zip((o + at).tolist(), b.tolist()))
        at += len(part)
    assert at == len(texts) and words == whole[0] and found == Counter(zip(whole[1], whole[2]))


def test_empty_tables(spark):
    rows, target = corpus()
    docs, none = spark.createDataFrame(rows[:40], SCHEMA), spark.createDataFrame([], "text string")
    assert sorted(map(str, map(tuple, R.importance_resample(docs, none).collect()))) == brute(rows[:40], [])
    out = R.importance_resample(docs.limit(0), none)
    assert out.count() == 0 and out.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]

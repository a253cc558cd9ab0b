import random
import re
from collections import Counter
from itertools import combinations

import numpy as np

from rosterline.llm import quality
from rosterline.llm.quality import quality_rules, robust_estimates, text_statistics

SCHEMA = "doc_id long, text string, lang string, source string, n int, g string, w string"


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    c = Counter(zip(w, w[1:], w[2:]))
    again = {i + k for i in range(len(w) - 2) if c[(w[i], w[i + 1], w[i + 2])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again)


def test_statistics_equal_brute_force(spark):
    r = random.Random(6)
    texts = ["".join(r.choices(["a", "b", "é", " ", "\n", "#", "\x1c", "\t", "😀", " "], weights=[4, 4, 2, 6, 3, 1, 1, 1, 1, 1], k=r.randint(0, 200))) for _ in range(300)]
    texts += [None, "", "a b", "a b c", "a b c a b c", "x " * 30000, "\n".join(["same line"] * 5)]
    docs = spark.createDataFrame([(i, t, "l", "s", 1, "g", "w") for i, t in enumerate(texts)], SCHEMA)
    for x in text_statistics(docs, "doc_id", "text").collect():
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"]) == brute(texts[x["nid"]])


def covariance(core):
    cov = np.cov(core.T, bias=True) * quality.CONSISTENCY
    return cov + np.diag(np.maximum(np.square(quality.FLOORS) - np.diag(cov), 0))


def test_estimates_have_the_least_determinant_of_all_subsets(spark):
    r = np.random.default_rng(5)
    turn = np.array([[1, 0, 0, 0], [0.9, 1, 0, 0], [0, 2, 1.5, 0], [0.3, 0, 0, 2]])
    groups = {}
    for k in range(6):
        n = 12 + k % 3
        x = r.normal(0, 1, (n, 4)) @ turn.T * 3
        x[:3] += r.normal(0, 60, 4) + (np.array([40, -40, 40, -40]) if k % 2 else 0)
        groups[f"g{k}"] = x
    df = spark.createDataFrame([(g, *map(float, v)) for g, x in groups.items() for v in x], "g string, x1 double, x2 double, x3 double, x4 double")
    got = {row["g"]: row for row in robust_estimates(df).collect()}
    for g, x in groups.items():
        h = int(np.ceil(len(x) * quality.SHARE))
        best = min(combinations(range(len(x)), h), key=lambda c: np.linalg.det(covariance(x[list(c)])))
        core = x[list(best)]
        low = np.array([[got[g][f"l{i}{j}"] if j <= i else 0 for j in range(1, 5)] for i in range(1, 5)])
        assert np.allclose([got[g][f"m{i}"] for i in range(1, 5)], core.mean(0), atol=1e-6), g
        assert np.allclose(low @ low.T, covariance(core), atol=1e-6), g


def test_estimates_of_a_large_group_settle(spark):
    r = np.random.default_rng(1)
    x = np.concatenate([r.normal(0, 1, (400, 4)) @ np.diag([1, 0.5, 2, 1]), r.normal(30, 1, (80, 4))])
    df = spark.createDataFrame([("a", *map(float, v)) for v in x], "g string, x1 double, x2 double, x3 double, x4 double")
    got = robust_estimates(df).first()
    mean, cov = np.median(x, 0), np.eye(4)
    for _ in range(50):
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        core = x[d <= np.sort(d)[int(np.ceil(len(x) * quality.SHARE)) - 1]]
        mean, cov = core.mean(0), covariance(core)
    low = np.array([[got[f"l{i}{j}"] if j <= i else 0 for j in range(1, 5)] for i in range(1, 5)])
    assert np.allclose([got[f"m{i}"] for i in range(1, 5)], mean, atol=0.1) and np.allclose(low @ low.T, cov, rtol=0.1, atol=0.1)
    assert np.linalg.det(low @ low.T) <= 1.05 * np.linalg.det(cov)


def test_verdicts(spark):
    r = random.Random(7)
    clean = lambda: "\n".join(" ".join("".join(r.choices("abcdefgh", k=r.randint(2, 9))) for _ in range(12)) + "." for _ in range(r.randint(6, 200)))
    rows = [(i, clean(), r.choice(["en", None]), r.choice(["a", "b", None]), 1, "g", "w") for i in range(400)]
    rows += [(1000 + i, " ".join("".join(r.choices("abcdefgh", k=4)) + "%%#" for _ in range(90)), "en", "a", 1, "g", "w") for i in range(5)] + [(2000, "too short", "en", "a", 1, "g", "w"), (2001, "one two three " * 40, "en", "a", 1, "g", "w"), (2002, clean(), "qq", "rare", 1, "g", "w"), (None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {x["doc_id"]: x for x in quality_rules(docs).collect()}
    assert all(got[i]["kept"] for i in range(400)) and got[2002]["kept"]
    assert not any(got[1000 + i]["kept"] or got[1000 + i]["base_failed"] for i in range(5))
    assert all(got[i]["base_failed"] and not got[i]["kept"] for i in (2000, 2001, None))
    assert quality_rules(docs.limit(0)).count() == 0


def test_repeats_alone_are_outliers(spark):
    r = random.Random(11)
    some = lambda n: ["".join(r.choices("abcdefgh", k=r.randint(4, 7))) for _ in range(n)]
    lines = lambda w: "\n".join(" ".join(w[i : i + 12]) for i in range(0, len(w), 12))
    rows = [(i, lines(some(r.randint(100, 600)))) for i in range(400)]
    for i in range(10):
        block, few = some(50 + 4 * i), some(60)
        rows += [(1000 + i, lines(some(170) + block + some(7) + block)), (1100 + i, "\n".join(r.choices(few, k=600)))]
        one, line = some(3), " ".join(some(3))
        rows += [(1200 + i, lines(some(20) + one + some(20) + one + some(20))), (1300 + i, "\n".join([line, *[" ".join(some(12)) for _ in range(8)], line]))]
    docs = spark.createDataFrame([(i, t, "en", "a", 1, "g", "w") for i, t in rows], SCHEMA)
    got = {x["doc_id"]: x for x in quality_rules(docs).collect()}
    assert not any(x["base_failed"] for x in got.values())
    assert [i for i, x in got.items() if x["kept"] != (i < 1000 or i >= 1200)] == []

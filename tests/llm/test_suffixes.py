import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterline.llm.suffixes import common_prefix, deep_shallow, owners, suffix_dedup, word_codes

SCHEMA = "doc_id long, text string, source string, kept string, nid int"


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int(np.count_nonzero(np.diff(gone, prepend=False) & gone))
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(d, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def corpus():
    r = random.Random(5)
    word = lambda: "".join(r.choices("abcdeé", k=r.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    common, other = text(30), text(25)
    out = ["", None, "short", text(400)]
    for i in range(40):
        out.append(text(r.randint(5, 60)) + common[: r.randint(60, len(common))] + text(r.randint(0, 40)) + (other if i % 3 else ""))
    base = text(150).split(" ")
    for _ in range(12):  # near copies
        copy = list(base)
        for _ in range(4):
            copy[r.randrange(len(copy))] = word()
        out.append(" ".join(copy))
    out += [" ".join(base)] * 3
    out += ["a" * 900, "ab" * 300, "x" + "ab" * 200, text(20) + common + common, "é" * 300]
    return out


@pytest.mark.parametrize("max_bucket", [40_000, 3])
def test_equals_brute_force(spark, max_bucket):
    texts = corpus()
    length = 100
    docs = spark.createDataFrame([(i, t, "s", "x", 1) for i, t in enumerate(texts)], SCHEMA)
    got = suffix_dedup(docs, length=length, max_bucket=max_bucket).withColumn("d", F.sha2("kept", 256)).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["d"]) for r in got}
    assert [got[i] for i in range(len(texts))] == brute(texts, length)


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    t = "q" * 10 + "".join(chr(97 + i % 23) + str(i) for i in range(200))
    docs = spark.createDataFrame([(7, t, "s", "x", 1), (7, t, "s", "x", 1), (None, None, None, None, None), (None, "z", None, None, None)], SCHEMA)
    rows = sorted((r["doc_id"] or -1, r["n_removed"]) for r in suffix_dedup(docs).collect())
    assert rows == [(-1, 0), (-1, 0), (7, len(t)), (7, len(t))]
    assert suffix_dedup(docs.limit(0)).count() == 0


def test_texts_whose_short_hashes_collide_stay_apart(spark):
    many = spark.range(400_000).select(F.concat(F.lit("w"), F.sha2(F.col("id").cast("string"), 512), F.sha2((F.col("id") + 1).cast("string"), 512), F.col("id")).alias("body"))
    h = F.hash("body")
    pair = many.join(many.groupBy(h.alias("h")).count().filter("count > 1").limit(3), h == F.col("h")).select("body").limit(2).collect()
    a, b = (r["body"] for r in pair)
    docs = spark.createDataFrame([(None, a, "s", "x", 1), (None, b + b[:150], "s", "x", 1), (4, b[:120], "s", "x", 1), (4, "z" * 130, "s", "x", 1)], SCHEMA)
    got = sorted(tuple(r)[1:4] for r in suffix_dedup(docs, length=100).collect())
    assert got == sorted(x[:3] for x in brute([a, b + b[:150], b[:120], "z" * 130], 100))


def test_hot_grams_are_joined_apart(spark):
    from rosterline.llm.suffixes import _keep_counted

    left = spark.range(1000).selectExpr("id", "if(id < 700, 1, id) key")
    counted = spark.createDataFrame([(1, 700, True), (800, 1, False), (5000, 1, False)], "key long, n long, pure boolean")
    got = {(r["id"], r["key"], r["pure"]) for r in _keep_counted(left, counted, ["key"]).collect()}
    assert got == {*((i, 1, True) for i in range(700)), (800, 800, False)}


def test_deep_shallow_orders_suffixes():
    r = random.Random(3)
    strings = [b"p" * 70 + bytes(r.choices(b"ab", k=r.randint(0, 12))) for _ in range(60)] + [bytes(r.choices(b"ab", k=r.randint(0, 90))) for _ in range(60)]
    order, lcp = deep_shallow(strings, shallow=16)
    ordered = [strings[i] for i in order]
    assert ordered == sorted(strings) and sorted(order) == list(range(len(strings)))
    assert lcp.tolist()[1:] == [common_prefix(a, b) for a, b in zip(ordered, ordered[1:])]


def test_owners_do_not_depend_on_steps(monkeypatch):
    from rosterline.llm import suffixes

    r = random.Random(9)
    data = np.frombuffer(bytes(r.choices(b"abc", k=5000)), np.uint8)
    ends = np.array([0, 1500, 1550, 5000])
    whole = owners(data, ends, 100)
    monkeypatch.setattr(suffixes, "_STEP", 97)
    assert all((a == b).all() for a, b in zip(whole, owners(data, ends, 100)))


def brute_passages(texts, words):
    """Runs of words covered by windows of so many words that occur elsewhere too."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    count = Counter(tuple(w[i : i + words]) for w in split for i in range(len(w) - words + 1))
    out = []
    for w in split:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - words + 1):
            if count[tuple(w[i : i + words])] > 1:
                gone[i : i + words] = True
        out.append(int(np.count_nonzero(np.diff(gone, prepend=False) & gone)))
    return out


@pytest.mark.parametrize("max_bucket", [40_000, 3])
def test_passages_equal_brute_force(spark, max_bucket):
    r = random.Random(6)
    some = lambda n: [r.choice(["é", "a", "bb"]) + str(r.randrange(4000)) for _ in range(n)]
    shared, other, texts = some(60), some(70), [None, "", "a b c"]
    for i in range(60):
        n = r.randint(12, 60)
        at = r.randint(0, 60 - n)
        texts.append(r.choice([" ", "\n", " \t"]).join(some(r.randint(0, 40)) + shared[at : at + n] + some(r.randint(0, 40)) + (other[i % 9 :] if i % 2 else [])))
    texts += [" ".join(["same"] * 100), " ".join(shared + shared), texts[9]]
    docs = spark.createDataFrame([(i, t, "s", "x", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {x["doc_id"]: x["n_passages"] for x in suffix_dedup(docs, passage_words=20, max_bucket=max_bucket).collect()}
    assert [got[i] for i in range(len(texts))] == brute_passages(texts, 20)


def test_word_codes_depend_on_words_alone():
    codes = lambda t: np.frombuffer(word_codes(np.frombuffer(t.encode(), np.uint8)), "<u4").tolist()
    assert codes(" \tab é  ab\n") == [*codes("ab"), *codes("é"), *codes("ab")] and codes("") == codes(" \n") == []
    assert len({c for i in range(20000) for c in codes(f"w{i}")}) == 20000

import random

import numpy as np

from rosterline.llm.components import components
from rosterline.llm.near import aligned, near_duplicates, one_of_each, order_sketches, prefix, shingles

SCHEMA = "doc_id long, text string, class_id string, words int"


def clean(t):
    return [w.rstrip(".,") for w in (t or "").lower().split()]


def similarity(a, b):
    """Longest common run of labelled shingles over their union, by the full table."""
    def labelled(t):
        w, seen, out = clean(t), {}, []
        k = min(5, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            g = tuple(w[i : i + k])
            seen[g] = seen.get(g, -1) + 1
            out.append((g, seen[g]))
        return out

    x, y = labelled(a), labelled(b)
    if not x or not y:
        return float(len(x) == len(y))
    row = [0] * (len(y) + 1)
    for i in x:
        new = [0]
        for j, v in enumerate(y):
            new.append(row[j] + 1 if i == v else max(new[-1], row[j + 1]))
        row = new
    return row[-1] / (len(x) + len(y) - row[-1])


def brute(texts):
    n = len(texts)
    root = list(range(n))
    for _ in range(n):
        for a in range(n):
            for b in range(a):
                if root[a] != root[b] and similarity(texts[a], texts[b]) >= 0.8:
                    low, high = sorted((root[a], root[b]))
                    root = [low if r == high else r for r in root]
        break
    return root


def corpus():
    r = random.Random(11)
    vocab = ["w%d" % i for i in range(3000)]
    text = lambda n: r.choices(vocab, k=n)
    out = ["", None, "one two", "One two.", "a b c d e", "a b c d f"]
    passage = text(40)
    for _ in range(25):
        out.append(" ".join(text(r.randint(0, 30)) + passage + text(r.randint(0, 30))))
    for _ in range(4):
        base = text(r.randint(60, 150))
        for _ in range(14):
            copy = list(base)
            for _ in range(r.randint(0, 7)):
                copy[r.randrange(len(copy))] = r.choice(vocab)
            out.append(" ".join(copy))
    return out + [out[10]] * 3 + [" ".join(text(100)) for _ in range(10)]


def test_classes_equal_brute_force(spark):
    texts = corpus()
    want = brute(texts)
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(texts)], SCHEMA)
    for block in (2000, 3):
        got = {r["doc_id"]: r for r in near_duplicates(docs, block=block).collect()}
        assert [got[i]["class_id"] for i in range(len(texts))] == want
        assert all(got[i]["class_size"] == want.count(want[i]) for i in range(len(texts)))


def test_short_texts_and_shared_identifiers(spark):
    r = random.Random(4)
    texts = []
    for _ in range(120):  # 8 and 9 words, 4 and 5 shingles: one word more is a similarity of 0.8
        base = ["v%d" % r.randrange(10**6) for _ in range(8)]
        texts += [" ".join(base), " ".join([*base, "more"])]
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {x["doc_id"]: x["class_id"] for x in near_duplicates(docs).collect()}
    assert all(got[i] == got[i + 1] == i for i in range(0, len(texts), 2))
    long = [" ".join("u%d" % r.randrange(10**6) for _ in range(60)) for _ in range(3)]
    rows = [(5, long[0]), (5, long[1]), (8, long[0] + " end"), (9, long[1] + " end"), (None, long[2]), (3, long[2] + " end")]
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], SCHEMA)
    got = sorted((x["doc_id"] or -1, x["class_id"], x["class_size"]) for x in near_duplicates(docs).collect())
    assert got == [(-1, 3, 2), (3, 3, 2), (5, 5, 2), (5, 5, 2), (8, 5, 2), (9, 5, 2)]
    left = sorted((x["doc_id"], x["text"]) for x in one_of_each(docs).collect())
    assert left == sorted([(5, long[0]), (5, long[1]), (3, long[2] + " end")])


def test_nulls_repeated_rows_and_an_empty_table(spark):
    docs = spark.createDataFrame([(5, "x y z a b c", None, None)] * 2 + [(None, "p q r s t u", None, None), (6, None, None, None)], SCHEMA)
    rows = near_duplicates(docs).collect()
    assert len(rows) == 4 and sorted(r["class_size"] for r in rows) == [1, 1, 2, 2]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_alignment_against_the_full_table():
    r = random.Random(2)
    for _ in range(100):
        a = [r.choice("abcdefgh") * r.randint(1, 3) for _ in range(r.randint(20, 60))]
        b = list(a)
        for _ in range(r.randint(0, 4)):
            i = r.randrange(len(b))
            b[i : i + r.randint(0, 2)] = [r.choice("xyz")] * r.randint(0, 2)
        code = lambda t: shingles(np.array([hash(w) for w in t], np.int64))
        want = similarity(" ".join(a), " ".join(b))
        got = aligned(code(a), code(b))
        assert abs(got - want) < 1e-9 if want >= 0.8 else got < 0.8


def test_sketches_follow_order():
    w = np.arange(200)
    assert (order_sketches(shingles(w)) == order_sketches(shingles(w.copy()))).all()
    moved = np.concatenate([w[100:], w[:100]])
    assert (order_sketches(shingles(w)) == order_sketches(shingles(moved))).mean() < 0.7


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(139, 200), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, **{i: 100 for i in [*range(101, 140), 200]}}


def test_similar_texts_share_a_shingle_of_their_prefixes():
    r = np.random.default_rng(3)
    for _ in range(300):
        n, extra = int(r.integers(1, 60)), 0
        a = r.integers(0, 2**63, n).astype(np.uint64)
        b = a[r.permutation(n)[int(r.integers(0, n // 5 + 1)) :]]
        extra = int(len(b) - 0.8 * n) if len(b) >= 0.8 * n else 0
        b = np.concatenate([b, r.integers(0, 2**63, max(0, extra)).astype(np.uint64)])
        same = len(set(a.tolist()) & set(b.tolist()))
        if same >= 0.8 * (len(a) + len(b) - same):
            assert set(prefix(a).tolist()) & set(prefix(b).tolist())

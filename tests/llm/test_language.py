import math
import random
from collections import Counter

import numpy as np

from rosterline.llm.language import _ODD, _PLAIN, UNKNOWN, decide, family_of, fit, gram_counts, hash_limit, held_out, identify, in_a_language, train

SCHEMA = "doc_id long, text string, lang string, lang_pred string, source int"
WORDS = {
    "en": "the of and that with this from have not which their would there about".split(), "de": "der die und nicht mit eine auch werden über für schön können".split(),
    "fr": "le la les des que dans pour être avec qui nous été où".split(), "es": "el los las que para con una está señor niño también más".split(), "xx": "zzq qzz zqz qqz zzzq".split(),
}


def corpus(n=1200):
    r = random.Random(5)
    return [(i, " ".join(r.choices(WORDS[lang], k=r.randint(8, 60))), lang, "?", 1) for i in range(n) for lang in [r.choice(list(WORDS))]]


def test_held_out_accuracy(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    model = train(docs, sample=400)
    assert family_of("xx") == "xx" and set(model["families"]) == {"germanic", "romance", "xx"}
    out = identify(docs, model).withColumn("out", held_out("doc_id")).collect()
    assert all(0 <= r["lang_score"] <= 1 for r in out) and len(out) == 1200
    test = [r for r in out if r["out"]]
    assert 200 < len(test) < 400 and np.mean([r["lang"] == r["lang_pred"] for r in test]) > 0.97
    again = train(docs.repartition(5), sample=400)
    assert np.array_equal(model["w"], again["w"])


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "en", None, None), (2, "", "en", None, None), (3, "12 !?", "de", None, None), (None, "the of and", "en", None, None), (5, "the of " * 20000, None, None, None)], SCHEMA)
    assert train(docs) is None and train(docs.limit(0)) is None
    assert {r["lang_pred"] for r in identify(docs, None).collect()} == {UNKNOWN}
    full = spark.createDataFrame(corpus(300), SCHEMA)
    got = {r["doc_id"]: r for r in identify(docs, train(full)).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == [UNKNOWN] * 3 and got[None]["lang_pred"] == "en" and got[5]["lang_pred"] == "en"
    assert in_a_language(full.unionByName(docs)).columns == docs.columns
    one = spark.createDataFrame([(i, "le la", "fr", None, None) for i in range(20)], SCHEMA)
    assert {r["lang_pred"] for r in identify(one, train(one)).collect()} == {"fr"}


def plain(text, model):
    """Grams one by one, each classifier by itself, votes counted: what identify has to give."""
    data = b"    " + text.lower().encode().translate(_PLAIN) + b"    "
    counts = Counter()
    for i in range(3, len(data) - 4):
        if data[i] == data[i + 1] == 32:
            continue
        h = 0
        for k in range(4):
            h = (h ^ data[i + k]) * int(_ODD[k]) & 0xFFFFFFFF
            h ^= h >> 15
            counts[h >> 3 & 4095] += 1
    total = sum(counts.values())
    p = [1 / (1 + math.exp(-float(s) * (sum(n / total * float(model["w"][b, j]) for b, n in counts.items()) + float(c)))) for j, (c, s) in enumerate(zip(model["b"], model["steep"]))]
    families = model["families"]
    shares = [x / sum(p[: len(families)]) for x in p[: len(families)]]
    family = families[shares.index(max(shares))]
    votes = {m: [0, 0.0] for m in model["members"][family]}
    for (name, a, b), q in zip(model["pairs"], p[len(families) :]):
        if name == family:
            votes[a if q >= 0.5 else b][0] += 1
            votes[a][1], votes[b][1] = votes[a][1] + q, votes[b][1] + 1 - q
    best = max(sorted(votes), key=lambda m: votes[m])
    return best, max(shares) * (votes[best][1] / (len(votes) - 1) if len(votes) > 1 else 1.0)


def test_equals_a_plain_reading(spark):
    r = random.Random(6)
    docs = corpus(400)
    mixed = [(1000 + i, " ".join(r.choices(WORDS[r.choice(list(WORDS))], k=1)[0] if r.random() < 0.7 else r.choice(["ÉTÉ", "x1", "!!", "漢字", "Über"]) for _ in range(r.randint(1, 9))), "en", "?", 1) for i in range(120)]
    df = spark.createDataFrame(docs + mixed, SCHEMA)
    model = train(df, sample=300)
    got = {x["doc_id"]: (x["lang_pred"], x["lang_score"]) for x in identify(df.filter("doc_id >= 1000 or doc_id < 60"), model).collect()}
    texts = {i: t for i, t, *_ in docs[:60] + mixed}
    for i, (lang, score) in got.items():
        want = plain(texts[i], model) if any(c.isalpha() for c in texts[i]) else (UNKNOWN, 0.0)
        assert lang == want[0] and abs(score - want[1]) < 1e-4, (texts[i], want)


def test_counts_do_not_depend_on_neighbours():
    texts = ["Ab c", "", "é!é", "x" * 3000]
    together = list(gram_counts(texts))
    assert all(np.array_equal(a, next(gram_counts([t]))) for a, t in zip(together, texts)) and together[1].sum() == 0


def test_one_versus_one_votes():
    r = np.random.default_rng(0)
    centers = {lang: r.random(4096).astype(np.float32) / 4096 for lang in ("fr", "es", "it", "en")}
    x = np.stack([centers[lang] + r.normal(0, 1e-5, 4096).astype(np.float32) for lang in centers for _ in range(30)])
    model = fit(x, [lang for lang in centers for _ in range(30)])
    assert len(model["pairs"]) == 3 and all(decide(model, centers[lang])[0] == lang for lang in centers)


def test_the_sample_is_bounded_whatever_the_corpus(spark, monkeypatch):
    from rosterline.llm import language

    for rows in (10, 1000, 10**6, 10**9, 10**11, 10**13):
        assert hash_limit(500, rows) / 2**60 * rows <= 2 * 500 + 65
    assert hash_limit(500, 700) == 1 << 60
    seen = []
    monkeypatch.setattr(language, "fit", lambda x, langs: seen.append(len(langs)))
    many = corpus(900) + [(7, "the of and with", "en", "?", 1)] * 900 + [(7, f"the of and w{i}", "en", "?", 1) for i in range(300)]
    docs = spark.createDataFrame(many, SCHEMA)
    train(docs, sample=100)
    train(docs, sample=10**6)
    assert seen[0] == 100 and 500 < seen[1] <= 1500
    clash = in_a_language(docs.limit(0))
    assert clash.columns == docs.columns and clash.count() == 0


def test_own_columns_stay(spark):
    docs = spark.createDataFrame(corpus(300), SCHEMA)
    assert {r["lang_pred"] for r in in_a_language(docs).collect()} == {"?"}

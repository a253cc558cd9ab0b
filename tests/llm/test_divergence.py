import random
import re
from collections import Counter, defaultdict

from rosterline.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(rows, least=10, top=10):
    uses, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        w = words(text)
        uses[lang or "", source or ""].update(w)
        docs[lang or ""].update(set(w))
    kept = {lang: [t for t, n in c.items() if n >= least] for lang, c in docs.items()}
    share = lambda n, total, v: 1 + 1_000_000_000 * (n + 2) // (total + 2 * v)
    f = lambda p, q: (p - q) ** 2 // (p + q)
    total = {g: sum(uses[g][t] for t in kept[g[0]]) for g in uses}
    out = set()
    for lang, source in uses:
        terms = kept[lang]
        mine = {t: share(uses[lang, source][t], total[lang, source], len(terms)) for t in terms}
        all_ = {t: sum(uses[g][t] for g in uses if g[0] == lang) for t in terms}
        pairs = []
        for other in sorted(s for x, s in uses if x == lang and s != source):
            pairs.append((sum(f(mine[t], share(uses[lang, other][t], total[lang, other], len(terms))) for t in terms), other))
        over = []
        for t in terms:
            q = share(all_[t], sum(all_.values()), len(terms))
            if uses[lang, source][t] and mine[t] > q:
                over.append((f(mine[t], q), t))
        for part, found in (("pair", pairs), ("term", over)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(found) if part == "pair" or k < top}
    return out


def corpus():
    r = random.Random(5)
    vocab = ["w" + "abcdefghij"[i % 10] * (i // 10 + 1) for i in range(60)] + ["Été", "é", "ÉTÉ", "漢字", "x\x85y", "a\xa0b"]
    rows = []
    for i in range(400):
        lang, source = r.choice(["en", "fr", None, ""]), r.choice(["s0"] * 5 + ["s1", "S1", None, "é", "z"])
        lean = vocab[:30] if source == "s0" else vocab
        rows.append((i, r.choice([" ", "-", "\n", "1", "_", "\x00"]).join(r.choices(lean, k=r.randint(0, 30))), lang, source, "t", 1))
    rows += rows[:5]  # repeated rows
    rows += [(900, None, "en", "empty", None, None), (901, "12 34", "de", "a", None, None), (902, "", "de", "b", None, None), (903, "seul", "xx", "one", None, None)]
    rows += [(None, "Word " * 3000, "en", "s1", None, None)] * 12
    return rows


def test_counts_of_a_text():
    assert D.terms("The cat, THE Été-x2y _z\x85 a\xa0b".encode()) == Counter({b"the": 2, b"cat": 1, "Été".encode(): 1, b"x": 1, b"y": 1, "z\x85".encode(): 1, "a\xa0b".encode(): 1})


def test_equals_brute_force(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute(rows)
    assert {x[2] for x in want} == {"pair", "term"} and len(want) > 100
    got = D.divergence(docs).select("lang", "source", "part", "item", "value", "rank").collect()
    assert len(got) == len(want) and {tuple(x) for x in got} == want
    monkeypatch.setattr(D, "_CELLS", 40)  # many blocks
    got = D.divergence(docs).select("lang", "source", "part", "item", "value", "rank").collect()
    assert len(got) == len(want) and {tuple(x) for x in got} == want


def test_counts_leave_a_task_when_they_are_many(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(D, "_HELD", 10)
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 50, "source": ["a", "b"] * 25, "text": [" ".join("abcdefgh"[(i + k) % 8] for k in range(5)) for i in range(50)]})
    out, parts = Counter(), 0
    for b in D._count_rows(iter([batch, batch])):
        parts += 1
        for x in b.to_pylist():
            out[x["source"], x["term"]] += x["docs"]
    assert parts > 2 and out["a", ""] == 50 and sum(n for (_, t), n in out.items() if t) == 500


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert D.divergence(docs).count() == 0
    assert D.divergence(docs).columns == ["lang", "source", "part", "item", "value", "rank"]
    one = spark.createDataFrame([(1, "few", "en", "a", None, None), (2, "few", "en", "b", None, None)], SCHEMA)
    assert {tuple(x) for x in D.divergence(one).collect()} == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}

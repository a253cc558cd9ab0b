import hashlib
import random
import re

from pyspark.sql import functions as F

from rosterline.llm.personal import find_personal, joined

SCHEMA = "doc_id long, text string, value string, k int"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


def corpus():
    r = random.Random(4)
    bits = ["a", "b.c", "@", ".", "..", "x.y", "-", "+", "+1", " ", "  ", "é", "12", "255", "256", "0", "4111 1111 1111 1111", "4111111111111111", "(", ")", "555", "1.2.3.4", "_", "%", "\n", "a@b.c", "😀"]
    texts = ["".join(r.choices(bits, k=r.randint(0, 25))) for _ in range(600)]
    texts += ["call +1 (555) 010-%04d now" % i for i in range(60)] + ["card 4111-1111-1111-1111.", "mail bob (at) host (dot) org today", None, ""]
    texts += ["1" * 30000, "a" * 30000 + "@", "a@" + "b." * 20000 + "c", "1 " * 20000, "1." * 20000, "+" + "1-" * 20000]
    return texts


def test_base_spans_equal_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "v", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r for r in find_personal(docs).withColumn("sha", F.sha2(joined("base_spans"), 256)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = base(text)
        row = got[i]
        assert [tuple(s) for s in row["base_spans"]] == want, (text or "")[:200]
        assert row["sha"] == hashlib.sha256(",".join("%s:%d:%d" % s for s in want).encode()).hexdigest()
        assert row["n_card"] == sum(k == "card" for k, _, _ in want)
        spans = [tuple(s) for s in row["spans"]]
        assert set(want) <= set(spans)
        added = sorted(set(spans) - set(want), key=lambda s: s[1])
        assert all(a[2] <= b[1] for a, b in zip(added, added[1:])) and not any(a[1] < b[2] and b[1] < a[2] for a in added for b in want)


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    docs = spark.createDataFrame([(3, "a@b.co x 10.0.0.1", None, None)] * 2 + [(None, "c@d.ef", None, None), (None, None, None, None)], SCHEMA)
    rows = find_personal(docs).collect()
    assert sorted((r["doc_id"] or -1, r["n_email"], r["n_ip"]) for r in rows) == [(-1, 0, 0), (-1, 1, 0), (3, 1, 1), (3, 1, 1)]
    assert find_personal(docs.limit(0)).count() == 0


def test_what_the_trees_add_follows_what_they_learned(spark):
    r = random.Random(8)
    phone = lambda i: "please call tel %s %03d %03d %04d today" % ("+1" if i % 20 else "1", r.randint(200, 999), r.randint(100, 999), r.randint(0, 9999))
    texts = [phone(i) for i in range(2000)]
    docs = spark.createDataFrame([(i, t, "v", 0) for i, t in enumerate(texts)], SCHEMA)
    rows = find_personal(docs, precision=0.8).collect()
    assert sum(x["n_phone"] for x in rows) == 1900 and all(len(x["spans"]) == 1 for x in rows)
    # Without base matches there is nothing to learn from, and nothing is added.
    rows = find_personal(docs.filter("not text like '%+1%'")).collect()
    assert len(rows) == 100 and not any(x["spans"] for x in rows)


def luhn_card(r):
    while True:
        digits = [r.randint(0, 9) for _ in range(16)]
        if passes("card", "".join(map(str, digits))):
            return "".join(map(str, digits))


def test_other_forms_are_found_however_common(spark):
    r = random.Random(9)
    two = lambda: "".join(r.choices("abcdefgh", k=5))
    octets = lambda: [str(r.randint(100, 255)) for _ in range(4)]
    quads = lambda c: [c[i : i + 4] for i in range(0, 16, 4)]
    phone = lambda: "1 (%03d) 555-%04d" % (r.randint(200, 999), r.randint(0, 9999))
    usual = {"email": lambda: f"{two()}@{two()}.org", "ip": lambda: ".".join(octets()), "card": lambda: luhn_card(r), "phone": lambda: "+" + phone()}
    other = {
        "email": [lambda: f"{two()} (at) {two()} (dot) org", lambda: f"{two()}[at]{two()}[dot]org"], "ip": [lambda: ", ".join(octets()), lambda: ":".join(octets())],
        "card": [lambda m=m: m.join(quads(luhn_card(r))) for m in "./_"], "phone": [phone, lambda: "0%d %04d %04d" % (r.randint(20, 99), r.randint(0, 9999), r.randint(0, 9999))],
    }
    clean = ["on 2024-01-15 and 31.12.2023", "rows 1, 2, 3, 4 and 120, 130, 140, 150, 160", "years 2019 2020 2021", "sums 12.345.678 and 12 345 678", "at 10:15:30:123"]
    for share in (0.02, 0.25, 0.9):
        rows, want = [], {}
        for i in range(1200):
            kind = r.choice(list(usual))
            value = r.choice(other[kind])() if r.random() < share else usual[kind]()
            rows.append((i, f"{two()} {value} {two()}", "v", 0))
            want[i] = [(kind, 6, 6 + len(value))]
        rows += [(5000 + i, c, "v", 0) for i, c in enumerate(clean)]
        got = {x["doc_id"]: [tuple(s) for s in x["spans"]] for x in find_personal(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert [(rows[i][1], got[i]) for i in want if got[i] != want[i]] == []
        assert [(c, got[5000 + i]) for i, c in enumerate(clean) if got[5000 + i]] == []

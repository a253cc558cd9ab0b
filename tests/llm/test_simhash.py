import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from rosterline.llm import simhash as S

SCHEMA = "doc_id long, text string, fingerprint string, component_id int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    h = [xxhash.xxh64(" ".join(w[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints):
    """The least member of each fingerprint's component, by all pairs."""
    prints = sorted(set(prints))
    root = {p: p for p in prints}
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 3 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {p: low if r == high else r for p, r in root.items()}
    return root


def corpus():
    r = random.Random(9)
    vocab = [f"Word{i}" for i in range(400)] + ["É", "x\xa0y", "漢字"]
    out = [(0, None), (1, ""), (2, " \t\n\x0b\x0c\r "), (3, "one"), (4, "ONE"), (5, "two words"), (6, "a b c"), (7, "\x85 \x1c a")]
    for i in range(30):
        base = r.choices(vocab, k=r.randint(80, 200))
        for _ in range(r.randint(1, 6)):
            new = list(base)
            for _ in range(r.randint(0, 3)):
                new[r.randrange(len(new))] = r.choice(vocab)
            out.append((len(out) + 10, r.choice([" ", "\n", "  "]).join(new)))
    long = " ".join(r.choices(vocab, k=60_000))
    return out + [(900, long), (901, long + " End"), (8, "one"), (8, "other"), (None, "one"), (None, "nobody else says this"), (None, "nobody else says this")]


@pytest.mark.parametrize("block", [2000, 2])
def test_equals_brute_force(spark, block):
    rows = corpus()
    root = classes(plain(t) for _, t in rows)
    least = {}
    for i, t in rows:
        if i is not None:
            c = root[plain(t)]
            least[c] = min(least.get(c, i), i)
    want = sorted(str((i, f"{plain(t):016x}", least.get(root[plain(t)]))) for i, t in rows)
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA).repartition(5)
    got = S.simhash_components(docs, block=block)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(str(tuple(x)) for x in got.collect()) == want
    assert len(set(root.values())) < len(root)
    assert S.simhash_components(docs.limit(0), block=block).count() == 0


def test_pieces_of_a_long_text(monkeypatch):
    texts = [t or "" for _, t in corpus()]
    whole = [S.fingerprint(t.encode()) for t in texts]
    assert whole == [plain(t) for t in texts]
    monkeypatch.setattr(S, "_PIECE", 7)
    assert [S.fingerprint(t.encode()) for t in texts if len(t) < 5000] == [p for p, t in zip(whole, texts) if len(t) < 5000]


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_three_bits_share_a_key_of_every_chain(a, flips):
    """From some start, two fingerprints within 3 bits agree on a key of each length."""
    b = a
    for f in flips:
        b ^= 1 << f
    starts = set(range(4))
    for length in range(1, 5):
        table = S.kept_bits(length)
        starts &= {s for s, bits in table if not (a ^ b) & bits}
    assert starts


def test_number_of_keys():
    assert [len(S.kept_bits(k)) for k in range(1, 5)] == [4, 4 * 16, 4 * 376, 4 * 10416]
    assert all(int(bits).bit_count() == 16 * k - k + 1 for k in range(1, 5) for _, bits in S.kept_bits(k)[:50])


def close_together(n, seed):
    """Many fingerprints around a few centres, so that keys of every length are large."""
    r = random.Random(seed)
    centres = [r.getrandbits(64) for _ in range(3)]
    out = set()
    while len(out) < n:
        p = r.choice(centres)
        for _ in range(r.randint(0, 9)):
            p ^= 1 << r.randrange(64)
        out.add(p)
    return sorted(out)


@pytest.mark.parametrize("block,n", [(1, 120), (5, 250), (40, 500), (2000, 500)])
def test_links_of_crowded_fingerprints(spark, block, n):
    prints = close_together(n, block)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    found = S.links(spark.createDataFrame([(p,) for p in signed], "print long"), block).collect()
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        a, b = a % 2**64, b % 2**64
        assert (a ^ b).bit_count() <= 3
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {p: find(p) for p in prints} == classes(prints)

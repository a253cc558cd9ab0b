import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from rosterline.llm.packing import Encoder, cost, pack, pack_sequences, vocabulary_path

SCHEMA = "doc_id long, text string, start string, shard int"


@pytest.fixture(scope="module")
def plain():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_tokenizers(plain):
    r, encoder = random.Random(1), Encoder(vocabulary_path(), most=50)
    bits = [" ", "\n", "\t", "a", "Bc", "é", "1", "²", "'s", ".", "#,", "  ", "\x1c", "　", "漢", "<|endoftext|>", " \n", "word", "́", "\xa0", "\x85", "\u2028", "\u2003", "\ufeff", "\u200b", "\r", "\r\n", "\x0b", "\x0c", "\n\xa0"]
    for _ in range(100_000):
        text = "".join(r.choices(bits, k=r.randint(0, 16)))
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == plain(text), repr(text)


def test_every_id_lies_in_one_piece_and_little_is_left():
    r = random.Random(2)
    for sizes in ([], [1], [2048], [2049], [5000, 1, 1], [r.randint(1, 3000) for _ in range(2000)], [1500] * 301, [2047] * 50):
        placed = pack(sizes)
        by_doc, by_seq = defaultdict(list), defaultdict(list)
        for doc, start, n, seq, offset in placed:
            by_doc[doc].append((start, n))
            by_seq[seq].append((offset, n))
        for doc, size in enumerate(sizes):
            at = 0
            for start, n in sorted(by_doc[doc]):
                assert start == at and n > 0
                at += n
            assert at == size
        for parts in by_seq.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= 2048
        assert len(by_seq) == -(-sum(sizes) // 2048)


def test_costs_are_balanced():
    sizes = [random.Random(3).randint(10, 900) for _ in range(3000)]
    costs = defaultdict(float)
    for _, _, n, seq, _ in pack(sizes):
        costs[seq] += cost(n)
    values = np.array(list(costs.values()))
    assert values.std() / values.mean() < 0.2


def test_table(spark, plain):
    r = random.Random(4)
    texts = ["", None, "one", "<|endoftext|>x", "a " * 6000] + [" ".join(r.choices(["word", "other", "é1"], k=r.randint(0, 900))) for _ in range(60)] + ["same", "same"]
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)] + [(None, "n", None, None)], SCHEMA)
    rows = pack_sequences(docs, vocabulary_path(), shard_bytes=40_000, with_ids=True).collect()
    again = pack_sequences(docs.repartition(5), vocabulary_path(), shard_bytes=40_000).drop("sequence_cost").collect()
    plain_row = lambda x: tuple(str(x[c]) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))
    assert sorted(map(plain_row, rows)) == sorted(map(plain_row, again))
    seen, length = defaultdict(dict), defaultdict(int)
    for x in rows:
        assert x["ids_crc32"] == zlib.crc32(np.array(x["ids"], "<u4").tobytes()) and len(x["ids"]) == x["length"]
        seen[x["doc_id"]][x["start"]] = x["ids"]
        length[x["sequence_id"]] += x["length"]
        assert x["doc_tokens"] == len(plain(texts[x["doc_id"]] or "" if x["doc_id"] is not None else "n")) + 1
    for i, t in [*enumerate(texts), (None, "n")]:
        assert [v for s in sorted(seen[i]) for v in seen[i][s]] == plain(t or "") + [1]
    assert max(length.values()) <= 2048
    assert pack_sequences(docs.limit(0), vocabulary_path()).count() == 0

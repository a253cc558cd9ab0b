from collections import defaultdict

from pyspark.sql import functions as F

from rosterline.llm.common import numbered
from rosterline.llm.mixing import mix_sources
from rosterline.llm.packing import pack_sequences, vocabulary_path


def test_equal_rows_are_numbered(spark):
    rows = spark.createDataFrame([(1, "a")] * 50 + [(2, "b"), (2, "c"), (3, "d"), (3, "d")], "k long, v string").repartition(5)
    got = defaultdict(list)
    for k, v, n in numbered(rows, ["k", "v"], "n", parts=7).select("k", "v", "n").collect():
        got[k, v].append(n)
    assert {k: sorted(v) for k, v in got.items()} == {(1, "a"): list(range(50)), (2, "b"): [0], (2, "c"): [0], (3, "d"): [0, 1]}
    assert numbered(rows.dropDuplicates(), ["k", "v"], "n").filter("n <> 0").count() == 0


def test_repeated_rows_are_spread(spark):
    """200,000 equal rows: no shard of the packing, and no part of the mix, gets more than a tenth."""
    docs = spark.range(0, 200_000, 1, 8).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same words").alias("text"), F.lit("s").alias("source"))
    pieces = pack_sequences(docs, vocabulary_path(), shard_bytes=100_000)
    shards = pieces.groupBy(F.shiftright("sequence_id", 32).alias("s")).agg(F.countDistinct("sequence_id", "offset").alias("n"), F.sum("length").alias("tokens")).collect()
    assert len(shards) == 28 and max(x["n"] for x in shards) < 20_000 and sum(x["tokens"] for x in shards) == 200_000 * (len_of("the same words") + 1)
    mixed = mix_sources(docs).agg(F.count("*"), F.sum("mix_taken"), F.countDistinct("mix_taken")).first()
    assert tuple(mixed)[:2] == (200_000, 600_000)


def len_of(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    return len(Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json"))).encode(text, add_special_tokens=False).ids)

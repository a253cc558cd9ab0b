"""Importance resampling: draw the documents whose n-grams are as likely under a target text as under the corpus, with noise."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ident, staged, unident

BUCKETS = 10_000
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SLICE = 8 << 20  # bytes of text that the kernels work on at a time; a longer text is a slice of its own


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Neighbouring texts of about ``_SLICE`` bytes."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + _SLICE, "right")))
        yield texts.slice(at, to - at)
        at = to


def feature_buckets(texts: pa.Array, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, owner of each feature, bucket of each feature) for all runs of 1 to n words.

    Words become indices into a dictionary; a run of k words is k shifted indices. Each distinct run of a slice is hashed
    once and its bucket taken for all places.
    """
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), _SEPARATORS)
    flat, owner = pc.list_flatten(parts), pc.list_parent_indices(parts)
    full = pc.greater(pc.binary_length(flat), 0)  # a separator at either end leaves an empty part there
    flat, owner = flat.filter(full), owner.filter(full).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.dictionary_encode(flat)
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owners, found = [], []
    run, spelled = index, words
    for k in range(1, n + 1):
        if k > 1:  # runs of k words: those of k - 1 and the word after them, in the same text
            m = len(index) - k + 1
            inside = owner[:m] == owner[k - 1 :] if m > 0 else np.zeros(0, bool)
            pair, run_of = np.unique(run[: max(m, 0)] * len(words) + index[k - 1 :], return_inverse=True)
            spelled = [spelled[p // len(words)] + b" " + words[p % len(words)] for p in pair.tolist()]
            run = run_of
        else:
            inside = np.ones(len(index), bool)
        crc = np.fromiter((zlib.crc32(s) % buckets for s in spelled), np.int64, len(spelled))
        found.append(crc[run[inside]])
        owners.append(owner[: len(inside)][inside])
    return np.bincount(owner, minlength=len(texts)), np.concatenate(owners), np.concatenate(found)


def bucket_counts(docs: DataFrame, text_col: str, n: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task adds up its own texts first; the driver gets one number a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts in _slices(batch.column(0)):
                total += np.bincount(feature_buckets(texts, n, buckets)[2], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, k in rows.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = k
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1) (S + B) / ((s + 1) (T + B)))) of each of the B buckets."""
    b = len(corpus)
    ratio = (target + 1.0) * float(corpus.sum() + b) / ((corpus + 1.0) * float(target.sum() + b))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def importance_resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", n: int = 1, buckets: int = BUCKETS,
    percent: int = 10, least_words: int = 20, seed: int = 2024,
) -> DataFrame:
    """Rows (identifier, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank``): which documents a draw towards ``target`` takes, in order.

    A-Z are lower-cased; words are runs of digits, letters and characters beyond ASCII; features are all runs of 1 to ``n``
    words, hashed to ``buckets``. A document's weight is the floored mean of its features' gains, ``score`` is the weight
    with Gumbel noise from a seeded hash of the identifier. Of the documents with ``least_words`` words, ``percent`` of a
    hundred are drawn, those with the highest scores, ties to the smaller identifier; ``rank`` is their place, null for
    all others.

    Null text has no words; a document without features has weight 0. Rows that share an identifier share their noise and
    count each; equal rows get neighbouring ranks; a null identifier is hashed as an empty one and below all others in ties.
    An empty corpus gives an empty result; an empty target gives gains that favour rare features. Other columns are
    ignored, whatever their names.

    Texts are read twice, once for counts of buckets and once for weights; both counts and gains are a number for each
    bucket, so what reaches the driver and the tasks is bounded by ``buckets``. Kernels work on slices of about 8 MB. The
    least score drawn is found from counts by score: scores are whole numbers of a bounded range, since gains and noise are
    thousand times logarithms. Only documents from that score on are put in order, by range partitions, in which a score or
    identifier that very many rows share is split; places follow from the sizes of the partitions, so no window sees
    all rows.
    """
    gain = gains(bucket_counts(docs, text_col, n, buckets), bucket_counts(target, target_col, n, buckets))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _slices(batch.column(1)):
                words, owner, bucket = feature_buckets(texts, n, buckets)
                features = np.bincount(owner, minlength=len(texts))
                order = np.argsort(owner, kind="stable") if n > 1 else slice(None)
                starts = np.concatenate([[0], np.cumsum(features)[:-1]])
                some = features > 0
                total = np.zeros(len(texts), np.int64)
                if some.any():
                    total[some] = np.add.reduceat(gain[bucket[order]], starts[some])
                weight = total // np.maximum(features, 1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *map(pa.array, (words, features, weight))], names=["nid", "n_words", "n_features", "weight"])
                at += len(texts)

    rows = docs.select(ident(id_col).alias("nid"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    weighed = rows.mapInArrow(weigh, "nid long, n_words long, n_features long, weight long")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(unident("nid").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    # A written row keeps its number, so rows that are equal in all else have one order.
    scored = staged(weighed.withColumn("score", F.col("weight") + noise).withColumn("row", F.monotonically_increasing_id()), "scores")

    fit = F.col("n_words") >= least_words
    by_score = scored.filter(fit).groupBy("score").agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.orderBy(F.desc("score")))  # one row for each score that occurs
    drawn = F.expr(f"sum(n) over () * {int(percent)} div 100")
    cut = by_score.select("score", above.alias("above"), drawn.alias("drawn")).filter("drawn > 0 and above >= drawn").agg(F.max("score"), F.max("drawn")).first()
    least, number = cut if cut[0] is not None else (None, 0)
    inside = fit & (F.col("score") >= F.lit(least)) if number else F.lit(False)
    ordered = scored.filter(inside).withColumn("down", -F.col("score")).repartitionByRange("down", "nid", "row").withColumn("part", F.spark_partition_id())
    ordered = staged(ordered, "ordered")
    sizes = ordered.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy("down", "nid", "row"))
    ranked = ordered.join(before, "part").withColumn("place", place).withColumn("rank", F.when(F.col("place") <= number, F.col("place")))
    out = ranked.select("nid", "n_words", "n_features", "weight", "score", "rank")
    out = out.unionByName(scored.filter(~F.coalesce(inside, F.lit(False))).select("nid", "n_words", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))
    return out.withColumn("nid", unident("nid")).withColumnRenamed("nid", id_col)


def op13_resample(spark, sf_dir):
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return importance_resample(docs, target).drop("n_words")


OP13_SQL = r"""
WITH hex AS (SELECT '0123456789abcdef' AS digits),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
f AS (SELECT doc_id, unnest(words) AS word FROM d),
w AS (SELECT DISTINCT word, lower(hex(encode(word))) AS h FROM (SELECT word FROM f UNION ALL SELECT word FROM b)),
byte AS (
  SELECT word, list_transform(range(0, len(h) // 2), lambda i: 16 * (position(substr(h, 2 * i + 1, 1) IN digits) - 1) + position(substr(h, 2 * i + 2, 1) IN digits) - 1) AS bytes
  FROM w, hex),
crc AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, x:
      list_reduce(list_prepend(xor(c, x), range(0, 8)), lambda y, k: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END))) % 10000 AS bucket
  FROM byte),
s AS (SELECT bucket, count(*) AS s FROM f JOIN crc USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN crc USING (word) GROUP BY bucket),
g AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s)::DOUBLE + 10000)
      / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0)::DOUBLE + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
a AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS total FROM f JOIN crc USING (word) JOIN g USING (bucket) GROUP BY doc_id),
v AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
         ('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN a USING (doc_id)),
e AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM v),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS eligible FROM e WHERE n_features >= 20)
SELECT e.doc_id, n_features, weight, score, CASE WHEN place <= 10 * eligible // 100 THEN place END::BIGINT AS rank
FROM e LEFT JOIN r USING (doc_id)
"""

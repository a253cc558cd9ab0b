"""Mixing sources to target weights by subset-sum budget fitting."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import ident, n_words, numbered, staged

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
_BUCKETS = 1024  # parts of a (source, size) class by the seeded hash, so that no class is ranked in one task


def targets(sizes: list[int], weights: list[float], most: int = MOST_REPEATS) -> list[float]:
    """Share the total of sizes by weight; a target stops at ``most`` times its size, the excess is shared again by weight."""
    total, open_ = float(sum(sizes)), [i for i, s in enumerate(sizes) if s > 0]
    out, left = [0.0] * len(sizes), total
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = unit * weights[i]
            break
        for i in over:
            out[i] = float(most * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in over]
    return out


def _best_sum(lengths: np.ndarray, spare: np.ndarray, rest: int, order: np.ndarray) -> np.ndarray:
    """How many of each length, at most ``spare``, reach the best sum up to ``rest``: a bounded knapsack over all lengths,
    in a table of one entry for each multiple of their common divisor. Lengths come in ``order`` until the rest is reached.
    """
    got = np.zeros(len(lengths), np.int64)
    usable = [i for i in order.tolist() if 0 < lengths[i] <= rest and spare[i] > 0]
    if not usable:
        return got
    unit = int(np.gcd.reduce(lengths[usable]))
    rest //= unit
    # by[s]: the step that first made the sum s; a step adds so many of one length
    by, steps = np.full(rest + 1, -1, np.int32), []
    seen = np.zeros(rest + 1, bool)
    seen[0] = True
    for i in usable:
        size = int(lengths[i]) // unit
        left, step = min(int(spare[i]), rest // size), 1
        while left > 0:  # doubling steps: 1, 2, 4, ... copies at a time
            n = min(step, left)
            new = np.zeros(rest + 1, bool)
            new[n * size :] = seen[: rest + 1 - n * size]
            new &= ~seen
            by[new] = len(steps)
            steps.append((i, n))
            seen |= new
            left -= n
            step *= 2
        if seen[rest]:
            break
    best = int(np.flatnonzero(seen)[-1])
    while best:
        i, n = steps[by[best]]
        got[i] += n
        best -= n * int(lengths[i]) // unit
    return got


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, table: int = 1 << 14, seed: int = 17) -> np.ndarray:
    """How many documents of each length to take so that their lengths sum to the budget or as near below it as can be found.

    Lengths share the budget in proportion to their counts. Shares are rounded up or down by a seeded systematic draw along
    the lengths: each is rounded up as often as its fraction says, and the sum misses the budget by no more than about the
    longest length. That rest is fitted by a bounded knapsack over all that is left, in a seeded order; where it misses the
    budget, up to 124 of those rounded up are given back by the seed and fitted too. Where that misses as well and the
    shares rounded down leave at most ``table``, the best sum over those is taken if it is nearer. Both are tries to come
    nearer: however large the budget and the lengths, all documents are among those that are chosen from, and the first
    fit already misses the budget by less than the longest length.
    """
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    total = int((lengths * counts).sum())
    if total == 0 or budget <= 0:
        return np.zeros(len(lengths), np.int64)
    floor = np.array([int(c) * budget // total for c in counts.tolist()], np.int64)
    part = np.array([int(c) * budget % total / total if size else 0.0 for c, size in zip(counts.tolist(), lengths.tolist())])
    draw = np.random.default_rng([seed, budget, total])
    along = np.argsort(lengths, kind="stable")
    up = np.zeros(len(lengths), np.int64)
    up[along] = np.diff(np.floor(np.cumsum(part[along]) + draw.random()).astype(np.int64), prepend=0)
    up = np.minimum(up, counts - floor)
    over = int((lengths * (floor + up)).sum()) - budget
    while over > 0:  # the shortest document that makes up for it, or the longest
        added = np.flatnonzero(up * lengths)
        enough = added[lengths[added] >= over]
        i = int(enough[np.argmin(lengths[enough])]) if len(enough) else int(added[np.argmax(lengths[added])])
        up[i] -= 1
        over -= int(lengths[i])
    order = draw.permutation(len(lengths))
    take, back = floor + up, 0
    up_again = draw.permutation(np.flatnonzero(up * lengths))
    fitted = take + _best_sum(lengths, counts - take, -over, order)
    while int((lengths * fitted).sum()) < budget and back < min(64, len(up_again)):
        # Little can be added to a small rest: a few of those rounded up are given back, the longer the rest is missed the more.
        give = up_again[back : 2 * back + 4]
        back += len(give)
        take[give] -= up[give]
        other = take + _best_sum(lengths, counts - take, budget - int((lengths * take).sum()), order)
        fitted = other if int((lengths * other).sum()) > int((lengths * fitted).sum()) else fitted
    take = fitted
    rest = budget - int((lengths * floor).sum())
    if int((lengths * take).sum()) < budget and rest <= table:
        other = floor + _best_sum(lengths, counts - floor, rest, order)
        take = other if int((lengths * other).sum()) > int((lengths * take).sum()) else take
    return take


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, seed: int = 17,
) -> DataFrame:
    """The columns of ``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_taken`` for each row.

    A document's size is its number of words. Sources in code point order, null last, have the weights in turn and share
    the total of all sizes; see ``targets``. A source's documents are taken whole: as many full rounds as its target
    holds, then documents of certain lengths, by ``fit_budget`` over the count of documents by exact length, chosen by a
    seeded hash. ``mix_taken`` is the size times the rounds that take the document, at most 3.

    The driver holds a row for each source. A task holds the lengths of one source, with their counts: their number grows
    at most with the square root of its size. Documents of one source and length are ranked in 1024 parts of their hash,
    so that a length that a third of all documents have is spread; equal rows are numbered and hashed with their numbers, so
    that they are too. Ties of the hash are broken by identifier and number, so reruns agree; which of several equal rows is
    taken is open. Null text has size 0 and is never taken, as other texts without words; a null source is a source;
    repeated rows count each. An empty table gives an empty result. Columns of the names above are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("mix_size", "mix_source_size", "mix_target", "mix_taken")
    own = docs.columns
    h = F.xxhash64(F.lit(seed), ident(id_col), F.coalesce(F.col(text_col), F.lit("")))
    sized = docs.select(
        *own, n_words(F.col(text_col)).alias("mix_size"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_mix_s"),
        F.col(source_col).isNull().alias("_mix_null"), ident(id_col).alias("_mix_id"), h.alias("_mix_h"),
    )
    sized = numbered(sized, ["_mix_s", "_mix_null", "mix_size", "_mix_id", "_mix_h"], "_mix_copy")
    sized = sized.withColumn("_mix_h", F.when(F.col("_mix_copy") > 0, F.xxhash64("_mix_h", "_mix_copy")).otherwise(F.col("_mix_h")))
    sized = sized.withColumn("_mix_b", F.pmod("_mix_h", F.lit(_BUCKETS)))
    keys = ["_mix_s", "_mix_null", "mix_size"]
    parts = staged(sized.groupBy(*keys, "_mix_b").agg(F.count("*").alias("n")), "lengths")
    lengths = parts.groupBy(*keys).agg(F.sum("n").alias("n"))
    sources = [(r[0], r[1], r[2]) for r in lengths.groupBy("_mix_s", "_mix_null").agg(F.sum(F.col("mix_size") * F.col("n"))).collect()]
    sources.sort(key=lambda r: (r[1], r[0]))
    target = targets([r[2] for r in sources], [weights[i % len(weights)] for i in range(len(sources))])
    goal = spark.createDataFrame(
        [(s, null, size, t) for (s, null, size), t in zip(sources, target)],
        "_mix_s string, _mix_null boolean, mix_source_size long, mix_target double",
    )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        size, goal_ = int(pdf["mix_source_size"].iloc[0]), int(round(pdf["mix_target"].iloc[0]))
        rounds, budget = divmod(goal_, size) if size else (0, 0)
        pdf = pdf.sort_values("mix_size", kind="stable")
        extra = fit_budget(pdf["mix_size"].to_numpy(), pdf["n"].to_numpy(), budget, seed=seed)
        return pdf.assign(_mix_rounds=rounds, _mix_extra=np.where(pdf["mix_size"] > 0, extra, 0))[list(planned.names)]

    planned = T.StructType.fromDDL("_mix_s string, _mix_null boolean, mix_size long, mix_source_size long, mix_target double, _mix_rounds long, _mix_extra long")
    plan = lengths.join(goal, ["_mix_s", "_mix_null"]).groupBy("_mix_s", "_mix_null").applyInPandas(fit, planned)
    so_far = F.sum("n").over(Window.partitionBy(*keys).orderBy("_mix_b").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("_mix_before", F.coalesce(so_far, F.lit(0))).drop("n").join(plan, keys)
    rank = F.row_number().over(Window.partitionBy(*keys, "_mix_b").orderBy("_mix_h", "_mix_id", "_mix_copy"))
    placed = sized.withColumn("_mix_rank", rank).join(parts, [*keys, "_mix_b"])
    times = F.col("_mix_rounds") + F.when(F.col("_mix_before") + F.col("_mix_rank") <= F.col("_mix_extra"), 1).otherwise(0)
    return placed.select(*own, "mix_size", "mix_source_size", "mix_target", (F.col("mix_size") * times).alias("mix_taken"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes them, with all columns as they were."""
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(source_col).alias("s"), F.struct("*").alias("row"))
    mixed = mix_sources(rows, "i", "t", "s").filter("mix_taken > 0")
    times = F.explode(F.sequence(F.lit(1), (F.col("mix_taken") / F.col("mix_size")).cast("int")))
    return mixed.select("row", times.alias("time")).select("row.*")


def op7_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs.select("doc_id", "text", "source")).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"),
    )

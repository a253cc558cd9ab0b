"""Quality rules: text statistics, and robust multivariate outliers by language and source. DataFrame functions only."""

from __future__ import annotations

from math import log1p, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE, ident, release, staged, unident, words

SYMBOLS = "#*$%&|<>"
STATS = ("x1", "x2", "x3", "x4")
SHARE = 0.75  # of a group's texts that the estimate rests on
#: Fixed values for four statistics: the factor that makes the covariance of the central 75 % consistent for normal data,
#: and the squared distance that one in a million normal vectors exceeds.
CONSISTENCY, CUT = 1.4866, 33.38
#: Standard deviations that an estimate can't fall below: many texts have no symbol and no repeat at all, and a covariance
#: of such counts is singular. Those of repeats come from the least step of a short text: where a group has no repeats, one
#: short line again (1 of 8 lines and 6 of 75 words, both statistics at once) just stays within the cut.
FLOORS = (0.1, 0.35, log1p(100 * 6 / 75) / sqrt(CUT / 2), log1p(100 / 8) / sqrt(CUT / 2))
TRIED = 2  # concentration steps of all starts; the best one goes on
MOST_STEPS = 20  # in all, if a determinant still falls
LEAST_GROUP = 30
_FINE = 64  # bins of squared distances for each factor of e


def _windows(parts: Column) -> Column:
    """A hash of each three-word window, in order."""
    n = F.size(parts)
    return F.transform(F.slice(parts, 1, F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(parts, i + 1), F.get(parts, i + 2)))


def text_statistics(docs: DataFrame, id_col: str, text_col: str, *others: Column) -> DataFrame:
    """Identifier ``nid``, the other columns, n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of each whole text."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(ident(id_col).alias("nid"), *others, body.alias("body"), words(body).alias("w"), F.filter(F.split(body, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)) != "").alias("lines"))
    rows = rows.select("*", _windows(F.col("w")).alias("windows"))
    # A text without equal windows, the common case, is not sorted.
    sorted_ = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    rows = rows.select("*", sorted_.alias("ranked"))
    m = F.size("ranked")
    pairs = F.zip_with(F.slice("ranked", 1, m - 1), F.slice("ranked", 2, m - 1), lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)))
    starts = F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))
    covered = F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))
    names = [c for c in rows.columns if c not in ("body", "w", "lines", "windows", "ranked")]
    return rows.select(
        *names, F.size("w").cast("long").alias("n_words"), F.length(F.translate("body", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).cast("long").alias("n_symbols"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("ranked").isNull(), F.lit(0)).otherwise(covered).cast("long").alias("n_repeat_words"),
    )


def _distance() -> Column:
    """Squared Mahalanobis distance of (x1..x4) from the row's own m1..m4, by forward substitution with the factor l11..l44."""
    z: list[Column] = []
    for i, x in enumerate(STATS, 1):
        rest = F.col(x) - F.col(f"m{i}")
        for j in range(1, i):
            rest = rest - F.col(f"l{i}{j}") * z[j - 1]
        z.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in z[1:]), z[0] * z[0])


_KEYS = ("g", "start", "n")
_MEANS = tuple(f"m{i}" for i in range(1, 5))
_PAIRS = tuple((i, j) for i in range(1, 5) for j in range(1, i + 1))


def _with_factor(params: DataFrame, scale: float = 1.0) -> DataFrame:
    """The Cholesky factor l11..l44 of scale * covariance (c11..c44), whose variances are at least the floors, and the
    logarithm of its determinant."""
    out = params
    for i, j in _PAIRS:
        value = F.col(f"c{i}{j}") * scale
        if i == j:
            value = F.greatest(value, F.lit(FLOORS[i - 1] ** 2))
        for k in range(1, j):
            value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(value, F.lit(1e-6))) if i == j else value / F.col(f"l{j}{j}"))
    size = 2 * (F.log("l11") + F.log("l22") + F.log("l33") + F.log("l44"))
    return out.select(*_KEYS, *_MEANS, *[f"l{i}{j}" for i, j in _PAIRS], size.alias("size"))


def _bin(d: Column) -> Column:
    return F.floor(F.log(d + 1e-3) * _FINE)


def _starts(vectors: DataFrame) -> DataFrame:
    """Three estimates of each group to start from: medians with absolute deviations; means with covariances; and medians
    with the covariances of directions (vectors of length one from the median), which far vectors can't bend."""
    centre = vectors.groupBy("g").agg(F.count("*").alias("n"), *[F.percentile_approx(x, 0.5, 2000).alias(m) for m, x in zip(_MEANS, STATS)])
    centre = staged(centre, "mcd")
    cov = lambda x: [F.covar_pop(x[i - 1], x[j - 1]).alias(f"c{i}{j}") for i, j in _PAIRS]
    spread = vectors.join(centre, "g").groupBy("g", "n", *_MEANS).agg(
        *[F.percentile_approx(F.abs(F.col(x) - F.col(m)), 0.5, 2000).alias(f"s{i}") for i, (m, x) in enumerate(zip(_MEANS, STATS), 1)],
        *[F.avg(x).alias(f"a{i}") for i, x in enumerate(STATS, 1)], *cov(STATS),
    )
    spread = staged(spread.withColumns({f"s{i}": F.greatest(1.4826 * F.col(f"s{i}"), F.lit(FLOORS[i - 1])) for i in range(1, 5)}), "mcd")
    z = [((F.col(x) - F.col(m)) / F.col(f"s{i}")).alias(f"z{i}") for i, (m, x) in enumerate(zip(_MEANS, STATS), 1)]
    scales = [f"s{i}" for i in range(1, 5)]
    ways = vectors.join(spread.select("g", "n", *_MEANS, *scales), "g").select("g", "n", *_MEANS, *scales, *z)
    far = F.greatest(F.sqrt(sum((F.col(f"z{i}") ** 2 for i in range(2, 5)), F.col("z1") ** 2)), F.lit(1e-9))
    turned = [F.avg(F.col(f"z{i}") * F.col(f"z{j}") / (far * far)).alias(f"u{i}{j}") for i, j in _PAIRS]
    ways = ways.groupBy("g", "n", *_MEANS, *scales).agg(*turned)
    start = lambda df, k, means, c: df.select("g", F.lit(k).alias("start"), "n", *means, *[c(i, j).alias(f"c{i}{j}") for i, j in _PAIRS])
    first = start(spread, 0, _MEANS, lambda i, j: F.col(f"s{i}") ** 2 if i == j else F.lit(0.0))
    second = start(spread, 1, [F.col(f"a{i}").alias(m) for i, m in enumerate(_MEANS, 1)], lambda i, j: F.col(f"c{i}{j}"))
    third = start(ways, 2, _MEANS, lambda i, j: 4 * F.col(f"s{i}") * F.col(f"s{j}") * F.col(f"u{i}{j}"))
    out = staged(_with_factor(first.unionByName(second).unionByName(third)), "mcd")
    release(centre, spread)
    return out


def _concentrate(vectors: DataFrame, params: DataFrame) -> DataFrame:
    """One concentration step: mean and covariance of the 75 % of a group's vectors that are nearest under ``params``."""
    near = vectors.join(params, "g").select(*_KEYS, *STATS, _bin(_distance()).alias("bin"))
    counts = near.groupBy(*_KEYS, "bin").agg(F.count("*").alias("k"))
    so_far = F.sum("k").over(Window.partitionBy("g", "start").orderBy("bin"))
    edge = counts.withColumn("so_far", so_far).filter(F.col("so_far") >= F.ceil(F.col("n") * SHARE)).groupBy("g", "start").agg(F.min("bin").alias("edge"))
    edge = staged(edge, "mcd")
    core = near.join(edge, ["g", "start"]).filter("bin <= edge")
    means = [F.avg(x).alias(m) for m, x in zip(_MEANS, STATS)]
    cov = [F.covar_pop(STATS[i - 1], STATS[j - 1]).alias(f"c{i}{j}") for i, j in _PAIRS]
    out = staged(_with_factor(core.groupBy(*_KEYS).agg(*means, *cov), CONSISTENCY), "mcd")
    release(edge, params)
    return out


def robust_estimates(vectors: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimates of each group ``g``: rows (g, n, m1..m4, l11..l44).

    Three starts (``_starts``) take two concentration steps each. Of a group the one with the least determinant goes on
    until no determinant changes by more than one in ten thousand, 20 steps at most; of equal ones the first stays.

    A step's share of 75 % is found from counts of distances in narrow bins; all counts and sums are combined before they
    are shuffled, so a group may hold most of the rows. What is joined to vectors is a written table of at most three rows
    a group; one number of each step reaches the driver.
    """
    params = _starts(vectors)
    for _ in range(TRIED):
        params = _concentrate(vectors, params)
    best = params.groupBy("g").agg(F.min(F.struct("size", "start")).alias("best")).select("g", F.col("best.start").alias("start"))
    tried, params = params, staged(params.join(best, ["g", "start"]).select(*params.columns), "mcd")
    release(tried)
    for _ in range(MOST_STEPS - TRIED):
        sizes = staged(params.select("g", F.col("size").alias("before")), "mcd")
        params = _concentrate(vectors, params)
        moved = params.join(sizes, "g").agg(F.max(F.abs(F.col("size") - F.col("before")))).first()[0]
        release(sizes)
        if moved is None or moved < 1e-4:
            break
    return params.drop("start", "size")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cut: float = CUT) -> DataFrame:
    """Statistics and verdict of each whole text: identifier, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, ``distance`` (squared; null where base_failed) and kept.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated three-word windows. The others' vectors
    (logarithms of mean word length, symbols for 100 characters, repeated words in 100, repeated lines in 100) are compared
    with the robust estimate of their language and source and kept up to the squared distance ``cut``. Four means and ten
    covariances can't be estimated from a few texts: groups of fewer than 30 texts that pass the base are estimated
    together, and kept if those are fewer than 30 in all.

    Null text has no words and fails the base; null language and source are values of their own; repeated rows count each;
    a null identifier stays null; an empty table gives an empty result. Other columns are ignored. The statistics are
    written once; estimates are joined to them as one row a group, which the runtime broadcasts only below its size limit.
    """
    label = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    group = F.concat_ws("\n", label(lang_col), label(source_col)).alias("own")
    stats = staged(text_statistics(docs, id_col, text_col, group), "statistics")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    vector = [
        F.log(F.col("word_chars") / F.col("n_words")), F.log1p(100 * F.col("n_symbols") / F.col("word_chars")),
        F.log1p(100 * F.col("n_repeat_words") / F.col("n_words")), F.log1p(100 * F.col("n_dup_lines") / F.col("n_lines")),
    ]
    usable = stats.filter(~failed)
    large = usable.groupBy("own").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_GROUP).select("own", F.lit(True).alias("large"))
    large = staged(large, "groups")
    marked = stats.join(large, "own", "left").withColumn("g", F.when(F.col("large"), F.col("own")).otherwise(F.lit("pooled"))).withColumn("base_failed", failed)
    marked = staged(marked.select("*", *[F.when(~failed, v).alias(x) for x, v in zip(STATS, vector)]).drop("own", "large"), "vectors")
    params = robust_estimates(marked.filter("not base_failed").select("g", *STATS))
    judged = marked.join(params.withColumnRenamed("n", "group_n"), "g", "left")
    d = F.when(~F.col("base_failed"), _distance())
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce((F.col("group_n") < LEAST_GROUP) | (d <= cut), F.lit(True)))
    return judged.select(
        unident("nid").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", d.alias("distance"), kept.alias("kept")
    )


def op6_quality_outliers(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_rules(docs).drop("distance")

"""Source divergence audit: how far the word use of each source of a language lies from the other sources and from the language."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

LEAST_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
_HELD = 200_000  # counts that a task holds before it hands them on
_CELLS = 250_000  # cells (source, term) of a block of terms that is compared in one task
#: Letters and all bytes of other scripts stay, A-Z lower-cased; every other byte is a blank.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_ROWS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def terms(text: bytes) -> Counter:
    """How often each term occurs in a text of UTF-8 bytes."""
    return Counter(text.translate(_TABLE).split())


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, text) to sparse counts (lang, source, term, uses, documents), one '' for each group that occurs.

    Counts of many documents are added up before they leave the task, at most ``_HELD`` and those of one more document at
    a time.
    """
    uses: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in docs.items():
            words = list(counts)
            for at in range(0, len(words), 50_000):
                part = words[at : at + 50_000]
                columns = [pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string())]
                own = uses[lang, source]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([own[w] for w in part], pa.int64()), pa.array([counts[w] for w in part], pa.int64())], schema=_ROWS)
        uses.clear()
        docs.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
            found = terms(text.as_py())
            own = docs[lang, source]
            before = len(own)
            own[b""] += 1
            own.update(found.keys())
            uses[lang, source].update(found)
            held += len(own) - before
            if held > _HELD:
                yield from flush()
                held = 0
    yield from flush()


def _share(n: Column | str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)) in exact arithmetic; null where nothing is kept."""
    return F.expr(f"1 + (cast({n} + 2 as decimal(20,0)) * cast({SCALE} as decimal(10,0))) div nullif({total} + 2 * {kept}, 0)")


def _distance(p: Column, q: Column) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _block_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums over the terms of one block for all pairs of a language's sources. A row without a term is a source's share of a term that it lacks."""
    heads = pdf[pdf["term"].isna()].sort_values("source", kind="stable")
    names = heads["source"].to_numpy()
    cells = pdf[pdf["term"].notna()]
    term, words = pd.factorize(cells["term"])
    p = np.repeat(heads["p"].to_numpy(np.int64)[:, None], len(words), 1)
    p[pd.Index(names).get_indexer(cells["source"]), term] = cells["p"].to_numpy(np.int64)
    left, right, value = [], [], []
    for i in range(len(names) - 1):
        d = p[i + 1 :] - p[i]
        value.append((d * d // np.maximum(p[i + 1 :] + p[i], 1)).sum(1))
        left.append(np.full(len(d), names[i], object))
        right.append(names[i + 1 :])
    out = [np.concatenate(x) if x else [] for x in (left, right, value)]
    return pd.DataFrame({"lang": pdf["lang"].iloc[0], "a": out[0], "b": out[1], "value": np.asarray(out[2], np.int64)})


def divergence(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) that say how each (lang, source) group differs.

    Terms are runs of letters and of characters beyond ASCII, A-Z lower-cased; one pass of ``bytes.translate`` blanks all
    else, ``bytes.split`` cuts, and a Counter for each document gives uses and documents. A language keeps the terms of at
    least ``least_docs`` of its documents. A group's share of a term is 1 + floor(10^9 (n + 2) / (N + 2 V)); the distance of two
    shares is floor((p - q)^2 / (p + q)). Part ``pair`` has the sum of distances to each other source of the language, part
    ``term`` the ``top`` terms that the group uses more than its language does. Ranks go from 1 by value descending, then
    by item in UTF-8 order. All arithmetic is exact.

    Null text, lang and source are empty strings. Each row is a document, repeated ones too; the identifier isn't used. A
    group without terms has its pairs; a language of one source has none; a language that keeps no term has pairs of value
    0. An empty table gives an empty result. Other columns are ignored, whatever their names.

    Counts are added up in the task before they are shuffled, so a source with a third of all rows sends its vocabulary
    once a task. A language's terms are dealt to blocks of about ``_CELLS`` cells (source, term); a block's sources are
    compared as rows of a matrix, which gives one sum a pair and block. So there is no row for each pair and term, and
    a task holds one block.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    counted = rows.mapInArrow(_count_rows, "lang string, source string, term string, n long, docs long")
    cells = staged(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    used = cells.filter("term <> ''")
    kept = staged(used.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least_docs).drop("docs"), "kept")
    held = staged(used.drop("docs").join(kept, ["lang", "term"]), "held")
    groups = cells.filter("term = ''").select("lang", "source")
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    per_lang = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_total"))
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = (
        groups.join(sums, ["lang", "source"], "left").join(sources.join(per_lang, "lang", "left"), "lang")
        .fillna(0, ["group_total", "kept", "lang_total"])
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("kept") * F.col("sources") / _CELLS)).cast("int"))
    )
    groups = staged(groups, "groups")

    shares = held.join(groups, ["lang", "source"]).withColumn("p", _share("n", "group_total", "kept")).withColumn("q", _share("total", "lang_total", "kept"))
    by_value = lambda: F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    over = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _distance("p", "q").alias("value"))
    over = over.withColumn("rank", by_value()).filter(F.col("rank") <= top)

    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    cell = shares.filter("sources > 1").select("lang", block.alias("block"), "source", "term", "p")
    head = groups.filter("sources > 1").select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source", F.lit(None).cast("string").alias("term"),
        F.coalesce(_share("0", "group_total", "kept"), F.lit(0)).alias("p"),
    )
    sums = cell.unionByName(head).groupBy("lang", "block").applyInPandas(_block_pairs, "lang string, a string, b string, value long")
    sums = staged(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pairs")
    way = lambda a, b: sums.select("lang", F.col(a).alias("source"), F.lit("pair").alias("part"), F.col(b).alias("item"), "value")
    pairs = way("a", "b").unionByName(way("b", "a")).withColumn("rank", by_value())
    return pairs.unionByName(over)


def op12_divergence(spark, sf_dir):
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
w AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
l AS (SELECT lang, count(*) AS v, sum(total)::HUGEINT AS lang_total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (s.total + 2 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.total + 2)) // (l.lang_total + 2 * l.v) AS q
  FROM s JOIN k USING (lang) JOIN l USING (lang)
  LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

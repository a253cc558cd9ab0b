"""Line dedup: lines that many documents hold stay in one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, ident, staged, unident


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """Drop repeated lines: explode normalised lines, hash, count distinct documents for each hash, drop, reassemble.

    A line's key is the line stripped of white space at both ends, with A-Z lower-cased. A key of at least
    ``min_chars`` code points that at least ``min_docs`` documents hold loses all its lines, but for those in the
    document with the largest identifier.

    Returns for each row of ``docs``: the identifier, ``n_lines``, ``n_dropped``, ``kept`` (the text left), and the columns
    named in ``carry``.

    Null or empty text is one empty line. Rows that share an identifier count as one document and are each returned;
    a null identifier is a document of its own, below all others. An empty table gives an empty result. Other columns
    of ``docs`` are ignored, whatever their names. Keys are compared by two 64-bit hashes.

    Both counts are combined before they are shuffled, the second after the pairs of key and document are distinct, so
    a line of a third of all documents is one row for each task. Keys and positions are written once, as hashes. The hot keys
    are written as a table, one row a key, so that the runtime can split the large partitions of the lines that are joined to
    them.
    """
    rows = docs.select(ident(id_col).alias("nid"), F.coalesce(F.col(text_col), F.lit("")).alias("body"), F.struct(*carry).alias("carried") if carry else F.lit(None).alias("carried"))
    rows = rows.select("nid", "carried", F.xxhash64("body").alias("h"), F.split("body", "\n", -1).alias("lines"))
    key = ascii_lower(F.btrim(F.col("line"), F.lit(SPACE)))
    keyed = (
        rows.select("nid", "h", F.posexplode("lines").alias("pos", "line"))
        .filter(F.length("line") >= min_chars)
        .select("nid", "h", "pos", key.alias("key"))
        .filter(F.length("key") >= min_chars)
        .select("nid", "h", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit("line"), "key").alias("k2"))
    )
    keyed = staged(keyed, "keys")  # hashes only; texts are split once for them
    common = (
        keyed.select("k1", "k2", "nid").distinct()
        .groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("nid").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs).select("k1", "k2", "keeper")
    )
    common = staged(common, "lines")
    drops = (
        keyed.join(common, ["k1", "k2"]).filter(F.col("nid") != F.col("keeper"))
        .groupBy("nid", "h").agg(F.array_sort(F.collect_set("pos")).alias("drops"))
    )
    joined = rows.join(drops, ["nid", "h"], "left")
    # Runs of kept lines lie between neighbouring dropped positions, so each line is copied once.
    before = F.concat(F.array(F.lit(-1)), F.col("drops"))
    after = F.concat(F.col("drops"), F.array(F.size("lines")))
    runs = F.zip_with(before, after, lambda a, b: F.slice(F.col("lines"), a + 2, b - a - 1))
    kept = F.when(F.col("drops").isNull(), F.col("lines")).otherwise(F.flatten(runs))
    return joined.select(
        unident("nid").alias(id_col), F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"), F.array_join(kept, "\n").alias("kept"),
        *[F.col("carried")[c].alias(c) for c in carry],
    )


def op4_line_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
c AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT k.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE c.key IS NOT NULL AND k.doc_id <> c.keeper) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos)
              FILTER (WHERE c.key IS NULL OR k.doc_id = c.keeper), '')) AS kept_sha256
FROM k LEFT JOIN c ON k.key = c.key
GROUP BY k.doc_id
"""

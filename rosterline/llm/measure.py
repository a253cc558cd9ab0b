"""Figures of operators that SQL can't check: python -m rosterline.llm.measure FOLDER, with the tables of one scale in FOLDER.

It compares with brute force on the driver, so it is for small tables only.
"""

from __future__ import annotations

import sys
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ident, staged
from .language import held_out, identify, train
from .near import SIMILARITY, near_duplicates, shingles, word_hashes
from .personal import _learned, _spans, candidates
from .quality import quality_rules
from .suffixes import suffix_dedup


def near_recall(docs: DataFrame) -> dict:
    """All pairs of different texts whose labelled five-word shingles have a Jaccard similarity of 0.8 or more, by an index of
    all shingles, and how many of them have one class; and classes with members that have no such pair."""
    rows = docs.select("doc_id", word_hashes(F.col("text")).alias("w")).collect()
    classes = {r["doc_id"]: r["class_id"] for r in near_duplicates(docs).collect()}
    texts: dict[tuple, int] = {}
    for r in rows:
        texts.setdefault(tuple(r["w"]), r["doc_id"])
    sets = {i: set(shingles(np.array(w, np.int64)).tolist()) for w, i in texts.items()}
    held = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            held[x].append(i)
    pairs = joined = 0
    linked = set()
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in held[x] if j < i).items():
            if n >= SIMILARITY * (len(s) + len(sets[j]) - n):
                pairs += 1
                joined += classes[i] == classes[j]
                linked |= {i, j}
    sizes = Counter(classes[i] for i in sets)
    return {"pairs": pairs, "joined": joined, "texts in classes without such a pair": sum(sizes[classes[i]] > 1 and i not in linked for i in sets)}


def language_accuracy(docs: DataFrame, samples: tuple[int, ...] = (1000, 2000, 3000)) -> dict:
    """Share of held-out documents with their language, by size of the sample."""
    out = {}
    for sample in samples:
        found = identify(docs, train(docs, sample=sample)).filter(held_out("doc_id")).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
        out[sample] = tuple(found.agg(F.count("*"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first())
    return out


def added_personal(docs: DataFrame) -> dict:
    """Candidates, base spans, added spans, and (held-back positives, precision, recall) of the trees, by kind."""
    rows = docs.select(ident("doc_id").alias("nid"), F.coalesce("text", F.lit("")).alias("body")).withColumn("h", F.xxhash64("body"))
    found = staged(candidates(rows), "candidates")
    base, chosen, report = _learned(found, 0.9)
    count = lambda df: {r[0]: r[1] for r in df.groupBy("kind").count().collect()}
    return {"candidates": count(found.filter("not base")), "base": count(base), "added": count(_spans(base.unionByName(chosen)).filter("not base")), "held back": report}


def otherwise_written(docs: DataFrame) -> DataFrame:
    """docs, a quarter of them with '(at)' and '(dot)', ', ' between the numbers of an ip and phones without '+'."""
    text = F.regexp_replace("text", r"([A-Za-z0-9_%+-]+)@([A-Za-z0-9-]+)\.([a-z]+)", "$1 (at) $2 (dot) $3")
    text = F.regexp_replace(text, r"(?<![0-9.])([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})(?![0-9.])", "$1, $2, $3, $4")
    some = F.pmod(F.xxhash64(F.lit("written"), "doc_id"), F.lit(4)) == 0
    return docs.withColumn("text", F.when(some, F.regexp_replace(text, r"\+([0-9])", "$1")).otherwise(F.col("text")))


def outliers(docs: DataFrame) -> dict:
    return quality_rules(docs).agg(F.count("*").alias("texts"), F.count_if("base_failed").alias("base failed"), F.count_if(~F.col("base_failed") & ~F.col("kept")).alias("outliers")).first().asDict()


def passages(docs: DataFrame) -> dict:
    """Texts that lose bytes, that hold a passage of over 50 words which occurs elsewhere, and that hold one but lose no byte."""
    found = suffix_dedup(docs, passage_words=51)
    long, lost = F.col("n_passages") > 0, F.col("n_removed") > 0
    return found.agg(F.count("*").alias("texts"), F.count_if(lost).alias("lose bytes"), F.count_if(long).alias("hold a passage"), F.count_if(long & ~lost).alias("hold one and lose none")).first().asDict()


def main(folder: str) -> None:
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    print("near duplicates", near_recall(docs))
    print("passages", passages(docs))
    print("language", language_accuracy(docs))
    print("personal data", added_personal(docs))
    print("personal data, otherwise written", added_personal(otherwise_written(docs)))
    print("outliers", outliers(docs))


if __name__ == "__main__":
    main(sys.argv[1])

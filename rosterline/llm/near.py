"""Near-duplicate documents: order min-hash candidates, verified by banded alignment."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NULL_ID, SPACE, ident, release, staged
from .components import components

SHINGLE = 5  # words
SIMILARITY = 0.8
SKETCHES = 16
PICKS = 3  # least shingles of a sketch; two long texts of similarity 0.8 agree in about half of the sketches, all 16 fail in 1 of 60,000
SHORT = 15  # texts of at most so many shingles, of which sketches would miss more, get exact buckets as well
BLOCK = 2000  # texts compared in one task
BLOCK_WORDS = 1000  # times the texts of a block: words compared in one task
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
_SEEDS = (np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) ^ np.uint64(0x94D049BB133111EB)


def word_hashes(text: Column) -> Column:
    """Hashes of a text's words in order, lower-cased and without marks at their ends."""
    plain = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(SPACE))
    plain = F.regexp_replace(plain, r"(?<=\w)[\p{Punct}]+(?=[\x20\x09-\x0D]|$)", "")
    parts = F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, r"[\x20\x09-\x0D]+", -1))
    return F.transform(parts, lambda w: F.hash(w))


def shingles(words: np.ndarray) -> np.ndarray:
    """A hash of each run of five words, labelled with how often it occurred before, so that no two are equal.

    A text of fewer words is one shingle; a text without words has none.
    """
    if not len(words):
        return np.zeros(0, np.uint64)
    w = words.astype(np.int64).view(np.uint64)
    k = min(SHINGLE, len(w))
    m, h = len(w) - k + 1, np.full(len(w) - k + 1, np.uint64(k))
    for i in range(k):
        h = (h ^ w[i : i + m]) * _MIX
        h ^= h >> np.uint64(31)
    order = np.argsort(h, kind="stable")
    same = np.concatenate([[False], h[order][1:] == h[order][:-1]])
    if same.any():
        at = np.arange(m)
        nth = np.empty(m, np.uint64)
        nth[order] = (at - np.maximum.accumulate(np.where(same, 0, at))).astype(np.uint64)
        h = (h + nth * _MIX2) * _MIX
        h ^= h >> np.uint64(29)
    return h


def order_sketches(h: np.ndarray) -> np.ndarray:
    """For each seed the least labelled shingles, hashed together in the order in which the text has them."""
    if not len(h):
        return np.zeros(SKETCHES, np.int64)
    x = (h[None, :] ^ _SEEDS[:, None]) * _MIX
    x ^= x >> np.uint64(32)
    x *= _MIX2
    picks = min(PICKS, len(h))
    at = np.argpartition(x, picks - 1, 1)[:, :picks] if len(h) > picks else np.tile(np.arange(len(h)), (SKETCHES, 1))
    at.sort(1)
    out = _SEEDS.copy()
    for i in range(picks):
        out = (out ^ h[at[:, i]]) * _MIX
        out ^= out >> np.uint64(30)
    return out.view(np.int64)


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> float:
    """Similarity of two texts' labelled shingles: the most that can be matched in order, over those of either text.

    Only matches inside the band count that a similarity of ``threshold`` leaves: a match moved further than the number of
    shingles that may stay unmatched can't be part of such an alignment. Each labelled shingle occurs once in a text, so
    the alignment is a longest rising run of matched places.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return 0.0
    order = np.argsort(b)
    at = np.minimum(np.searchsorted(b, a, sorter=order), len(b) - 1)
    place = order[at]
    hit = b[place] == a
    n = len(a) + len(b)
    if hit.sum() < threshold / (1 + threshold) * n - 1e-9:
        return 0.0
    band = n * (1 - threshold) / (1 + threshold)
    i = np.flatnonzero(hit)
    places = place[i][np.abs(place[i] - i) <= band]
    if not (np.diff(places) < 0).any():
        matched = len(places)
    else:
        tails: list[int] = []
        for p in places.tolist():
            k = bisect_left(tails, p)
            tails[k : k + 1] = [p]
        matched = len(tails)
    return matched / (n - matched)


def prefix(h: np.ndarray, threshold: float = SIMILARITY) -> np.ndarray:
    """The least shingles of a text in one order for all texts: similar texts share one of them, whatever their sizes."""
    n = len(h) - int(np.ceil(threshold * len(h) - 1e-9)) + 1
    x = (h ^ _MIX) * _MIX2
    x ^= x >> np.uint64(29)
    return np.sort(x)[:n].view(np.int64) if len(h) else np.zeros(0, np.int64)


def buckets_of(words: np.ndarray) -> np.ndarray:
    """The sketches of a text, and for a short one the shingles of its prefix; none for a text without words."""
    h = shingles(words)
    if not len(h):
        return np.zeros(0, np.int64)
    out = order_sketches(h)
    return np.concatenate([out, prefix(h)]) if len(h) <= SHORT / SIMILARITY else out


_SKETCH = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("words", pa.list_(pa.int32())), ("buckets", pa.list_(pa.int64()))])


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(4)
        flat, ends = words.flatten().to_numpy(zero_copy_only=False), np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))
        out = [buckets_of(flat[a:b]) for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist())]
        if out:
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
            plain = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], plain, pa.ListArray.from_arrays(offsets, np.concatenate(out))], schema=_SKETCH)


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each block's members to its hub: rows (hub, part, member, vid, words) by block, the hub itself first."""
    block, head = None, np.zeros(0, np.uint64)
    for batch in batches:
        hub, part, member, vid = (batch.column(k).to_pylist() for k in range(4))
        links = []
        for i, words in enumerate(batch.column(4)):
            h = shingles(words.values.to_numpy())
            if not member[i]:
                block, head = (hub[i], part[i]), h
            elif (hub[i], part[i]) == block and aligned(h, head) >= SIMILARITY:
                links.append((max(hub[i], vid[i]), min(hub[i], vid[i])))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], schema=_LINKS)


_TOKENS = pa.schema([("vid", pa.int64()), ("token", pa.int64())])


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (vid, words) to one row for each labelled shingle."""
    for batch in batches:
        for vid, words in zip(batch.column(0).to_pylist(), batch.column(1)):
            h = shingles(words.values.to_numpy()).view(np.int64)
            for at in range(0, len(h), 50_000):
                part = h[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), vid, np.int64)), pa.array(part)], schema=_TOKENS)


def _solve(rows: list[tuple]) -> list[tuple[int, int]]:
    """Links that join the labels of one block's texts: rows (vid, label, words). Pairs within a label are not looked at.

    For each text the labelled shingles that it shares with all others are counted at once, by an index of the block; the
    few that can reach the threshold are aligned.
    """
    above: dict[int, int] = {}

    def find(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    rows = sorted({r[0]: r for r in rows}.values(), key=lambda r: r[0])
    if len({r[1] for r in rows}) < 2:
        return []
    sets = [shingles(np.asarray(r[2], np.int64)) for r in rows]
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    common, links = Counter(r[1] for r in rows).most_common(1)[0][0], []
    for i, row in enumerate(rows):
        if row[1] == common or not sizes[i]:  # another text of the pair looks at it
            continue
        lo, hi = np.searchsorted(flat, sets[i], "left"), np.searchsorted(flat, sets[i], "right")
        runs = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + np.arange(runs.sum())
        shared = np.bincount(owner[at], minlength=len(rows))
        for j in np.flatnonzero(shared >= SIMILARITY / (1 + SIMILARITY) * (sizes + sizes[i]) - 1e-9).tolist():
            if j != i and find(row[1]) != find(rows[j][1]) and aligned(sets[i], sets[j]) >= SIMILARITY:
                above[find(row[1])] = find(rows[j][1])
                links.append((row[0], rows[j][0]))
    return links


def _solve_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, x, y, vid, label, words) sorted by block (key, x, y); a block may go on in the next batch."""
    block, rows, out = None, [], []
    for batch in batches:
        key, x, y, vid, label = (batch.column(k).to_pylist() for k in range(5))
        for i, words in enumerate(batch.column(5)):
            if (key[i], x[i], y[i]) != block:
                out += _solve(rows)
                block, rows = (key[i], x[i], y[i]), []
            rows.append((vid[i], label[i], words.values.to_numpy()))
        if len(out) > 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_LINKS)
            out = []
    out += _solve(rows)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_LINKS)


def _by_rare_shingles(big: DataFrame, words: DataFrame) -> DataFrame:
    """Large buckets (key, vid, label, size) dealt anew: rows of the same columns, grouped by shingles that are rare in the bucket.

    A text is placed by the rarest of its shingles, as many as a text that is similar to it can't all lack. So no link of
    the bucket is lost, and what most of the bucket shares, such as a common passage, brings no texts together.
    """
    tokens = big.select("vid").distinct().join(words, "vid").mapInArrow(_shingle_rows, "vid long, token long")
    spread = big.join(tokens, "vid")
    often = staged(spread.groupBy("key", "token").agg(F.count("*").alias("n")), "shingles")
    by_text = Window.partitionBy("key", "vid")
    ranked = spread.join(often, ["key", "token"]).withColumn("rank", F.row_number().over(by_text.orderBy("n", "token"))).withColumn("of", F.count("*").over(by_text))
    placed = ranked.filter((F.col("rank") <= F.col("of") - F.ceil(F.col("of") * SIMILARITY - 1e-9) + 1) & (F.col("n") > 1))
    return placed.select(F.xxhash64("key", "token").alias("key"), "vid", "label", "size")


def _classes(docs: DataFrame, id_col: str, text_col: str, block: int) -> DataFrame:
    """One row for each of ``docs``: id, h (hash of the raw text), class, class_id, class_size, n_copies."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    hashed = rows.select("id", F.xxhash64("body").alias("h"), word_hashes(F.col("body")).alias("words"))
    sketched = hashed.select("id", "h", F.xxhash64("words").alias("s1"), F.xxhash64(F.lit("words"), "words").alias("s2"), "words")
    texts = staged(sketched.mapInArrow(_sketch_rows, "id long, h long, s1 long, s2 long, words array<int>, buckets array<long>"), "sketches")

    # A node is a text; the least identifier that has it names it, or its hash if there is none or if others have that one too.
    found = texts.groupBy("s1", "s2").agg(F.min("id").alias("least"), F.count("*").alias("n_copies"), F.first(F.size("words")).alias("size"), F.first("buckets").alias("buckets"))
    found = staged(found, "texts")
    shared_ids = staged(found.filter("least is not null").groupBy("least").count().filter("count > 1").select("least", F.lit(True).alias("shared")), "shared_ids")
    nodes = found.join(shared_ids, "least", "left").withColumn("vid", F.when(F.col("least").isNull() | F.col("shared"), F.col("s1").bitwiseOR(F.lit(NULL_ID))).otherwise(F.col("least")))

    placed = nodes.select("vid", "size", F.explode("buckets").alias("key"))
    shared = staged(placed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    placed = staged(placed.join(shared.hint("merge"), "key"), "placed")
    degree = placed.groupBy("vid").agg(F.sum("n").alias("degree"))
    busy = staged(nodes.join(degree, "vid").select("s1", "s2", ident("least").alias("nid"), "vid", "degree"), "busy")
    # Only texts that share a bucket are compared; copies of them under other identifiers drop out in the join.
    words = texts.withColumn("nid", ident("id")).join(busy.hint("merge"), ["s1", "s2", "nid"]).select("vid", "words").dropDuplicates(["vid"])
    words = staged(words, "words")

    hubs = placed.join(busy.select("vid", "degree"), "vid").groupBy("key").agg(F.max(F.struct("degree", F.negative("vid").alias("v"))).alias("top"))
    hubs = staged(hubs.select("key", F.negative("top.v").alias("hub")), "hubs")
    pairs = placed.join(hubs, "key").filter("vid <> hub").select("hub", "vid", F.greatest("hub", "vid").alias("a"), F.least("hub", "vid").alias("b")).dropDuplicates(["a", "b"])
    pairs = staged(pairs.select("hub", "vid"), "pairs")
    parts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    heads = parts.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("member"), F.col("hub").alias("vid"))
    members = pairs.join(parts, "hub").select("hub", F.pmod(F.xxhash64("vid"), F.col("parts")).cast("int").alias("part"), F.lit(True).alias("member"), "vid")
    faced = heads.unionByName(members).hint("merge").join(words, "vid").select("hub", "part", "member", "vid", "words")
    links = staged(faced.repartition("hub", "part").sortWithinPartitions("hub", "part", "member").mapInArrow(_verify, "a long, b long"), "verified")
    release(pairs, hubs, shared)

    labels = components(links)
    labelled = placed.filter("n > 2").join(labels.withColumnRenamed("node", "vid"), "vid", "left").select("key", "vid", "n", "size", F.coalesce("root", "vid").alias("label"))
    mixed = staged(labelled.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("m")).filter("l <> m").select("key"), "mixed")
    still = staged(labelled.join(mixed, "key"), "open")  # of two texts in a bucket, the pair was looked at
    groups = still.filter(F.col("n") <= block).select("key", "vid", "label", "size")
    groups = staged(groups.unionByName(_by_rare_shingles(still.filter(F.col("n") > block).select("key", "vid", "label", "size"), words)), "groups")
    member = F.xxhash64("vid")
    open_ = (
        groups.groupBy("key").agg(
            F.min("label").alias("l"), F.max("label").alias("m"), F.sum(member.cast("decimal(20,0)")).alias("sum"), F.bit_xor(member).alias("xor"), F.count("*").alias("n"), F.sum("size").alias("total"),
        )
        .filter("l <> m").groupBy("sum", "xor", "n", "total").agg(F.min("key").alias("key"))  # groups of the same texts are one
        .select("key", F.ceil(F.greatest(F.col("n") / block, F.col("total") / (block * BLOCK_WORDS))).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64(F.lit("block"), "vid"), F.col("blocks")).cast("int")
    dealt = (
        groups.join(open_, "key").select("key", "vid", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "vid", "label")
    )
    more = (
        dealt.hint("merge").join(words, "vid").select("key", "x", "y", "vid", "label", "words").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
        .mapInArrow(_solve_rows, "a long, b long")
    )
    more = staged(more, "verified")
    roots = components(links.unionByName(more))
    release(placed, busy, words, links, labels, mixed, still, groups, more)
    named = nodes.select("s1", "s2", "vid", "least", "n_copies").join(roots.withColumnRenamed("node", "vid"), "vid", "left")
    named = named.select("s1", "s2", "least", "vid", "n_copies", F.coalesce("root", "vid").alias("class"))
    whole = named.groupBy("class").agg(F.sum("n_copies").alias("class_size"), F.coalesce(F.min("least"), F.min("vid")).alias("class_id"))
    per_text = named.join(whole, "class").select("s1", "s2", "class", "class_id", "class_size", "n_copies")
    return texts.select("id", "h", "s1", "s2").join(per_text, ["s1", "s2"]).drop("s1", "s2")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The class of each document: rows (identifier, ``class_id``, ``class_size``, ``n_copies``).

    Two texts are linked if their shingles of five words align to a similarity of 0.8 or more; classes are the connected
    components. Words are lower-cased and lose marks at their ends. ``class_id`` is the least identifier of a class,
    ``n_copies`` how many documents have the same words.

    Documents with the same words are one text from the start, so no group of copies is ever paired. A text's 16 sketches
    put it in buckets; a text of at most 15 shingles is also placed by its prefix, which finds all of its links. In each
    bucket all texts are first verified against the one that shares most buckets with others, in parts of ``block`` texts;
    texts whose links are thereby known to be joined are not compared again. Buckets that still hold texts of several
    labels are compared whole, by an index of shingles. Those of more than ``block`` texts are first dealt anew by
    shingles that are rare in the bucket, which loses no link; what is still larger is compared in blocks. No bucket is
    cut or capped.

    Words are written once with the sketches. What is compared is joined to them by identifier, and each text goes once to
    each text or bucket that it faces. Both sides of these joins grow with the corpus, so they are sort-merge joins at any
    size. Tables are removed when nothing reads them again.

    Null text counts as empty; documents without words are copies of each other. Texts of fewer than five words are
    linked if equal. Equal similarities need no order: every link joins. Rows that share an identifier are compared by
    their own texts and each returned; repeated rows are copies. Where all identifiers of a class are null, ``class_id``
    is a negative hash. An empty table gives an empty result; other columns are ignored.
    """
    found = _classes(docs, id_col, text_col, block)
    return found.select(F.col("id").alias(id_col), "class_id", "class_size", "n_copies")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the document with the least identifier stays, once.

    Of several rows with that identifier the one with the least hash of its text stays; a row with a null identifier stays
    only if all of its class have none. All columns are returned as they are, whatever their names; an empty table gives
    an empty result.
    """
    found = _classes(docs, id_col, text_col, BLOCK)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), ident("id").alias("nid"), "h")).alias("first")
    leaders = staged(found.groupBy("class").agg(first).select("first.nid", "first.h"), "leaders")
    keyed = docs.select(F.struct("*").alias("row"), ident(id_col).alias("nid"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"))
    return keyed.join(leaders, ["nid", "h"], "left_semi").dropDuplicates(["nid", "h"]).select("row.*")


def op9_near_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs)

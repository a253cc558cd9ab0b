"""SimHash near duplicates: fingerprints of 64 bits, linked at 3 or fewer differing bits by pigeonring filtering."""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ident, release, staged, unident
from .components import components

SHINGLE = 3  # words
SEED = 42
BITS, MOST = 64, 3
SEGMENTS = MOST + 1
WIDTH = BITS // SEGMENTS
BLOCK = 2000  # fingerprints that are compared with one another in one task
_PIECE = 1 << 20  # bytes of a text that are cut into words at a time
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces that end before white space."""
    at = 0
    while len(text) - at > _PIECE:
        blank = _BLANK.search(text, at + _PIECE)
        if blank is None:
            break
        yield text[at : blank.start()]
        at = blank.start()
    yield text[at:] if at else text


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of each run of three words, joined by spaces."""
    line = b" ".join(words)
    ends = list(itertools.accumulate(map(len, words), lambda end, n: end + 1 + n))
    starts = [0, *(end + 1 for end in ends[: -SHINGLE])]
    return np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :])], "<u8")


def fingerprint(text: bytes) -> int:
    """A bit is 1 if it is set in over half of the hashes of all shingles, repeats included; 0 without words.

    A-Z are lower-cased; a text of fewer words than a shingle is one shingle.
    """
    ones, n, last = np.zeros(BITS, np.int64), 0, []
    for piece in _pieces(text):
        words = last + piece.translate(_LOWER).split()
        if len(words) >= SHINGLE:
            h = shingle_hashes(words)
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            n += len(h)
        last = words[-SHINGLE + 1 :]
    if n == 0:
        return xxhash.xxh64_intdigest(b" ".join(last), SEED) if last else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _print_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(text.as_py()) for text in batch.column(1).cast(pa.binary())], "<u8")
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["nid", "print"])


@functools.cache
def chains(length: int) -> np.ndarray:
    """For each start the bits of a chain of so many segments of the ring, as rows of one number."""
    segment = (1 << WIDTH) - 1
    return np.array([sum(segment << WIDTH * ((start + k) % SEGMENTS) for k in range(length)) for start in range(SEGMENTS)], np.uint64)


@functools.cache
def kept_bits(length: int) -> np.ndarray:
    """(start, key): the bits of a chain less so many as its budget; a row for each choice that keeps all shorter budgets.

    The budget of the first k segments is k - 1 differing bits. Two fingerprints whose differences keep the budgets of all
    chains from a start agree on all bits but those, so they agree on some key.
    """
    out = []
    for start in range(SEGMENTS):
        places = [(k, WIDTH * ((start + k) % SEGMENTS) + b) for k in range(1, length) for b in range(WIDTH)]
        own = int(chains(length)[start])
        for left_out in itertools.combinations(places, length - 1):
            if all(sum(k <= upto for k, _ in left_out) <= upto for upto in range(1, length)):
                out.append([start, own - sum(1 << bit for _, bit in left_out)])
    return np.array(out, object)


_PLACED = pa.schema([("start", pa.int32()), ("key", pa.int64()), ("print", pa.int64())])


def _place(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (start, print) to a row for each key of the chain of so many segments from that start. Keys are mixed; what
    shares one by chance is compared in vain."""
    table = kept_bits(length)
    by_start = [np.array([bits for s, bits in table if s == start], np.uint64) for start in range(SEGMENTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            for start, bits in enumerate(by_start):
                own = prints[starts == start]
                step = max(1, 200_000 // len(bits))
                for at in range(0, len(own), step):
                    part = own[at : at + step]
                    key = (part[:, None] & bits) * np.uint64(0x9E3779B97F4A7C15)
                    key = (key ^ (key >> np.uint64(32)) ^ np.arange(len(bits), dtype=np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(key.size, start, np.int32)), pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(part, len(bits)).view(np.int64))], schema=_PLACED,
                    )

    return run


def links_of(start: np.ndarray, key: np.ndarray, prints: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Links that join what is linked within each run of equal (start, key), a forest: no more of them than rows.

    All pairs of a run are looked at, those of neighbours first: the chains from the run's start that are longer than its
    key, each within its budget, then the whole difference. The longest chain is the whole difference.
    """
    n, out = len(prints), []
    above = np.arange(n)

    def find(x: int) -> int:
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    at, k = np.arange(n), 0
    while True:
        k += 1
        at = at[at + k < n]
        at = at[(key[at] == key[at + k]) & (start[at] == start[at + k])]
        if not len(at):
            return out
        near = at[above[at] != above[at + k]]
        for chain in range(length, SEGMENTS + 1):
            differ = (prints[near] ^ prints[near + k]) & chains(chain)[start[near]]
            near = near[np.bitwise_count(differ) <= chain - 1]
        for a in near.tolist():
            x, y = find(a), find(a + k)
            if x != y:
                above[max(x, y)] = min(x, y)
                out.append((int(prints[a].view(np.int64)), int(prints[a + k].view(np.int64))))
        if len(near):
            while (above[above] != above).any():
                above = above[above]


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _link_rows(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (start, key, print) in order; a run of one key may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                now, rest = rest, None
            else:
                new = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)
                both = [np.concatenate(x) for x in zip(rest, new)]
                if not len(both[0]):
                    continue
                ended = np.flatnonzero((both[0] != both[0][-1]) | (both[1] != both[1][-1]))
                cut = int(ended[-1]) + 1 if len(ended) else 0
                now, rest = [x[:cut] for x in both], [x[cut:] for x in both]
            found = links_of(*now, length)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=_LINKS)

    return run


def links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) of different fingerprints (column ``print``) that join all that differ in 3 or fewer bits.

    The 64 bits are a ring of four segments. If two fingerprints differ in at most 3 bits, then from some segment on every
    chain of k segments has at most k - 1 differing bits (floor(3 k / 4)): the first none, the first two one, and so on.
    So the first segment is a key. A key that more than ``block`` fingerprints share is dealt anew by longer chains from
    the same segment: on their bits less as many as their budget, each choice a key, two fingerprints within all budgets
    agree for some choice. Nothing is cut: a key of four segments has all but three bits, so at most eight fingerprints
    share it. What shares a key is compared in one task, chain by chain, then in all bits.
    """
    starts = F.explode(F.array(*[F.lit(s) for s in range(SEGMENTS)])).alias("start")
    rows, found = prints.select(starts, "print"), []
    for length in range(1, SEGMENTS + 1):
        placed = staged(rows.mapInArrow(_place(length), "start int, key long, print long"), "placed")
        large = placed.groupBy("start", "key").agg(F.count("*").alias("n")).filter(F.col("n") > block).select("start", "key")
        large = staged(large, "large")
        last = length == SEGMENTS or large.isEmpty()
        small = placed if last else placed.join(large, ["start", "key"], "left_anti")
        sorted_ = small.repartition("start", "key").sortWithinPartitions("start", "key", "print")
        found.append(staged(sorted_.select("start", "key", "print").mapInArrow(_link_rows(length), "a long, b long"), "links"))
        if last:
            release(placed, large)
            break
        rows = staged(placed.join(large, ["start", "key"], "left_semi").select("start", "print").distinct(), "again")
        release(placed, large)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Rows (identifier, ``fingerprint``, ``component_id``) for each document.

    Fingerprints are those of ``fingerprint``, as 16 hexadecimal digits; two documents are linked if theirs differ in 3 or
    fewer bits; ``component_id`` is the least identifier that links reach.

    Null text is empty; texts without words have the fingerprint zero and are linked like any other. Rows that share an
    identifier are each returned with their own fingerprint; a null identifier is never the least, and a component
    without any other has a null ``component_id``. An empty table gives an empty result. Other columns are ignored,
    whatever their names.

    Equal fingerprints are one from the start, so copies are never paired; see ``links`` for the rest. Fingerprints and
    links stay in tables; the join back to documents has one row for each fingerprint on one side, so that a group of a
    third of all documents can be split.
    """
    rows = docs.select(ident(id_col).alias("nid"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    prints = staged(rows.mapInArrow(_print_rows, "nid long, print long"), "prints")
    nodes = staged(prints.groupBy("print").agg(F.min(unident("nid")).alias("least")), "nodes")
    pairs = links(nodes.select("print"), block)
    roots = components(pairs)
    named = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").select("print", "least", F.coalesce("root", "print").alias("class"))
    named = staged(named, "named")
    least = named.groupBy("class").agg(F.min("least").alias("component_id"))
    labels = staged(named.join(least, "class").select("print", "component_id"), "labels")
    release(nodes, roots, named)
    return prints.join(labels, "print").select(unident("nid").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op11_simhash(spark, sf_dir):
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))

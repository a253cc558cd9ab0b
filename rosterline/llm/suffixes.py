"""Suffix-array dedup: bytes of long repeated strings are removed from all texts.

A repeated string of 400 bytes can start anywhere, so every window of 400 bytes has an owner: the gram of 32 bytes in it
with the least hash (the leftmost of equal ones). The owner depends on the window's bytes alone, so equal windows have
equal owners at equal places in them, and only suffixes that start at owners with equal grams have to be compared. Those
suffixes, and the reversed texts before them, are sorted by deep-shallow sorting, bucket by bucket; common prefixes of
neighbours then tell which windows are repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ident, release, staged, unident

GRAM = 32
_STEP = 1 << 19  # windows hashed at a time
_INDEX = np.uint64((1 << 21) - 1)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the gram at each position: a multilinear one over its four 8-byte words, then mixed."""
    n = len(data) - 7
    word = np.empty(n, "<u8")
    for o in range(8):
        part = data[o : o + (len(data) - o) // 8 * 8].view("<u8")
        word[o::8] = part[: len(word[o::8])]
    m = len(data) - GRAM + 1
    h = word[:m] * _ODD[0]
    for k in range(1, 4):
        h += word[8 * k : 8 * k + m] * _ODD[k]
    h ^= h >> np.uint64(32)
    h *= _ODD[4]
    h ^= h >> np.uint64(29)
    return h


def owners(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Owners of all windows of ``length`` bytes inside the texts that lie in ``data`` end to end and end at ``ends``.

    Returns arrays (text, owner's position, first and last window start owned, gram hash), by position.
    """
    sizes = np.diff(ends, prepend=0)
    inside = np.maximum(sizes - length + 1, 0)
    label = np.repeat(np.stack([np.arange(len(sizes)), np.full(len(sizes), -1)], 1).ravel(), np.stack([inside, sizes - inside], 1).ravel())
    grams, out = length - GRAM + 1, []
    for at in range(0, len(data) - length + 1, _STEP):
        n = min(_STEP, len(data) - length + 1 - at)
        if not (label[at : at + n] >= 0).any():
            continue
        h = gram_hashes(np.ascontiguousarray(data[at : at + n + length - 1]))
        key = (h & ~_INDEX) | np.arange(len(h), dtype=np.uint64)
        blocks = -(-len(key) // grams)
        padded = np.full(blocks * grams, np.uint64(2**64 - 1))
        padded[: len(key)] = key
        block = padded.reshape(blocks, grams)
        before = np.minimum.accumulate(block, 1).ravel()
        after = np.minimum.accumulate(block[:, ::-1], 1)[:, ::-1].ravel()
        least = (np.minimum(after[:n], before[grams - 1 : grams - 1 + n]) & _INDEX).astype(np.int64)
        own = label[at : at + n]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(least) != 0) | (np.diff(own) != 0)]))
        last = np.append(first[1:], n) - 1
        keep = own[first] >= 0
        first, last = first[keep], last[keep]
        out.append((own[first], least[first] + at, first + at, last + at, h[least[first]]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    text, pos, first, last, h = (np.concatenate(c) for c in zip(*out))
    # A run of windows that a step's end has cut is joined again.
    new = np.concatenate([[True], (np.diff(pos) != 0) | (np.diff(text) != 0)])
    return text[new], pos[new], first[new], last[np.append(np.flatnonzero(new)[1:], len(new)) - 1], h[new]


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def blind_trie(strings: list[bytes], members: list[int]) -> list[int]:
    """Members in the order of their strings, by a trie whose inner nodes hold only where their strings part.

    A string goes down blindly, by the bytes at the nodes' depths, to some leaf; its common prefix with that leaf's string
    tells where it parts from the trie. Equal strings share a leaf.
    """
    root: list | None = None  # node: [depth, {byte: node}]; leaf: [-1, members]
    byte = lambda s, d: s[d] if d < len(s) else -1
    for m in members:
        s = strings[m]
        if root is None:
            root = [-1, [m]]
            continue
        node = root
        while node[0] >= 0:
            node = node[1].get(byte(s, node[0])) or next(iter(node[1].values()))
        other = strings[node[1][0]]
        depth = common_prefix(s, other)
        if depth == len(s) == len(other):
            node[1].append(m)
            continue
        above, node = None, root
        while 0 <= node[0] < depth:
            above, node = node, node[1][byte(s, node[0])]
        if node[0] == depth:
            node[1][byte(s, depth)] = [-1, [m]]
            continue
        fresh = [depth, {byte(s, depth): [-1, [m]], byte(other, depth): node}]
        if above is None:
            root = fresh
        else:
            above[1][byte(s, above[0])] = fresh
    out, stack = [], [root] if root else []
    while stack:
        node = stack.pop()
        if node[0] < 0:
            out += node[1]
        else:
            stack += [node[1][k] for k in sorted(node[1], reverse=True)]
    return out


def deep_shallow(strings: list[bytes], depth: int = 0, shallow: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings and the common prefix of each with the one before it (0 for the first).

    Multikey quicksort on 8 bytes at a time down to ``shallow``; strings still equal there are ordered by a blind trie.
    All strings agree below ``depth``.
    """
    order: list[int] = []
    todo = [(list(range(len(strings))), depth)]
    while todo:
        members, d = todo.pop()
        if len(members) < 2:
            order += members
        elif d >= shallow:
            order += blind_trie(strings, members)
        else:
            key = {m: strings[m][d : d + 8] for m in members}
            pivot = sorted(key[m] for m in (members[0], members[len(members) // 2], members[-1]))[1]
            same = [m for m in members if key[m] == pivot]
            todo += [([m for m in members if key[m] > pivot], d), (same, d + 8 if len(pivot) == 8 else shallow), ([m for m in members if key[m] < pivot], d)]
    lcp = [0] + [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:])]
    return np.array(order, np.int64), np.array(lcp, np.int64)


def repeated(contexts: list[bytes], lefts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of distinct contexts around equal grams: for each the least and greatest a for which the window that starts a bytes
    before the gram occurs in another context too; (1, 0) if none does. ``lefts`` are the bytes before the gram.
    """
    g = len(contexts)
    low, high = np.full(g, length + 1, np.int64), np.full(g, -1, np.int64)
    after = [c[n:] for c, n in zip(contexts, lefts.tolist())]
    before = [c[:n][::-1] for c, n in zip(contexts, lefts.tolist())]
    order_a, lcp_a = deep_shallow(after, GRAM)
    order_b, lcp_b = deep_shallow(before)
    if g == 2:
        if length - lcp_a[1] <= lcp_b[1]:
            low[:], high[:] = length - lcp_a[1], lcp_b[1]
    else:
        need = length - np.array([len(x) for x in after], np.int64)
        tries = np.unique(np.concatenate([lefts, lcp_b, need, length - lcp_a]))
        class_a, class_b = np.empty(g, np.int64), np.empty(g, np.int64)
        for a in tries[(tries >= 0) & (tries <= length - GRAM)].tolist():
            owner = np.flatnonzero((need <= a) & (a <= lefts))
            if len(owner) < 2:
                continue
            class_a[order_a] = np.cumsum(lcp_a < length - a)
            class_b[order_b] = np.cumsum(lcp_b < a) if a else 0
            code = class_a[owner] * (g + 1) + class_b[owner]
            _, back, count = np.unique(code, return_inverse=True, return_counts=True)
            hit = owner[count[back] > 1]
            low[hit], high[hit] = np.minimum(low[hit], a), np.maximum(high[hit], a)
    none = high < 0
    low[none], high[none] = 1, 0
    return low, high


def _views(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column end to end, and where each value ends."""
    values = batch.column(column)
    offsets = np.frombuffer(values.buffers()[1], np.int32 if pa.types.is_binary(values.type) else np.int64)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = values.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


_OWNERS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("pos", pa.int32()), ("lft", pa.int32()), ("rgt", pa.int32()), ("key", pa.int64()), ("ctx", pa.int64())])
_CONTEXTS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("pos", pa.int32()), ("lft", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), ("body", pa.binary())])
_WINDOWS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("pos", pa.int32()), ("a", pa.int32()), ("n", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64())])
_SPANS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {({pa.int64(): 'long', pa.int32(): 'int', pa.binary(): 'binary'})[f.type]}" for f in schema)


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _owner_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _views(batch, 2)
            text, pos, first, last, h = owners(data, ends, length)
            view, start = memoryview(data), np.concatenate([[0], ends[:-1]])
            digest = xxhash.xxh3_64_intdigest
            ctx = np.fromiter((digest(view[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())), np.uint64, len(pos)) if len(pos) else np.zeros(0, np.uint64)
            ctx ^= (pos - first).astype(np.uint64) * _ODD[1]
            ids, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i in range(0, len(pos), 100_000):
                s = slice(i, i + 100_000)
                yield _batch(_OWNERS, ids[text[s]], hashes[text[s]], (pos - start[text])[s].astype(np.int32), (pos - first)[s].astype(np.int32), (last + length - pos)[s].astype(np.int32), h[s].view(np.int64), ctx[s].view(np.int64))

    return run


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies, rows = batch.column(2), []
        for i, places in enumerate(batch.column(3)):
            body = bodies[i].as_py()
            for x in places.as_py():
                part = body[x["pos"] - x["lft"] : x["pos"] + x["rgt"]]
                rows.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), x["pos"], x["lft"], x["key"], x["n"], part))
            if len(rows) >= 5000:
                yield _batch(_CONTEXTS, *zip(*rows))
                rows = []
        if rows:
            yield _batch(_CONTEXTS, *zip(*rows))


def _span_rows(length: int):
    """Contexts sorted by key, in runs of one key; a run may go on in the next batch."""

    def solve(run: list[tuple]) -> list[tuple]:
        if len(run) < 2:
            return []
        run = sorted(run, key=lambda r: r[:3])
        lefts = np.array([r[3] for r in run], np.int64)
        low, high = repeated([r[6] for r in run], lefts, length)
        return [(r[0], r[1], r[2] - b, r[2] - a + length) for r, a, b in zip(run, low.tolist(), high.tolist()) if a <= b and r[5] == 1]

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, run, out = None, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[4] != key:
                    out += solve(run)
                    key, run = row[4], []
                run.append(row)
            if len(out) > 5000:
                yield _batch(_SPANS, *zip(*out))
                out = []
        out += solve(run)
        if out:
            yield _batch(_SPANS, *zip(*out))

    return run_


def _window_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, pos, left, key, n, body in zip(*(c.to_pylist() for c in batch.columns)):
                digests = [xxhash.xxh3_128_intdigest(body[i : i + length]) for i in range(len(body) - length + 1)]
                m = len(digests)
                words = np.array([(d & (2**64 - 1), d >> 64) for d in digests], np.uint64).view(np.int64)
                yield _batch(_WINDOWS, [k1] * m, [k2] * m, [pos] * m, np.arange(left, left - m, -1).astype(np.int32), [n] * m, words[:, 0], words[:, 1])

    return run


_KEPT = pa.schema([("nid", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("n_passages", pa.int64())])


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            body, spans = batch.column(2)[i].as_py(), batch.column(3)[i]
            removed, n_spans, kept = 0, 0, body
            if spans.is_valid:
                at = spans.values
                edge = np.zeros(len(body) + 1, np.int32)
                np.add.at(edge, at.field(0).to_numpy(), 1)
                np.add.at(edge, at.field(1).to_numpy(), -1)
                gone = np.cumsum(edge)[:-1] > 0
                removed = int(gone.sum())
                n_spans = int(np.count_nonzero(np.diff(gone, prepend=False) & gone))
                kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
            rows.append((batch.column(0)[i].as_py(), len(body), removed, n_spans, kept, batch.column(1)[i].as_py()))
        if rows:
            yield _batch(_KEPT, *zip(*rows))


def _apart(counted: DataFrame, share: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """Rows of a written table with a count ``n``: those that hold more than one part in ``share`` of the sum, and the others.

    The first are fewer than ``share``, whatever the corpus, so they can be broadcast; a join with the others has no hot key.
    """
    total = counted.agg(F.sum("n")).first()[0] or 0
    much = F.col("n") > total / share
    return counted.filter(much), counted.filter(~much)


def _keep_counted(left: DataFrame, counted: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``left`` whose keys are in the written table ``counted``, with its other columns but n; no key is hot in the shuffle."""
    hot, rest = _apart(counted)
    other = [c for c in counted.columns if c not in keys and c != "n"]
    direct = left.join(F.broadcast(hot.select(*keys, *other)), keys)
    return direct.unionByName(left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest.select(*keys, *other), keys))


def _repeats(rows: DataFrame, length: int, max_bucket: int) -> DataFrame:
    """Rows (k1, k2, spans) of all bytes of rows (k1, k2, body) that are covered by a string of ``length`` bytes which starts
    elsewhere too; spans (lo, hi) may overlap."""
    found = staged(rows.filter(F.octet_length("body") >= length).select("k1", "k2", "body").mapInArrow(_owner_rows(length), _ddl(_OWNERS)), "owners")
    grams = found.groupBy("key").agg(F.count("*").alias("n"), (F.min("ctx") == F.max("ctx")).alias("pure")).filter("n > 1")
    grams = staged(grams, "grams")
    marked = staged(_keep_counted(found, grams, ["key"]), "marked")
    release(found, grams)
    alike = marked.filter("pure").select("k1", "k2", (F.col("pos") - F.col("lft")).alias("lo"), (F.col("pos") + F.col("rgt")).alias("hi"))

    mixed = marked.filter("not pure").drop("pure")
    place = F.struct("k1", "k2", "pos", "lft", "rgt")
    contexts = mixed.groupBy("key", "ctx").agg(F.count("*").alias("n"), F.min(place).alias("at"))
    contexts = staged(contexts.select("key", "ctx", "n", "at.*"), "contexts")
    many = staged(contexts.filter("n > 1").select("key", "ctx", "n"), "copied")
    copied = _keep_counted(mixed, many, ["key", "ctx"]).select("k1", "k2", (F.col("pos") - F.col("lft")).alias("lo"), (F.col("pos") + F.col("rgt")).alias("hi"))

    places = contexts.groupBy("k1", "k2").agg(F.collect_list(F.struct("key", "n", "pos", "lft", "rgt")).alias("places"))
    bodies = rows.join(places, ["k1", "k2"]).select("k1", "k2", "body", "places").mapInArrow(_context_rows, _ddl(_CONTEXTS))
    bodies = staged(bodies, "bodies")
    hot = staged(contexts.groupBy("key").count().filter(F.col("count") > max_bucket).select("key"), "hot")
    sorted_ = bodies.join(hot, "key", "left_anti").select(*_CONTEXTS.names).repartition("key").sortWithinPartitions("key", "k1", "k2", "pos").mapInArrow(_span_rows(length), _ddl(_SPANS))

    windows = bodies.join(hot, "key", "left_semi").select(*_CONTEXTS.names).mapInArrow(_window_rows(length), _ddl(_WINDOWS))
    often = windows.groupBy("w1", "w2").agg(F.sum("n").alias("total")).filter("total > 1").select("w1", "w2")
    counted = (
        windows.filter("n = 1").join(often, ["w1", "w2"]).groupBy("k1", "k2", "pos").agg(F.min("a").alias("least"), F.max("a").alias("most"))
        .select("k1", "k2", (F.col("pos") - F.col("most")).alias("lo"), (F.col("pos") - F.col("least") + length).alias("hi"))
    )
    spans = alike.unionByName(copied).unionByName(sorted_).unionByName(counted)
    spans = staged(spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "spans")
    release(marked, contexts, many, bodies, hot)
    return spans


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (nid, k1, k2, body): k1 and k2 tell rows of other identifiers or texts apart."""
    rows = docs.select(ident(id_col).alias("nid"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    return rows.select("nid", F.xxhash64("nid", "body").alias("k1"), F.xxhash64("body", "nid").alias("k2"), F.col("body").cast("binary").alias("body"))


_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = 0xD1342543DE82EF95


def word_codes(data: np.ndarray) -> bytes:
    """Four bytes for each word of a text given as UTF-8: a polynomial hash, from running sums over the whole text."""
    if not len(data):
        return b""
    space = np.concatenate([[True], _SPACES[data], [True]])
    start, end = np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])
    power = np.full(len(data) + 1, np.uint64(_BASE))
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)])
    back = np.full(len(data) + 1, np.uint64(pow(_BASE, -1, 2**64)))
    back[0] = 1
    h = (sums[end] - sums[start]) * np.cumprod(back, dtype=np.uint64)[start]
    h ^= h >> np.uint64(29)
    h *= _ODD[0]
    return (h >> np.uint64(32)).astype("<u4").tobytes()


_CODES = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("body", pa.binary())])


def _code_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, ends = _views(batch, 2)
        codes = [word_codes(data[a:b]) for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.binary())], schema=_CODES)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 51, max_bucket: int = 40_000) -> DataFrame:
    """Rows (k1, k2, ``n_passages``) of the texts with maximal runs of words that are covered by passages of ``words`` words
    which occur elsewhere too, whatever white space is between them; texts without any have no row.

    Words are runs of other characters than ``[\\x20\\x09-\\x0D]``. Texts become four bytes for each word, and the strings of
    that many words that repeat are found as in ``suffix_dedup``, whose remarks on edges hold here too.
    """
    rows = _keyed(docs, id_col, text_col)
    long = rows.filter(F.octet_length("body") >= 2 * words - 1).select("k1", "k2", "body")
    coded = staged(long.mapInArrow(_code_rows, _ddl(_CODES)), "codes")
    spans = _repeats(coded, 4 * words, max_bucket)
    release(coded)
    ordered = F.array_sort("spans")
    # A span opens a new run if it starts behind the end of all before it.
    runs = F.aggregate(
        ordered, F.struct(F.lit(0).alias("n"), F.lit(-1).alias("end")),
        lambda run, s: F.struct((run.n + F.when(s.lo > run.end, 1).otherwise(0)).alias("n"), F.greatest(run.end, s.hi).alias("end")),
    )
    return spans.select("k1", "k2", runs.n.cast("long").alias("n_passages"))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, max_bucket: int = 40_000, passage_words: int | None = None) -> DataFrame:
    """Remove each byte that a string of ``length`` bytes covers which also starts anywhere else, in the same text or another.

    Returns for each row: identifier, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` (binary:
    the bytes left). All copies lose their bytes; strings are judged on the input. Null text is empty; matches never cross
    rows; repeated rows repeat each other; a null identifier stays null; an empty table gives an empty result; other
    columns are ignored. With ``passage_words`` there is also ``n_passages``, of runs that ``repeated_passages`` finds: they
    are only counted, as they may be shorter than ``length`` bytes.

    Rows are told apart by 128 bits of hash over identifier and text, as are contexts and windows. Owners are found once
    and written; they are counted by gram with partial sums before the shuffle. A gram whose owners all have the same
    context (the bytes of their windows) needs no sorting: its windows are repeated as a whole. Only distinct contexts of
    one gram are sorted, in a task that holds one bucket at a time. Buckets of more than ``max_bucket`` distinct contexts
    are solved by counting their windows by hash, which is exact as well and spreads them over all tasks. Grams and
    contexts that hold over one owner in 10,000, of which there are at most 10,000, are joined by broadcast, so that no
    task gets the owners of a hot one.
    """
    rows = _keyed(docs, id_col, text_col)
    found = _repeats(rows, length, max_bucket)
    if passage_words is None:
        found = found.withColumn("n_passages", F.lit(0).cast("long"))
    else:
        found = found.join(repeated_passages(docs, id_col, text_col, passage_words, max_bucket), ["k1", "k2"], "full")
    kept = rows.join(found, ["k1", "k2"], "left").select("nid", F.coalesce("n_passages", F.lit(0)).alias("n_passages"), "body", "spans").mapInArrow(
        _kept_rows, "nid long, n_bytes long, n_removed long, n_spans long, kept binary, n_passages long"
    )
    kept = kept.withColumnRenamed("nid", id_col).withColumn(id_col, unident(id_col))
    return kept.drop("n_passages") if passage_words is None else kept


def op1_suffix_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = suffix_dedup(docs, passage_words=51)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_passages")

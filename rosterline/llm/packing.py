"""Cost-balanced packing of token sequences."""

from __future__ import annotations

import base64
import re
import zlib
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ident, staged, unident

SEQUENCE = 2048
END_ID = 1
#: Fixed values of the byte-level vocabulary: how it splits a text, and its special token.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
#: A space in a run of white space whose next character is white space, or the end: there the text can't be cut.
_RUN = re.compile(r"\s (?:\s|\Z)")
#: Marks that end a word; a word of letters is never joined with marks after it.
_MARKS = ".,;:!?#$%&*|"


class Encoder:
    """Ids of a byte-level vocabulary as little-endian bytes.

    No word of the vocabulary reaches over a space from the left, so a text is cut before its spaces; a part is cut at single
    line ends, if no line of it begins with white space of any kind, and before the marks that end a word. Each part is encoded once and then looked up; the parts held are
    bounded. ``path`` is the vocabulary as ranks.
    """

    def __init__(self, path: str, most: int = 400_000):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
        self.encode = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.line = self.whole("\n")
        self.plain, self.spaced = _Parts(self, "", most), _Parts(self, " ", most)

    def whole(self, text: str) -> bytes:
        return np.array(self.encode(text), "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """All ids of a whole text."""
        if SPECIAL in text:
            return np.uint32(SPECIAL_ID).tobytes().join(map(self.ids, text.split(SPECIAL)))
        if _RUN.search(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        return self.plain[first] + b"".join(map(self.spaced.__getitem__, rest))


class _Parts(dict):
    def __init__(self, encoder: Encoder, before: str, most: int):
        super().__init__()
        self.encoder, self.before, self.most = encoder, before, most

    def __missing__(self, part: str) -> bytes:
        core = part.rstrip(_MARKS)
        lines = part.split("\n")
        if len(lines) > 1 and all(lines) and not any(line[0].isspace() for line in lines):
            ids = self[lines[0]] + b"".join(self.encoder.line + self.encoder.plain[line] for line in lines[1:])
        elif core and len(core) < len(part) and core[-1].isalpha():
            ids = self[core] + self.encoder.plain[part[len(core) :]]
        else:
            ids = array("I", self.encoder.encode(self.before + part)).tobytes()
        if len(part) <= 40:
            if len(self) >= self.most:
                self.clear()
            self[part] = ids
        return ids


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One for each worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cost(length: int, linear: float = 1.0, quadratic: float = 1 / 1024) -> float:
    """Estimated cost of attention over a piece: its other layers are linear in its length, attention is quadratic."""
    return linear * length + quadratic * length * length


def pack(lengths: list[int], capacity: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents with these lengths.

    Whole sequences are cut from documents longer than one. What is left goes, in descending length, to the sequence of
    lowest cost that has room for it; a rest that no sequence has room for is cut over those with the most room. As many
    sequences are opened as the rests fill, so only the room of less than one sequence is left.
    """
    out, rests, opened = [], [], 0
    for doc, n in enumerate(lengths):
        whole = n // capacity
        for k in range(whole):
            out.append((doc, k * capacity, capacity, opened, 0))
            opened += 1
        if n % capacity:
            rests.append((n % capacity, doc, whole * capacity))
    bins = -(-sum(n for n, _, _ in rests) // capacity)
    used, costs = np.zeros(bins, np.int64), np.zeros(bins)

    def put(b: int, doc: int, start: int, n: int) -> None:
        out.append((doc, start, n, opened + b, int(used[b])))
        used[b] += n
        costs[b] += cost(n)

    homeless = []
    for n, doc, start in sorted(rests, key=lambda r: (-r[0], r[1])):
        b = int(np.argmin(np.where(used + n <= capacity, costs, np.inf)))
        if used[b] + n <= capacity:
            put(b, doc, start, n)
        else:
            homeless.append((n, doc, start))
    room = np.argsort(used, kind="stable").tolist()[::-1]
    for n, doc, start in homeless:
        while n:
            b = room[-1]
            take = min(n, capacity - int(used[b]))
            if not take:
                room.pop()
                continue
            put(b, doc, start, take)
            n, start = n - take, start + take
    return out


def _with_copies(rows: DataFrame, keys: list[str], step: int = 1000) -> DataFrame:
    """rows with ``copy``, their number among rows equal in ``keys``, which tell texts apart.

    Equal rows are counted and one text of each is moved; the copies are made again, ``step`` at a time in tasks of their own,
    so neither a shuffle nor a task holds all copies of a row.
    """
    often = staged(rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys), "often")
    alone = rows.join(often, keys, "left_anti").select(*keys, "body", F.lit(0).cast("long").alias("copy"))
    if often.isEmpty():
        return alone
    one = rows.join(often, keys, "left_semi").groupBy(*keys).agg(F.any_value("body").alias("body"), F.count("*").alias("n"))
    parts = one.select(*keys, "body", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(step).cast("long"))).alias("at")).repartition(*keys, "at")
    copies = parts.select(*keys, "body", F.explode(F.sequence("at", F.least(F.col("n"), F.col("at") + step) - 1)).alias("copy"))
    return alone.unionByName(copies)


_SCHEMA = "nid long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_cost double"


def pack_sequences(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = 8 << 20, with_ids: bool = False) -> DataFrame:
    """Pack all texts into sequences of at most 2048 ids: rows (identifier, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_cost).

    A document is its ids and an end id; it is cut freely and each id lies in one piece. ``with_ids`` adds the ids of each
    piece (array of int). Documents are dealt by a hash to shards of about ``shard_bytes`` of text, as many as the
    corpus needs, equal rows by their number too, so that no shard gets them all, and a shard is packed by itself; it leaves less than one sequence of padding, so padding is below one
    part in a thousand at any size. A shard is the only thing held in a task's memory.

    Null text is the end id alone. Rows that share an identifier are packed each for itself; a null identifier stays
    null. An empty table gives an empty result. Other columns are ignored. Results do not depend on partitions: a shard is
    sorted before it is packed.
    """
    rows = docs.select(ident(id_col).alias("nid"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    total = rows.agg(F.sum(F.octet_length("body").cast("long"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    rows = rows.withColumns({"h": F.xxhash64("body"), "h2": F.xxhash64(F.lit("again"), "body")})
    rows = _with_copies(rows, ["nid", "h", "h2"]).select("nid", "body", F.pmod(F.xxhash64("nid", "h", "copy"), F.lit(shards)).alias("shard"))
    schema = _SCHEMA + (", ids array<int>" if with_ids else "")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["nid", "body"], kind="stable")
        ids_of, end = encoder_of(vocabulary).ids, np.uint32(END_ID).tobytes()
        ids = [ids_of(text) + end for text in pdf["body"]]
        placed = pack([len(x) // 4 for x in ids])
        if not placed:
            return pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])
        base, nids = int(pdf["shard"].iloc[0]) << 32, pdf["nid"].to_numpy()
        doc, start, length, seq, offset = (np.array(c, np.int64) for c in zip(*placed))
        parts = [ids[d][4 * s : 4 * (s + n)] for d, s, n, _, _ in placed]
        by_seq = np.bincount(seq, cost(length))
        out = {
            "nid": nids[doc], "start": start, "length": length, "ids_crc32": [zlib.crc32(p) for p in parts],
            "doc_tokens": np.array([len(x) // 4 for x in ids], np.int64)[doc], "sequence_id": seq + base, "offset": offset, "sequence_cost": by_seq[seq],
        }
        if with_ids:
            out["ids"] = [np.frombuffer(p, "<u4").astype(np.int32) for p in parts]
        return pd.DataFrame(out)

    return rows.groupBy("shard").applyInPandas(run, schema).withColumnRenamed("nid", id_col).withColumn(id_col, unident(id_col))


def vocabulary_path() -> str:
    """The vocabulary that the query uses, as ranks: the same ids as byte_bpe_50k.json gives."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op3_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_sequences(docs, vocabulary_path()).drop("sequence_cost")

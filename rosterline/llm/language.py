"""Language identification: the family first, then one-versus-one linear classifiers within it."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


#: Families of languages. A language that is not here is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "indo_aryan": ("hi", "bn", "mr", "pa", "gu", "ne", "ur"),
    "turkic": ("tr", "az", "kk", "uz"),
}
UNKNOWN = "und"
GRAMS = (1, 2, 3, 4)  # bytes
BINS = 1 << 12
_ROWS = 500  # texts that a task turns into Python strings at a time
_GAP = b"\x20" * 4
#: Other ASCII characters than letters count as white space.
_PLAIN = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_ODD = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917), np.uint32(668265263))


def family_of(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs), lang)


def gram_counts(texts: list[str]) -> Iterator[np.ndarray]:
    """Of each text the counts of its byte n-grams by bin, as shares of their number. Runs of white space count for nothing."""
    at = 0
    while at < len(texts):
        part, size = [], 0
        while at < len(texts) and size < 1 << 19:
            part.append(texts[at].lower().encode().translate(_PLAIN))
            size += len(part[-1])
            at += 1
        data = np.frombuffer(_GAP + _GAP.join(part) + _GAP, np.uint8)
        n = len(data) - 3
        blank = (data[:n] == 32) & (data[1 : n + 1] == 32)
        h, bins = np.zeros(n, np.uint32), np.empty((len(GRAMS), n), np.int16)
        for k, size_ in enumerate(GRAMS):
            h = (h ^ data[size_ - 1 : size_ - 1 + n]) * _ODD[k]
            h ^= h >> np.uint32(15)
            bins[k] = (h >> np.uint32(3)) & np.uint32(BINS - 1)
        bins[:, blank] = BINS
        start = len(_GAP)
        for text in part:
            # From the blank before the text on, so that a first letter is known as one.
            count = np.bincount(bins[:, start - 1 : start + len(text)].ravel(), minlength=BINS + 1)[:BINS]
            yield (count / max(1, count.sum())).astype(np.float32)
            start += len(text) + len(_GAP)


def linear_svm(x: np.ndarray, y: np.ndarray, strength: float = 1e-3, steps: int = 120) -> tuple[np.ndarray, float]:
    """Weights and bias of least squared hinge loss, by accelerated gradient steps; y is 1 or -1, both sides weigh the same."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    y = y.astype(np.float32)
    v, u = np.random.default_rng(0).normal(size=x.shape[1]).astype(np.float32), np.float32(1)
    for _ in range(10):  # the largest curvature, with the bias as a feature that is always 1
        r = weight * (x @ v + u)
        v, u = x.T @ r, r.sum()
        top = float(np.sqrt(v @ v + u * u))
        v, u = v / max(top, 1e-12), u / max(top, 1e-12)
    rate = np.float32(1 / (2 * top + strength))
    w, bias, ahead, ahead_bias = np.zeros_like(v), np.float32(0), np.zeros_like(v), np.float32(0)
    for k in range(steps):
        pull = 2 * weight * np.maximum(0, 1 - y * (x @ ahead + ahead_bias)) * y
        new, new_bias = ahead - rate * (strength * ahead - x.T @ pull), ahead_bias - rate * (strength * ahead_bias - pull.sum())
        ahead, ahead_bias = new + (k / (k + 3)) * (new - w), new_bias + (k / (k + 3)) * (new_bias - bias)
        w, bias = new, new_bias
    return w.astype(np.float32), float(bias)


def steepness(margin: np.ndarray, y: np.ndarray) -> float:
    """The slope of a logistic curve through 0 that fits the margins: turns a margin into a probability."""
    a = 1.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * margin * y, -50, 50)))
        grad, bend = float(((1 - p) * margin * y).mean()) - 1e-3 * a, float((p * (1 - p) * margin**2).mean()) + 1e-3
        a = min(max(a + grad / bend, 0.1), 20.0)
    return a


def fit(x: np.ndarray, langs: list[str]) -> dict:
    """The model: scale of features, one-versus-rest classifiers of families, one-versus-one classifiers within each. x is used up."""
    scale = 1 / (x.std(0) + 1e-4)
    x *= scale / np.sqrt(np.float32(x.shape[1]))
    lang, family = np.array(langs), np.array([family_of(v) for v in langs])
    families = sorted(set(family))
    columns, biases, steep, pairs = [], [], [], []

    def add(rows: np.ndarray, y: np.ndarray) -> None:
        w, b = linear_svm(x[rows], y.astype(np.float32))
        columns.append(w * scale / np.sqrt(len(scale)))
        biases.append(b)
        steep.append(steepness(x[rows] @ w + b, y))

    everyone = np.arange(len(lang))
    for name in families if len(families) > 1 else []:
        add(everyone, np.where(family == name, 1, -1))
    members = {name: sorted(set(lang[family == name])) for name in families}
    for name in families:
        for a, b in combinations(members[name], 2):
            rows = np.flatnonzero((lang == a) | (lang == b))
            pairs.append((name, a, b))
            add(rows, np.where(lang[rows] == a, 1, -1))
    weights = np.array(columns, np.float32).reshape(-1, BINS).T
    return {"families": families, "members": members, "pairs": pairs, "w": weights, "b": np.array(biases, np.float32), "steep": np.array(steep, np.float32)}


def decide(model: dict, count: np.ndarray) -> tuple[str, float]:
    """The language of a text and a score from 0 to 1: the family's probability times the mean one against its relatives."""
    families, members = model["families"], model["members"]
    p = 1 / (1 + np.exp(-np.clip((count @ model["w"] + model["b"]) * model["steep"], -50, 50))) if len(model["b"]) else np.zeros(0)
    n = len(families) if len(families) > 1 else 0
    shares = p[:n] / p[:n].sum() if n else np.ones(1)
    family = families[int(np.argmax(shares))]
    votes = {m: [0, 0.0] for m in members[family]}
    for (name, a, b), q in zip(model["pairs"], p[n:].tolist()):
        if name == family:
            votes[a if q >= 0.5 else b][0] += 1
            votes[a][1] += q
            votes[b][1] += 1 - q
    best = max(sorted(votes), key=lambda m: tuple(votes[m]))
    rivals = len(votes) - 1
    return best, float(np.max(shares)) * (votes[best][1] / rivals if rivals else 1.0)


def held_out(id_col: str):
    """Documents whose crc32 of the identifier as text is 2 modulo 4; false for a null identifier."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def hash_limit(wanted: int, rows: int) -> int:
    """A limit below which about twice the wanted number of rows have their hash of 60 bits; all of them if they are few."""
    return min(1 << 60, -(-(2 * wanted + 64) * (1 << 60) // rows))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 2000) -> dict | None:
    """Fit the classifiers on at most ``sample`` documents, an equal number of each language.

    Of a language's rows those with the least hashes of identifier and text are taken, equal rows once; a share of the
    hashes that holds twice as many is looked at for them. Only rows with a language, an identifier, a letter and not
    ``held_out`` are learned from. The sample is the only data that reaches the driver: at most so many vectors of 4096
    bins. None if there is nothing to learn from.
    """
    known = docs.select(F.col(id_col).alias("i"), F.col(lang_col).cast("string").alias("l"), F.col(text_col).alias("t"), held_out(id_col).alias("out"))
    known = known.filter("l is not null and i is not null and not out").filter(F.col("t").rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in known.groupBy("l").count().collect()}
    if not counts:
        return None
    each = max(1, sample // len(counts))
    share = F.lit(0)
    for lang in sorted(counts):
        share = F.when(F.col("l") == lang, F.lit(hash_limit(each, counts[lang]))).otherwise(share)
    hashed = known.withColumn("h", F.shiftrightunsigned(F.xxhash64(F.lit("language"), "i", "t"), 4))
    few = hashed.filter(F.col("h") < share).dropDuplicates(["l", "h"])
    rank = F.row_number().over(Window.partitionBy("l").orderBy("h"))
    chosen = few.withColumn("rank", rank).filter(F.col("rank") <= each).select("i", "l", "t")
    schema = pa.schema([("i", pa.int64()), ("l", pa.string()), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, _ROWS) for whole in batches for at in range(0, whole.num_rows, _ROWS)):
            vectors = [zlib.compress(v.tobytes(), 1) for v in gram_counts(batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.string()), pa.array(vectors, pa.binary())], schema=schema)

    rows = sorted((tuple(r) for r in chosen.mapInArrow(run, "i long, l string, x binary").collect()), key=lambda r: (r[1], r[0], bytes(r[2])))
    if not rows:
        return None
    x, langs = np.empty((len(rows), BINS), np.float32), [r[1] for r in rows]
    for i in range(len(rows)):
        x[i], rows[i] = np.frombuffer(zlib.decompress(rows[i][2]), np.float32), None
    return fit(x, langs)


def identify(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``lang_score``; columns of these names are replaced.

    ``und`` with score 0 if the text is null or has no letter, or if there is no model. Of families with equal probability the
    first by name wins, of languages with equal votes and probabilities too. Repeated rows get the same
    result each; an empty table gives an empty result. A row's result depends on its whole
    text alone: no shuffle, and a batch's texts are handled half a megabyte at a time (longer texts one by one). The model of
    a few weights for each bin is part of the task.
    """
    docs = docs.drop("lang_pred", "lang_score")
    own = docs.columns
    marked = docs.withColumn("lang_score", F.when(F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)), 1.0).otherwise(0.0))
    at, flag = own.index(text_col), len(own)
    schema = T.StructType([*marked.schema.fields, T.StructField("lang_pred", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(start, _ROWS)
                letters = batch.column(flag).to_pylist()
                out, usable = [(UNKNOWN, 0.0)] * len(letters), [i for i, x in enumerate(letters) if x and model is not None]
                texts = batch.column(at).take(pa.array(usable, pa.int32())).to_pylist()
                for i, count in zip(usable, gram_counts(texts)):
                    out[i] = decide(model, count)
                langs, scores = pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns[:flag], scores, langs], names=[*own, "lang_score", "lang_pred"])

    return marked.mapInArrow(run, schema).select(*own, "lang_pred", "lang_score")


def in_a_language(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``least`` or more, with all columns as they were."""
    own = {c: f"_own_{c}" for c in ("lang_pred", "lang_score") if c in docs.columns}
    found = identify(docs.withColumnsRenamed(own), train(docs))
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("lang_score") >= least)).select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def op2_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))

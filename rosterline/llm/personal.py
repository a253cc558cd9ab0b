"""Personal data: overlapping candidates, boosted trees over their format and context, calibrated thresholds.

DataFrame functions only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .boosting import boost, score_cells, score_column
from .common import ident, staged, unident

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, written so that each is matched in linear time: a run is entered at its start or where the last match
#: ended, repeats are possessive, and an inner mark is taken only if what must follow it does.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-](?:(?!\.(?![A-Za-z0-9-]))[A-Za-z0-9.-])*+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:(?![ -](?![0-9]))[0-9 -])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: High-recall generators. Their spans may overlap each other and the base ones. A local part has at most 64 characters
#: and a label of a host 63, as their formats say; hosts of up to seven labels and numbers of up to six groups are proposed,
#: and longer ones only if the base finds them.
LOOSE = {
    "email": r"(?<![\w.%+@-])[\w.%+-]{1,64}(?: ?[(\[{] ?at ?[)\]}] ?|@)[\w-]{1,63}(?:(?:\.| ?[(\[{] ?dot ?[)\]}] ?)[\w-]{1,63}){1,6}",
    "ip": r"(?<![\w.])[0-9]{1,3}(?: ?[.,:] ?[0-9]{1,3}){3}(?![\w.])",
    "card": r"(?<![0-9])[0-9]{3,6}(?:[ ./_-]{0,2}[0-9]{2,7}){2,5}(?![0-9])",
    "phone": r"(?<![\w.])(?:\+|00)?[(]?[0-9]{1,4}[)]?(?:[ ./-]{1,2}[(]?[0-9]{2,5}[)]?){2,5}(?![\w.])",
}
#: Words before or after a span that speak of its kind, or against all.
SPEAKS = {
    1: ("mail", "email", "e-mail", "contact", "write", "reach"), 2: ("ip", "host", "server", "address", "login", "client"),
    3: ("card", "credit", "visa", "mastercard", "iban", "account", "payment"), 4: ("phone", "tel", "call", "fax", "mobile", "cell", "telephone"),
    5: ("version", "order", "isbn", "id", "no", "section", "figure", "page", "serial", "token", "key", "hash"),
}
FEATURES = ("kind", "digits", "size", "groups", "wide", "shape", "check", "row", "left", "right", "context")
_CONTEXT = 24  # code points looked at on either side


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check of its last one."""
    total = F.aggregate(
        F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(2 * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda a, v: a + v,
    )
    return total % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    """The base rules on a match: parts of an ip, digits and check of a card, digits of a phone."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    ip = F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    return (
        F.when(kind == "email", True).when(kind == "ip", ip).when(kind == "card", F.when(n.between(16, 19), luhn(digits)).otherwise(False))
        .otherwise(n.between(8, 15))
    )


def _groups(value: Column) -> Column:
    """The runs of digits in a text."""
    return F.filter(F.split(value, "[^0-9]+", -1), lambda g: g != "")


def _check(kind: Column, value: Column) -> Column:
    """Whether the numbers or names in a loose candidate can be of its kind, whatever its marks: parts of an ip, digits and
    check of a card, digits of a phone, an email once '(at)' and '(dot)' are read as marks and its host is not all digits."""
    plain = F.regexp_replace(F.regexp_replace(value, r" ?[(\[{] ?at ?[)\]}] ?", "@"), r" ?[(\[{] ?dot ?[)\]}] ?", ".")
    email = (F.regexp_extract(plain, BASE["email"], 0) != "") & F.substring_index(plain, "@", -1).rlike("[A-Za-z]")
    return F.when(kind == "email", email).when(kind == "ip", _valid(F.lit("ip"), F.concat_ws(".", _groups(value)))).otherwise(_valid(kind, value))


def _shape(value: Column) -> Column:
    """What a row of digits looks like: 1 a date, 2 one number in groups of three or with dots alone, 3 years, 4 marked as a
    phone ('+', '00', brackets), 5 dialled from within a country, 6 numbers with unlike marks, 0 none of these."""
    parts = _groups(value)
    sizes, last = F.transform(parts, lambda g: F.length(g)), F.length(F.element_at(parts, F.lit(-1)))
    date = value.rlike(r"^(?:(?:1[5-9]|20)[0-9]{2}[ ./-](?:0?[1-9]|1[0-2])[ ./-](?:0?[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])[ ./-](?:0?[1-9]|[12][0-9]|3[01])[ ./-](?:1[5-9]|20)[0-9]{2})(?![0-9])")
    number = value.rlike(r"^[0-9]{1,3}(?:\.[0-9]{3})+$") | value.rlike("^[0-9]{1,2}(?: [0-9]{3})+$") | value.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$")
    years = F.forall(parts, lambda g: g.rlike("^(?:1[5-9]|20)[0-9]{2}$"))
    dialled = value.rlike("^0[1-9]") | (F.size(parts).between(3, 4) & (last == 4) & F.exists(sizes, lambda n: n != 4))
    unlike = F.size(F.array_distinct(F.filter(F.split(F.regexp_replace(value, "[0-9 ()]", ""), ""), lambda c: c != ""))) > 1
    return (
        F.when(date, 1).when(number, 2).when(years, 3).when(value.rlike(r"^(?:\+|00)|[(]"), 4).when(unlike, 6).when(dialled, 5).otherwise(0)
    )


def _cases(base: DataFrame) -> DataFrame:
    """Labelled cases made of the base matches that pass: nid, kind, value, before, after, own (whether it is personal data).

    Positives are the match in other forms: an email with '(at)' and '(dot)', an ip with other marks, a card with other
    separators, a phone without '+'. Negatives are look-alikes at the same place: names at digits, numbers that no ip has,
    rows of numbers and times, cards of which one digit is changed, dates, years and grouped numbers.
    """
    value, digits = F.col("value"), F.regexp_replace("value", "[^0-9]", "")
    local, host, parts = F.substring_index("value", "@", 1), F.substring_index("value", "@", -1), _groups(value)
    seed = F.pmod(F.xxhash64("nid", "value"), F.lit(1_000_000)).cast("int")
    n = lambda low, high, step: (F.lit(low) + F.pmod(seed * F.lit(step) + F.lit(step), F.lit(high - low + 1))).cast("string")
    two = lambda low, high, step: F.lpad(n(low, high, step), 2, "0")
    by = lambda mark, d=digits: F.regexp_replace(d, "(.{4})(?=.)", f"$1{mark}")
    bad = F.concat(F.left(digits, F.length(digits) - 1), F.pmod(F.right(digits, F.lit(1)).cast("int") + 1 + F.pmod(seed, F.lit(9)), F.lit(10)).cast("string"))
    rest = F.expr("substring(value, 2)")
    inland = F.regexp_replace(F.concat(F.lit("0"), n(2, 9, 3), F.right(digits, F.lit(9))), "^(...)(....)(.*)$", "$1 $2 $3")
    row = lambda start, step, mark, k=4: F.concat_ws(mark, *[(F.lit(start) + F.pmod(seed, F.lit(60)) + step * i).cast("string") for i in range(k)])
    own = {
        "email": [F.concat(local, F.lit(a), F.replace(host, F.lit("."), F.lit(d))) for a, d in ((" (at) ", " (dot) "), ("[at]", "[dot]"), (" (at) ", "."))],
        "ip": [F.concat_ws(mark, parts) for mark in (", ", ":", " . ")],
        "card": [by("."), by("/"), by("_")],
        "phone": [rest, F.concat(F.lit("00"), rest), inland],
    }
    not_own = {
        "email": [F.concat(local, F.lit(" (at) "), n(0, 20, 7), F.lit("."), n(0, 30, 11)), F.concat(local, F.lit("[at]"), n(0, 20, 5), F.lit("[dot]"), n(0, 9, 3))],
        "ip": [F.concat_ws(", ", n(256, 999, 7), n(0, 255, 5), n(256, 999, 3), n(0, 255, 11)), row(1, 1, ", "), F.concat_ws(":", two(0, 23, 7), two(0, 59, 5), two(0, 59, 3), n(0, 999, 11)), row(100, 10, ", ")],
        "card": [by(".", bad), by(" ", bad), by("/", bad)],
        "phone": [
            F.concat_ws("-", n(1950, 2030, 7), two(1, 12, 5), two(1, 28, 3)), F.concat_ws(".", two(1, 28, 7), two(1, 12, 3), n(1950, 2030, 11)), row(1990, 1, " ", 3),
            F.concat_ws(".", n(1, 99, 7), n(100, 999, 3), n(100, 999, 11)), F.concat_ws(" ", n(1, 99, 7), n(100, 999, 3), n(100, 999, 5)),
        ],
    }
    made = F.lit(None)
    for kind in KINDS:
        longer = F.concat(F.lit(", 160"), F.col("after"))  # the fourth look-alike of an ip is part of a longer row
        cases = [F.struct(v.alias("value"), F.lit(True).alias("own"), F.col("after").alias("after")) for v in own[kind]]
        cases += [F.struct(v.alias("value"), F.lit(False).alias("own"), (longer if kind == "ip" and i == 3 else F.col("after")).alias("after")) for i, v in enumerate(not_own[kind])]
        made = F.when(F.col("kind") == kind, F.array(*cases)).otherwise(made)
    return base.select("nid", "kind", "before", F.explode(made).alias("c")).select("nid", "kind", "c.value", "before", "c.after", "c.own")


def _matches(body: Column, pattern: str, base: bool, kind: str) -> Column:
    """All matches in order: text, length of the piece before it, and what lies on either side.

    The pieces between matches give the places, since matches and pieces make up the whole text.
    """
    pieces, found = F.split(body, pattern, -1), F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    before = F.transform(F.slice(pieces, 1, F.size(found)), lambda p: F.struct(F.length(p).alias("gap"), F.right(p, F.lit(_CONTEXT)).alias("before")))
    after = F.transform(F.slice(pieces, 2, F.size(found)), lambda p: F.left(p, F.lit(_CONTEXT)))
    part = F.zip_with(before, after, lambda b, a: F.struct(b.gap.alias("gap"), b.before.alias("before"), a.alias("after")))
    return F.zip_with(
        found, part,
        lambda v, p: F.struct(F.lit(base).alias("base"), F.lit(kind).alias("kind"), v.alias("value"), p.gap.alias("gap"), p.before.alias("before"), p.after.alias("after")),
    )


def candidates(rows: DataFrame) -> DataFrame:
    """Candidates of rows (nid, h, body): nid, h, base, kind, k, value, before, after, start, end (code points)."""
    empty = F.array().cast("array<struct<base:boolean,kind:string,value:string,gap:int,before:string,after:string>>")
    worth = {"email": r"@|[(\[{] ?at ?[)\]}]", "ip": r"[0-9] ?[.,:] ?[0-9]", "card": "[0-9][ ./_-]{0,2}[0-9]", "phone": "[0-9]"}
    some = rows.filter(F.col("body").rlike(r"[0-9]|@|[(\[{] ?at ?[)\]}]"))
    arrays = [
        F.when(F.col("body").rlike(worth[kind]), _matches(F.col("body"), pattern, base, kind)).otherwise(empty)
        for base, patterns in ((True, BASE), (False, LOOSE)) for kind, pattern in patterns.items()
    ]
    one = some.select("nid", "h", F.explode(F.array(*arrays)).alias("list")).select("nid", "h", F.posexplode("list").alias("k", "c")).select("nid", "h", "k", "c.*")
    # Repeated rows give the same candidates; one of each is enough.
    one = one.repartition("nid", "h").dropDuplicates(["nid", "h", "base", "kind", "k"])
    w = Window.partitionBy("nid", "h", "base", "kind").orderBy("k")
    size = F.length("value")
    end = F.sum(F.col("gap") + size).over(w)
    return one.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - size).drop("gap")


def _features(found: DataFrame) -> DataFrame:
    """Small integers that describe the format and context of a candidate (kind, value, before, after)."""
    value, before, after = F.col("value"), F.col("before"), F.lower(F.col("after"))
    digits, number = F.length(F.regexp_replace(value, "[^0-9]", "")), F.col("kind") != "email"
    code = F.lit(0)
    for at, kind in enumerate(KINDS):
        code = F.when(F.col("kind") == kind, at).otherwise(code)
    side = lambda c: F.when(c == "", 0).when(c.rlike(r"[\x20\x09-\x0D]"), 1).when(c.rlike(r"\w"), 2).otherwise(3)
    near = F.concat_ws(" ", F.lower(before), after)
    context = F.lit(0)
    for at, said in sorted(SPEAKS.items(), reverse=True):
        context = F.when(near.rlike(r"(?<!\w)(?:" + "|".join(said) + r")(?!\w)"), at).otherwise(context)
    row = before.rlike("[0-9] ?[.,:] ?$") | F.col("after").rlike("^ ?[.,:] ?[0-9]")
    return found.withColumns({
        "f_kind": code, "f_digits": F.when(digits < 8, digits.cast("int") / 4).when(digits < 20, digits - 6).otherwise(14).cast("int"),
        "f_size": F.when(F.length(value) < 12, 0).when(F.length(value) < 16, 1).when(F.length(value) < 20, 2).when(F.length(value) < 40, 3).otherwise(4),
        "f_groups": F.least(F.size(_groups(value)), F.lit(7)), "f_wide": F.least(F.size(F.filter(_groups(value), lambda g: F.length(g) == 3)), F.lit(4)),
        "f_shape": F.when(number, _shape(value)).otherwise(0), "f_check": _check(F.col("kind"), value).cast("int"), "f_row": row.cast("int"),
        "f_left": side(F.right(before, F.lit(1))), "f_right": side(F.left(after, F.lit(1))), "f_context": context,
    })


def train(cases: DataFrame, precision: float = 0.9, least: int = 10) -> tuple[tuple, dict[str, float], dict[str, tuple[int, float, float]]]:
    """Trees, a threshold for each kind, and its held-back positives, precision and recall, from labelled cases (nid, own, f_*).

    Cases are counted by feature vector in Spark; only the counts reach the driver, at most one row for each combination of
    small integers, whatever the size of the corpus. Three quarters of the documents fit the trees, the rest calibrates: a
    kind's threshold is the least score from which on at least ``precision`` of the held-back cases are positive, and half of
    those with that very score; it is infinite if fewer than ``least`` are left.
    """
    names = [f"f_{f}" for f in FEATURES]
    cells = cases.groupBy((F.pmod(F.xxhash64(F.lit("back"), "nid"), F.lit(4)) == 0).alias("back"), *names).agg(F.count("*").alias("n"), F.sum(F.col("own").cast("int")).alias("s"))
    rows = sorted(tuple(r) for r in cells.collect())
    table = np.array([r[1:] for r in rows], np.float64).reshape(len(rows), len(names) + 2)
    back = np.array([r[0] for r in rows], bool)
    x, n, s = table[:, : len(names)], table[:, -2], table[:, -1]
    model = boost(x[~back], n[~back], s[~back])
    thresholds, report = {}, {}
    for code, kind in enumerate(KINDS):
        mine = back & (x[:, 0] == code)
        score = score_cells(model, x[mine])
        order = np.argsort(-score, kind="stable")
        count, right = np.cumsum(n[mine][order]), np.cumsum(s[mine][order])
        last = np.append(np.diff(score[order]) != 0, True) if len(order) else np.zeros(0, bool)
        score, count, right = score[order][last], count[last], right[last]
        good = np.flatnonzero((count >= least) & (right >= precision * count) & (2 * np.diff(right, prepend=0) >= np.diff(count, prepend=0)))
        thresholds[kind] = float(score[good[-1]]) - 1e-9 if len(good) else float("inf")
        report[kind] = (int(right[-1]) if len(right) else 0, *((float(right[good[-1]] / count[good[-1]]), float(right[good[-1]] / right[-1])) if len(good) else (0.0, 0.0)))
    return model, thresholds, report


def _spans(found: DataFrame) -> DataFrame:
    """Base matches that pass, and the loose candidates that are selected and that touch neither them nor each other."""
    by_doc = Window.partitionBy("nid", "h").orderBy("start", "end", F.desc("base"), "kind")
    past, future = by_doc.rowsBetween(Window.unboundedPreceding, -1), by_doc.rowsBetween(1, Window.unboundedFollowing)
    base_end, base_start = F.when(F.col("base"), F.col("end")), F.when(F.col("base"), F.col("start"))
    return (
        found.withColumn("last", F.max(base_end).over(past)).withColumn("next", F.min(base_start).over(future))
        .withColumn("free", F.col("base") | ((F.coalesce("last", F.lit(-1)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))))
        .filter("free").withColumn("last", F.max("end").over(past)).filter(F.col("base") | (F.coalesce("last", F.lit(-1)) <= F.col("start")))
    )


def _learned(found: DataFrame, precision: float) -> tuple[DataFrame, DataFrame, dict]:
    """From a written table of candidates: base matches that pass, loose ones that are selected, and ``train``'s report."""
    base = found.filter("base").filter(_valid(F.col("kind"), F.col("value")))
    loose, names = found.filter("not base"), [f"f_{f}" for f in FEATURES]
    small = [F.col(c).cast("int").alias(c) for c in names]
    loose = staged(_features(loose).select("nid", "h", "base", "kind", "start", "end", *small), "loose")
    # What can't be personal data by its own numbers is a negative too; the rest of the corpus' candidates have no label.
    failing = loose.filter("f_check = 0").select("nid", F.lit(False).alias("own"), *names)
    model, thresholds, report = train(_features(_cases(base)).select("nid", "own", *small).unionByName(failing), precision)
    least = F.lit(float("inf"))
    for kind in KINDS:
        least = F.when(F.col("kind") == kind, F.lit(thresholds[kind])).otherwise(least)
    chosen = loose.withColumn("score", score_column(model, names)).filter(F.col("score") >= least)
    place = ("nid", "h", "base", "kind", "start", "end")
    return base.select(*place), chosen.select(*place), report


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = 0.9) -> DataFrame:
    """Personal data of each whole text: identifier, n_email, n_ip, n_card, n_phone (base matches), ``base_spans`` and
    ``spans`` (arrays of kind, start and end in code points, by kind as listed, then start).

    Base matches always stay. Added are the loose candidates whose score reaches their kind's threshold and which overlap no
    base match; of overlapping ones the first stays, then the longer. Whether a candidate's numbers can be of its kind
    (``_check``) is one of the trees' features and no rule of its own.
    There are no labels of personal data, so trees and thresholds are learned from cases made of all base matches of the
    corpus (``_cases``) and from all candidates that can't be personal data. With fewer than 10 held-back cases of a kind
    nothing of it is added.

    Null text is empty; rows without candidates have empty arrays; repeated rows are found once and each returned; a null
    identifier stays null; an empty table gives an empty result; other columns are ignored. Places come from running sums
    over a document's own candidates; texts are never shuffled.
    """
    rows = docs.select(ident(id_col).alias("nid"), F.coalesce(F.col(text_col), F.lit("")).alias("body")).withColumn("h", F.xxhash64("body"))
    found = staged(candidates(rows), "candidates")
    base, chosen, _ = _learned(found, precision)
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    span = F.struct(number.alias("order"), "start", "end", "kind", "base")
    per_doc = _spans(base.unionByName(chosen)).groupBy("nid", "h").agg(F.array_sort(F.collect_list(span)).alias("all"))
    out = rows.select("nid", "h").join(per_doc, ["nid", "h"], "left")
    every = F.coalesce("all", F.array().cast("array<struct<order:int,start:bigint,end:bigint,kind:string,base:boolean>>"))
    plain = lambda a: F.transform(a, lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))
    out = out.select("nid", F.filter(every, lambda s: s.base).alias("own"), every.alias("all"))
    of_kind = lambda kind: F.size(F.filter("own", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    counts = [of_kind(kind) for kind in KINDS]
    return out.select(unident("nid").alias(id_col), *counts, plain(F.col("own")).alias("base_spans"), plain(F.col("all")).alias("spans"))


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def op10_personal_data(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_personal(docs)
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )

"""Signals in legislative text: direction, outcome, relevance, and the status they propose."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Parts of words that speak against or for a program. They are found anywhere, also inside words.
NEGATIVE = ("sunset", "repeal", "abolish", "abolition", "eliminate", "elimination", "terminate", "termination", "discontinue", "prohibit", "ban", "void", "nullif", "rescind", "revok", "end the")
POSITIVE = ("creat", "establish", "authoriz", "authoris", "licens", "pilot", "allow", "enabl", "expand", "extend", "continu", "renew", "reauthoriz", "regulat", "recogniz", "recognis", "certif", "implement")
#: Phrases and classes of actions that tell the outcome.
ENACTED = ("signed by governor", "chaptered", "enacted", "effective immediately", "approved by governor", "signed into law", "filed with secretary of state", "governor approved", "became law")
ENACTED_CLASSES = ("executive-signature", "became-law", "executive-signed")
FAILED = ("failed", "died", "vetoed", "indefinitely postponed", "withdrawn", "tabled", "adjourned", "recommitted")
LOW, WRITE = 0.3, 0.5  # least relevance for a proposal, and for writing it


def any_in(c: Column, parts: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | c.contains(p)
    return out


def count_in(c: Column, parts: Sequence[str]) -> Column:
    return sum((c.contains(p).cast("int") for p in parts), F.lit(0))


def direction(title: Column, abstract: Column | None = None) -> Column:
    text = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(abstract if abstract is not None else F.lit(""), F.lit(""))))
    against, pro = any_in(text, NEGATIVE), any_in(text, POSITIVE)
    return F.when(against & pro, "neutral").when(against, "negative").when(pro, "positive").otherwise("unknown")


def enacted(action: Column, classes: Column | None = None) -> Column:
    """Without an action nothing is said of it."""
    said = any_in(F.lower(F.coalesce(action, F.lit(""))), ENACTED)
    return said if classes is None else said | F.coalesce(F.arrays_overlap(classes, F.array(*map(F.lit, ENACTED_CLASSES))), F.lit(False))


def failed(action: Column) -> Column:
    return any_in(F.lower(F.coalesce(action, F.lit(""))), FAILED)


def relevance(identifier: Column, title: Column, is_enacted: Column, queries: Column, known: Column) -> Column:
    """0.5 for a known identifier, 0.3 shared by the queries found in the title, 0.2 if enacted; 1 at most."""
    flat = F.replace(F.lower(identifier), F.lit(" "), F.lit(""))
    return scored(F.exists(known, lambda k: flat.contains(F.replace(F.lower(k), F.lit(" "), F.lit("")))), title, is_enacted, queries)


def scored(hit: Column, title: Column, is_enacted: Column, queries: Column) -> Column:
    """``relevance`` where it was found out whether the identifier is known."""
    share = F.size(F.filter(queries, lambda q: F.lower(title).contains(F.lower(q)))) * (0.3 / F.greatest(F.size(queries), F.lit(1)))
    return F.least(F.lit(1.0), F.when(hit, 0.5).otherwise(0.0) + share + F.when(is_enacted, 0.2).otherwise(0.0))


def proposed_status(score: Column, way: Column, is_enacted: Column, has_failed: Column, pending_rules: Column) -> Column:
    return (
        F.when(score < LOW, F.lit(None).cast("string")).when((way == "negative") & is_enacted, "sunset")
        .when((way == "positive") & is_enacted, F.when(pending_rules, "proposed").otherwise("active")).when((way == "positive") & ~has_failed, "proposed")
    )


def proposal_confidence(score: Column, way: Column, is_enacted: Column) -> Column:
    """A pending bill against a program counts 0.4 of its relevance."""
    return F.when((score >= LOW) & (way == "negative") & ~is_enacted, score * 0.4).otherwise(score)


def is_change(current: Column, proposed: Column, sunset: Column) -> Column:
    return F.coalesce(proposed.isNotNull() & (proposed != current), F.lit(False)) | sunset.isNotNull()

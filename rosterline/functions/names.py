"""Names of entities: normal forms, identifiers, parts."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Company suffixes, with and without their dots.
SUFFIXES_DOTTED = r"pllc|l\.l\.c\.|l\.l\.p\.|p\.c\.|llc|llp|ltd|inc|co|pc"
SUFFIXES = "pllc|llc|llp|ltd|inc|co|pc"
#: Fixed values of the Hangul block: first syllable, counts of its middle and last letters, where its three kinds of letters begin.
HANGUL, MIDDLES, LASTS, LETTERS = 0xAC00, 21, 28, (0x1100, 0x1161, 0x11A7)


def _decomposed() -> tuple[str, str]:
    """The characters whose canonical decomposition is another one and marks, and these others, from the Unicode data."""
    marked, plain = [], []
    for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x30000)]):
        rest = [x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn"]
        if len(rest) == 1 and rest[0] != c:
            marked.append(c)
            plain.append(rest[0])
    return "".join(marked), "".join(plain)


MARKED, PLAIN = _decomposed()


def _squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def _letters(syllable: Column) -> Column:
    """A Hangul syllable as its two or three letters; other characters as they are."""
    at = F.conv(F.hex(F.encode(syllable, "UTF-16BE")), 16, 10).cast("int") - HANGUL
    codes = F.concat(
        F.hex(F.lit(LETTERS[0]) + (at / (MIDDLES * LASTS)).cast("int")), F.hex(F.lit(LETTERS[1]) + (at % (MIDDLES * LASTS) / LASTS).cast("int")),
        F.when(at % LASTS > 0, F.hex(F.lit(LETTERS[2]) + at % LASTS)).otherwise(""),
    )
    return F.when(syllable.rlike("^[\uAC00-\uD7A3]$"), F.decode(F.unhex(codes), "UTF-16BE")).otherwise(syllable)


def strip_marks(c: Column) -> Column:
    """Canonical decomposition without non-spacing marks, so composed and decomposed names are alike."""
    plain = F.regexp_replace(F.translate(c, MARKED, PLAIN), r"\p{Mn}+", "")
    return F.when(plain.rlike("[\uAC00-\uD7A3]"), F.array_join(F.transform(F.split(plain, ""), _letters), "")).otherwise(plain)


def normalize_name(c: Column) -> Column:
    """Marks off, lower case, & as 'and', company suffixes off before and after punctuation goes, leading 'the' off."""
    c = F.regexp_replace(F.lower(strip_marks(c)), r"(?U)\s*&\s*", " and ")
    c = F.regexp_replace(c, rf"(?U)(?<!\w)(?:{SUFFIXES_DOTTED})(?!\w)", " ")
    c = _squeeze(F.regexp_replace(c, r"(?U)[^\w\s]", " "))
    c = _squeeze(F.regexp_replace(c, rf"(?U)\b(?:{SUFFIXES})\b", " "))
    return _squeeze(F.regexp_replace(c, r"^the\s+", ""))


def provider_id(prefix: str, program: Column, name: Column) -> Column:
    """prefix_ and 12 hex digits of the hash of the program and the normal name."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(F.concat(program, F.char(F.lit(0)), normalize_name(name)), 256), 1, 12))


def licence_id(prefix: str, c: Column, pattern: str) -> Column:
    """prefix_ and the licence number, null where the pattern does not match."""
    return F.when(c.rlike(pattern), F.concat(F.lit(f"{prefix}_"), F.regexp_extract(c, pattern, 1)))


def event_id(provider: Column, snapshot: Column, kind: Column) -> Column:
    return F.concat(F.lit("evt_"), F.substring(F.sha2(F.concat_ws(":", provider, snapshot, kind), 256), 1, 24))


def snapshot_id(sha: Column) -> Column:
    return F.concat(F.lit("snap_"), F.substring(sha, 1, 16))


def flip_name(c: Column) -> Column:
    """'Last, First' as 'First Last'; others unchanged."""
    parts = F.split(c, ",", 2)
    return F.when(F.contains(c, F.lit(",")), F.trim(F.concat_ws(" ", F.trim(F.get(parts, F.lit(1))), F.trim(F.get(parts, F.lit(0)))))).otherwise(c)


def full_name(first: Column, last: Column) -> Column:
    """'First Last', null where the last name is empty."""
    return F.when(F.trim(last) != "", F.trim(F.concat_ws(" ", F.trim(first), F.trim(last))))


def clean_name(c: Column) -> Column:
    """Without non-breaking spaces, notes on expiry and footnote stars at the end; periods stay."""
    c = F.regexp_replace(F.replace(c, F.lit(" "), F.lit("")), r"(?i)\s*\((?:expired|withdrew|withdrawn)\)\.?\s*", "")
    return F.trim(F.rtrim(c, F.lit("*")))


def short_name(c: Column) -> Column:
    """The first 'Program' off, double spaces single."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"^(.*?)Program", "$1"), "  ", " "))


def alias_names(c: Column) -> Column:
    """Names in parentheses after DBA or Formerly, in order."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"(?i)\((?:d/?b/?a|formerly),?\s+([^)]*)\)"), F.lit(1)), lambda x: F.trim(x))

"""Values out of source text: labels, lists, dates, numbers, links, places."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labels of a licensing roster and the status each stands for.
LABEL_STATUS = {
    "Active": "active", "PRO BONO": "active", "Inactive": "unknown", "Voluntarily Resigned": "exited", "Retired": "exited", "Suspended": "suspended",
    "Revoked": "revoked", "Disbarred": "revoked", "Resigned in Lieu of Discipline": "revoked", "Deceased": "exited", "Terminated": "exited",
}
#: Words of a status label that speak for or against authorisation.
AUTHORIZED = ("authorized", "approved", "participating", "active")
NEGATED = ("not", "under", "pending", "review", "denied", "rejected", "revoked", "withdrawn", "declined", "closed", "inactive", "suspended")
PENDING_LABEL = "under review"
#: Practice areas as written, and as shown. One spelling error is on a source page.
AREAS = {"administrative": "Administrative", "civil": "Civil", "criminal": "Criminal", "criminial": "Criminal", "family": "Family", "juvenile": "Juvenile"}
#: Names of places and their postal codes.
PLACES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO", "connecticut": "CT", "delaware": "DE",
    "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA", "kansas": "KS", "kentucky": "KY",
    "louisiana": "LA", "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI", "minnesota": "MN", "mississippi": "MS", "missouri": "MO",
    "montana": "MT", "nebraska": "NE", "nevada": "NV", "new hampshire": "NH", "new jersey": "NJ", "new mexico": "NM", "new york": "NY",
    "north carolina": "NC", "north dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA", "rhode island": "RI",
    "south carolina": "SC", "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA",
    "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY", "district of columbia": "DC", "washington, d.c.": "DC", "washington d.c.": "DC",
    "puerto rico": "PR", "american samoa": "AS", "guam": "GU", "northern mariana islands": "MP", "u.s. virgin islands": "VI", "virgin islands": "VI",
}
DATE_FORMATS = ("MMM'.' d, yyyy", "MMMM d, yyyy", "MMM d, yyyy")


def lookup(c: Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """The table's value for c; the default, or null, where it has none."""
    found = F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)
    return found if default is None else F.coalesce(found, F.lit(default))


def label_status(c: Column, table: Mapping[str, str], default: str = "unknown") -> Column:
    """Status of a label, compared trimmed and without case."""
    return lookup(F.lower(F.trim(c)), {k.lower(): v for k, v in table.items()}, default)


def label_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("([a-z]+)"), F.lit(1))


def is_authorized(c: Column) -> Column:
    """A label with a positive word and no negative one."""
    tokens = label_tokens(c)
    return ~F.arrays_overlap(tokens, F.array(*map(F.lit, NEGATED))) & F.arrays_overlap(tokens, F.array(*map(F.lit, AUTHORIZED)))


def is_unrecognised(c: Column) -> Column:
    return (F.lower(F.trim(c)) != PENDING_LABEL) & ~is_authorized(c)


def split_list(c: Column, by: str = ",") -> Column:
    """Trimmed items, blanks dropped."""
    return F.filter(F.transform(F.split(c, by), lambda x: F.trim(x)), lambda x: x != "")


def known_items(c: Column, table: Mapping[str, str], by: str = r"(?i),|&|\band\b") -> Column:
    """Items that the table knows, as it shows them, once each, in order."""
    items = F.transform(split_list(c, by), lambda x: lookup(F.lower(x), table))
    return F.array_distinct(F.filter(items, lambda x: x.isNotNull()))


def service_models(c: Column) -> Column:
    """A struct of JSON text and a technology flag, both null if there is no item."""
    items = F.filter(F.transform(F.split(c, ","), lambda x: F.rtrim(F.trim(x), F.lit("."))), lambda x: x != "")
    tech = F.exists(items, lambda x: F.lower(x).contains("software") | F.lower(x).contains("technology"))
    some = F.size(items) > 0
    return F.struct(F.when(some, F.to_json(F.struct(items.alias("service_models")))).alias("ownership"), F.when(some, tech).alias("uses_technology"))


def keyword_flag(c: Column, pattern: str = r"(?i)\bai\b|artificial intelligence|chatbot|machine learning") -> Column:
    """Whether a pattern occurs; null for empty text, since nothing is known then."""
    return F.when(c != "", c.rlike(pattern))


def bullet_cell(c: Column, date_format: str = "MMMM d, yyyy") -> Column:
    """Struct (date, items) of a cell: a first line that may be a date, bullets that start items, other lines that go on."""
    lines = split_list(c, "\n")
    first = F.get(lines, F.lit(0))
    joined = F.array_join(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), " ")
    items = F.transform(F.slice(F.split(joined, "•"), F.lit(2), F.size(F.split(joined, "•"))), lambda x: F.trim(x))
    return F.struct(F.to_date(F.try_to_timestamp(first, F.lit(date_format))).alias("date"), F.filter(items, lambda x: x.isNotNull()).alias("items"))


def first_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The date by the first format that fits, else null."""
    return F.coalesce(*[F.to_date(F.try_to_timestamp(F.trim(c), F.lit(f))) for f in formats])


def tolerant_date(c: Column) -> Column:
    """An ISO date; anything else, as 0000-00-00, is null."""
    return F.try_to_date(c, "yyyy-MM-dd")


def cut_at(c: Column, marker: str) -> Column:
    """What stands before a marker, trimmed."""
    return F.trim(F.substring_index(c, marker, 1))


def first_external_link(html: Column, own_domain: str) -> Column:
    """The first absolute link whose address does not hold the own domain."""
    links = F.regexp_extract_all(html, F.lit(r'href="(https?://[^"]*)"'), F.lit(1))
    return F.get(F.filter(links, lambda x: ~x.contains(own_domain)), F.lit(0))


def place_key(c: Column) -> Column:
    """A place name without what stands in parentheses at its end, trimmed and lower-cased."""
    return F.lower(F.trim(F.regexp_replace(c, r"\s*\([^)]*\)\s*$", "")))


def place_code(df: DataFrame, name_col: str, table: Mapping[str, str] = PLACES, out: str = "code") -> DataFrame:
    """df with the code of a place name, null if unknown. The table is a constant of this module, so it is broadcast."""
    places = df.sparkSession.createDataFrame(list(table.items()), f"_place string, {out} string")
    return df.join(F.broadcast(places), place_key(F.col(name_col)) == F.col("_place"), "left").drop("_place")


def region_code(c: Column) -> Column:
    """Two letters after 'state:' in an id with slashes and colons, else the first two letters, in upper case."""
    found = F.regexp_extract(c, "state:([a-z]{2})", 1)
    return F.upper(F.when(found != "", found).otherwise(F.substring(c, 1, 2)))


def relative_path(c: Column, root: str) -> Column:
    """A path below the root without it; others unchanged."""
    root = root.rstrip("/") + "/"
    return F.when(c.startswith(root), F.right(c, F.length(c) - len(root))).otherwise(c)


def json_text(c: Column) -> Column:
    return F.to_json(c)


def iso_utc(c: Column) -> Column:
    """UTC timestamp text with microseconds and offset."""
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def html_escape(c: Column) -> Column:
    c = F.replace(c, F.lit(" "), F.lit(" "))
    for plain, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def tristate(c: Column) -> Column:
    return F.when(c.isNull(), "Unknown").when(c, "Yes").otherwise("No")


def build_url(base: str, state: Column, session: Column, number: Column) -> Column:
    return F.concat_ws("/", F.lit(base.rstrip("/")), F.lower(state), F.replace(session, F.lit(" "), F.lit("-")), F.replace(number, F.lit(" "), F.lit("")))


def unwrap_url(c: Column, key: str = "d") -> Column:
    """A query parameter of a wrapping link, null if it has none."""
    return F.nullif(F.regexp_extract(c, rf"[?&]{key}=([^&#]*)", 1), F.lit(""))


def search_hit(query: str, *cols: Column) -> Column:
    """Whether the trimmed query is contained in the columns' joined text, without case; all rows for an empty one."""
    q = query.strip().lower()
    return F.lit(True) if not q else F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in cols])).contains(q)

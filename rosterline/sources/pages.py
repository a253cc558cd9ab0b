"""Rows out of pages and texts: tables, list items, links, lines, headings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .markup import html_blocks, html_tables

ROWS_AT_ONCE = 10_000  # fixed value: rows that a parsing task makes before it hands them on


def plain_text(c: Column) -> Column:
    """Markup off, white space single, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), r"\s+", " "))


def extract_html_rows(df: DataFrame, id_col: str, html_col: str, least_cells: int = 1, table: int | None = None) -> DataFrame:
    """(id, row_no, cells): rows of a page's tables, or of one of them by number, as arrays of plain cells; header rows and short ones are dropped."""
    rows = html_tables(df, id_col, html_col).filter(~F.col("is_header") & (F.size("cells") >= least_cells))
    return (rows if table is None else rows.filter(F.col("table_no") == table)).select(id_col, "row_no", "cells")


def named_rows(rows: DataFrame, name: Column, test_accounts: Sequence[str] = ()) -> DataFrame:
    """rows with ``name`` as a column, without scripts that a page leaves in its cell; rows without a name, with '-' or with
    the last name of a test account (before the comma, without case) go."""
    clean = F.trim(F.substring_index(name, "if ('", 1))
    known = [t.lower() for t in test_accounts]
    junk = (clean == "") | (clean == "-") | F.lower(F.trim(F.substring_index(clean, ",", 1))).isin(known)
    return rows.withColumn("name", clean).filter(clean.isNotNull() & ~junk)


def extract_items(df: DataFrame, id_col: str, html_col: str, pattern: str, group: int = 1) -> DataFrame:
    """(id, item_no, item): what a pattern's group holds, in order, as plain text."""
    return df.select(id_col, F.posexplode(F.regexp_extract_all(html_col, F.lit(pattern), F.lit(group))).alias("item_no", "i")).select(id_col, "item_no", plain_text(F.col("i")).alias("item"))


def extract_lines(df: DataFrame, id_col: str, text_col: str, pattern: str, groups: Mapping[str, int]) -> DataFrame:
    """(id, line_no, one column for each group) of the lines that match a pattern."""
    lines = df.select(id_col, F.posexplode(F.split(text_col, "\n")).alias("line_no", "line")).filter(F.col("line").rlike(pattern))
    return lines.select(id_col, "line_no", *[F.regexp_extract("line", pattern, g).alias(name) for name, g in groups.items()])


def carry_forward(df: DataFrame, doc: str, order: str, values: Mapping[str, Column], reset: Column | None = None) -> DataFrame:
    """df with the last known value of each column so far in its document; ``reset`` rows forget the ones before them."""
    by = Window.partitionBy(doc).orderBy(order)
    out = df if reset is None else df.withColumn("_run", F.sum(F.when(reset, 1).otherwise(0)).over(by))
    run = Window.partitionBy(doc, *([] if reset is None else ["_run"])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return out.select(*df.columns, *[F.last(c, ignorenulls=True).over(run).alias(name) for name, c in values.items()])


def heading_inventory(df: DataFrame, doc: str, html_col: str) -> DataFrame:
    """(doc, pos, model_type, bucket, region, item): items of a page under its h2, h3 and h4; region is Domestic until one is named."""
    tags = html_blocks(df, doc, html_col).filter(F.col("tag").isin("h2", "h3", "h4", "li"))
    of = lambda tag: F.when(F.col("tag") == tag, F.col("text"))
    out = carry_forward(tags, doc, "pos", {"model_type": of("h2"), "bucket": of("h3"), "region": of("h4")}, F.col("tag") == "h2")
    return out.filter("tag = 'li' and model_type is not null").select(doc, "pos", "model_type", "bucket", F.coalesce("region", F.lit("Domestic")).alias("region"), F.col("text").alias("item"))


def _whole(parse: Callable[[bytes], Iterable[dict]], data: bytes, values: Callable[[dict], tuple]) -> Iterable[tuple]:
    """``values`` of each row that ``parse`` gives. An error in any row is raised here, before one is handed on: of more than
    ROWS_AT_ONCE rows none is held, a list is gone through twice and a generator is run twice."""
    made = parse(data)
    rows = iter(made)
    first = [values(r) for r in islice(rows, ROWS_AT_ONCE)]
    if len(first) < ROWS_AT_ONCE:
        return first
    for r in rows:
        values(r)
    return map(values, parse(data) if made is rows else made)


def parse_captures(
    captures: DataFrame, parsers: Mapping[str, Callable[[bytes], Iterable[dict]]], fields: str, program: str = "program_id", key: str = "capture_id", content: str = "content", partial: Sequence[str] = (),
    problem: str | None = None,
) -> DataFrame:
    """Rows (program, key, row_no, fields..., error, is_partial) by the user's function for each program.

    Programs in ``partial`` have functions that see only the first page of a roster; their rows say so.

    A capture whose function fails gives one row with the error, one without rows gives one with 'no rows'; other captures
    go on. Where the column ``problem`` says what is wrong with a capture, such as bytes that are not the registered ones,
    it isn't parsed and that is its error. Captures are parsed where they are: no shuffle.

    A task hands its rows on ROWS_AT_ONCE at a time. A function that returns a list holds a capture's rows; a generator
    doesn't, but is run twice on captures of many rows and has to give the same ones again.
    """
    names = [f.split()[0] for f in fields.split(", ")]
    schema = f"{program} string, {key} string, row_no int, {fields}, error string"
    columns = [program, key, "row_no", *names, "error"]
    failed = lambda why: [(None, *[None] * len(names), why)]

    def read(p: str, data: bytes, wrong: str | None) -> Iterable[tuple]:
        if wrong is not None:
            return failed(wrong)
        try:
            rows = _whole(parsers[p], bytes(data), lambda r: tuple(r.get(n) for n in names))
        except Exception as e:  # a user's function may fail in any way; the capture is reported
            return failed(f"{type(e).__name__}: {e}")
        return ((i, *row, None) for i, row in enumerate(rows)) if rows else failed("no rows")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = ((p, str(k), *row) for p, k, data, wrong in zip(frame[program], frame[key], frame[content], frame["_problem"]) for row in read(p, data, wrong))
            while out := list(islice(rows, ROWS_AT_ONCE)):
                yield pd.DataFrame(out, columns=columns)

    wrong = F.col(problem) if problem else F.lit(None).cast("string")
    rows = captures.select(program, F.col(key).cast("string").alias(key), content, wrong.alias("_problem")).mapInPandas(run, schema)
    return rows.withColumn("is_partial", F.col(program).isin(list(partial)))

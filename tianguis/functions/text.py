"""Text: cells and labels."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unescape(text: Column) -> Column:
    """HTML entities to characters, in Arrow batches: Spark has no expression for the named ones."""

    @F.pandas_udf("string")
    def entities(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import html

        for s in batches:
            yield s.map(html.unescape, na_action="ignore")

    return entities(text)


#: Marks that HTML can't hold: between cells and between rows.
CELL_END, ROW_END = "\u0001", "\u0002"


def decoded_page(page: Column, table: str, row: str, cell: str) -> Column:
    """A page (plain, table, has), entities decoded: the text around its table, the table's cells without tags within the marks
    above, as ``squeezed`` gives them (null if there are none), and whether there is a table.

    ``table``, ``row`` and ``cell`` are patterns: an opening tag, ``(.*?)`` for what they hold, and a closing tag.  One crossing to Python a page,
    in Arrow batches, as text both ways: nested lists take most of such a crossing's time, and ``table_cells`` takes
    the table apart.  It counts as non-deterministic, so that no filter above is pushed below it with a second call.
    """
    opens, closes = zip(*[p.split("(.*?)") for p in (table, row, cell)])

    @F.pandas_udf("plain string, table string, has boolean")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import html
        import re

        # white space, letters and word boundaries are ASCII's, as in Spark's patterns
        whole, rows, cells = (re.compile(p, re.ASCII) for p in (table, row, cell))
        tags, runs = re.compile("<[^>]*>"), re.compile("[ \t\n\x0b\f\r\u00a0]+")
        # lazy patterns try their end at every character; where tags are in lower case and in step, cutting at closing tags finds the same
        shouted, spread = re.compile("</?(?:T|t[a-z]*[A-Z])"), re.compile("[\t\n\x0b\f\r\u00a0]")
        (table_open, row_open, cell_open), (table_close, row_close, cell_close) = [re.compile(p, re.ASCII) for p in opens], closes
        plain_cells, cell_start = re.compile(f"{cell_open.pattern}([^<]*){cell_close}", re.ASCII), f"<{cell_close[2:-1]}"

        def table_of(text, quiet):
            if not quiet:
                found = whole.search(text)
                return found and found[0]
            found = table_open.search(text)
            end = text.find(table_close, found.end()) if found else -1
            return text[found.start() : end + len(table_close)] if end >= 0 else None

        def rows_of(text, quiet):
            out = []
            for part in text.split(row_close)[:-1] if quiet else ():
                found = row_open.search(part)
                if not found:
                    return rows.findall(text)
                out.append(part[found.end() :])
            return out if quiet else rows.findall(text)

        def cells_of(text, quiet):
            if quiet:
                found = plain_cells.findall(text)
                if len(found) == text.count(cell_start) == text.count(cell_close):
                    return found
            return [tags.sub("", c) if "<" in c else c for c in cells.findall(text)]

        def held(text, quiet):
            # a tag never crosses a mark, as each cell is freed of its own
            flat = ROW_END.join([CELL_END.join(cells_of(r, quiet)) for r in rows_of(text, quiet)])
            if not flat:
                return None
            flat = html.unescape(flat)
            if "  " in flat or spread.search(flat):
                flat = runs.sub(" ", flat)
            for mark in (CELL_END, ROW_END):
                flat = flat.replace(" " + mark, mark).replace(mark + " ", mark)
            return flat.strip(" ")

        def one(text):
            if text is None:
                return None, None, False
            quiet = not shouted.search(text)
            found = table_of(text, quiet)
            if found is None:
                return html.unescape(text), None, False
            return html.unescape(text.replace(found, " ")), held(found, quiet), True

        for s in batches:
            yield pd.DataFrame([one(x) for x in s], columns=["plain", "table", "has"])

    return decode.asNondeterministic()(page)


def table_cells(marked: Column) -> Column:
    """The rows of a table of ``decoded_page``, each an array of cells, blank ones null; null has no rows."""
    rows = F.transform(F.split(marked, ROW_END), lambda r: F.transform(F.split(r, CELL_END), lambda c: F.nullif(c, F.lit(""))))
    return F.coalesce(rows, F.array().cast("array<array<string>>"))


def squeezed(text: Column) -> Column:
    """White-space runs, no-break spaces among them, to one space; trimmed; blank to null."""
    return F.nullif(F.trim(F.regexp_replace(text, r"[\s\u00a0]+", " ")), F.lit(""))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def split_at_last_dash(label: Column) -> tuple[Column, Column]:
    """Name and quality around the last `` - ``; null without one."""
    part = lambda i: F.nullif(F.trim(F.regexp_extract(label, "^(.*) - (.*)$", i)), F.lit(""))
    return part(1), part(2)


def split_at_colon(label: Column, aliases: dict[str, str]) -> tuple[Column, Column]:
    """State and market around the first colon, some states renamed; null without a market."""
    state = F.trim(F.regexp_extract(label, "^([^:]*):(.*)$", 1))
    market = F.nullif(F.trim(F.regexp_extract(label, "^([^:]*):(.*)$", 2)), F.lit(""))
    for old, new in aliases.items():
        state = F.when(state == old, F.lit(new)).otherwise(state)
    return F.nullif(state, F.lit("")), market

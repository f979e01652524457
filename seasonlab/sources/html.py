"""Rows from stored web pages."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# The largest spans of a cell in the HTML standard.
MOST_COLUMNS = 1000
MOST_ROWS = 65534


# Tags without doubt: an end tag without attributes, or a start tag whose attributes are single words
# or quoted. Elements whose text isn't markup, as in a script, are left out.
_SPACE = r"[ \t\n\r\f]"
_ATTRIBUTE = r"""[^\s"'<>/=`\x00]+(?:=(?:"[^"]*"|'[^']*'|[^\s"'<>/=`\x00]+))?"""
_RAW = "(?i:script|style|textarea|title|xmp|iframe|noembed|noframes|noscript|plaintext)(?![a-zA-Z0-9])"
_TAG = re.compile(rf"<(?:/([a-zA-Z][a-zA-Z0-9]*){_SPACE}*|(?!{_RAW})([a-zA-Z][a-zA-Z0-9]*)((?:{_SPACE}+{_ATTRIBUTE})*{_SPACE}*/?))>")
_VALUE = re.compile(r"""([^\s=]+)(?:=("[^"]*"|'[^']*'|[^\s"']+))?""")


class _LinkReader(HTMLParser):
    """Collects address and text of every link, whatever its other attributes and markup."""

    def __init__(self) -> None:
        super().__init__()
        self.links: list[list[str]] = []
        self.open = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "a":
            href = dict(attrs).get("href")
            self.open = href is not None
            if self.open:
                self.links.append([href, ""])

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.open = False

    def handle_data(self, data: str) -> None:
        if self.open:
            self.links[-1][1] += data


def page_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Address and text of every link, in page order."""
    kind = pages.schema[key].dataType.simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page, text in zip(batch["page"], batch["html"]):
                reader = _LinkReader()
                reader.feed(text or "")
                reader.close()
                out += [(page, place, *link) for place, link in enumerate(reader.links)]
            yield pd.DataFrame(out, columns=["page", "place", "href", "label"])

    rows = pages.select(F.col(key).alias("page"), F.col(html).alias("html"))
    return rows.mapInPandas(read, f"page {kind}, place int, href string, label string").withColumnRenamed("page", key)


class _TableReader(HTMLParser):
    """Collects the rows of the first table with an id, and counts the tables that have it; looks at ``tags`` alone.

    A row is its cells, the marker attribute and whether it has header cells alone. A cell
    that spans columns or rows stands in each of them.
    """

    def __init__(self, table_id: str, marker: str, tags: frozenset[str]) -> None:
        super().__init__()
        self.table_id, self.marker, self.tags = table_id, marker, tags
        self.tables, self.depth, self.cell = 0, 0, False
        self.rows: list[list] = []
        self.below: dict[int, tuple[int, list]] = {}  # place: rows still to come, text

    def read(self, text: str) -> bool:
        """Read a whole page of tags without doubt, as the general parser would, in a fraction of its time.

        False if some markup is of another kind; the page is then read by a new reader's ``feed``.
        """
        parts = _TAG.split(text)
        if "<" in "".join(parts[::4]):
            return False
        for end, start, attrs, data in zip(parts[1::4], parts[2::4], parts[3::4], parts[4::4]):
            if start is None:
                if self.depth and (tag := end.lower()) in self.tags:
                    self.handle_endtag(tag)
            elif (tag := start.lower()) in self.tags and (self.depth or tag == "table"):
                if not attrs:
                    self.handle_starttag(tag, ())
                elif "&" in attrs or attrs[-1] == "/":
                    return False
                else:
                    self.handle_starttag(tag, [(name.lower(), _bare(value)) for name, value in _VALUE.findall(attrs)])
            if data and self.cell:
                self.handle_data(unescape(data) if "&" in data else data)
        return True

    def handle_starttag(self, tag: str, attrs: Sequence) -> None:
        values = dict(attrs)
        if tag not in self.tags:
            return
        if tag == "table":
            if self.depth:
                self.depth += 1
            elif values.get("id") == self.table_id:
                self.tables += 1
                self.depth = int(self.tables == 1)
        elif self.depth == 1 and tag == "tr":
            self._end_row()
            self.rows.append([[], None, True])
            if self.below:
                self._spanned()
        elif self.depth == 1 and tag in ("td", "th") and self.rows:
            row = self.rows[-1]
            text = [""]
            down = _span(values.get("rowspan"), MOST_ROWS) - 1 if values else 0
            for _ in range(_span(values.get("colspan"), MOST_COLUMNS) if values else 1):
                if down > 0:
                    self.below[len(row[0])] = (down, text)
                row[0].append(text)
            row[1] = row[1] or values.get(self.marker)
            row[2] = row[2] and tag == "th"
            self.cell = True

    def _spanned(self) -> None:
        """Cells that reach into the row at its end so far."""
        cells = self.rows[-1][0]
        while (found := self.below.pop(len(cells), None)) is not None:
            down, text = found
            if down > 1:
                self.below[len(cells)] = (down - 1, text)
            cells.append(text)

    def _end_row(self) -> None:
        self.cell = False
        if self.below:
            self._spanned()

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.depth:
            self.depth -= 1
        elif self.depth == 1 and tag in ("td", "th"):
            self.cell = False
            if self.below:
                self._spanned()
        elif self.depth == 1 and tag == "tr":
            self._end_row()

    def handle_data(self, data: str) -> None:
        if self.cell and self.depth == 1:
            self.rows[-1][0][-1][0] += data


def _bare(value: str) -> str | None:
    """An attribute's value as written, without its quotes; None if it has none."""
    return value[1:-1] if value[:1] in ("'", '"') else value or None


def _span(value: str | None, most: int) -> int:
    """A cell's span as the HTML standard reads it: 1 unless it is a number above 0, ``most`` at the utmost."""
    if not value or not value.isascii() or not value.isdigit():
        return 1
    return most if len(value) > 9 else min(max(1, int(value)), most)


ALONE = frozenset(["table"])
TAGS = ALONE | {"tr", "td", "th"}


def _read_table(text: str | None, table_id: str, marker: str, tags: frozenset[str] = TAGS) -> _TableReader:
    reader = _TableReader(table_id, marker, tags)
    if not reader.read(text or ""):
        reader = _TableReader(table_id, marker, tags)
        reader.feed(text)
        reader.close()
    return reader


def table_counts(pages: DataFrame, table_id: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """How many tables with the given id each page has; a well-formed page has one."""
    kind = pages.schema[key].dataType.simpleString()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = [_read_table(text, table_id, "", ALONE).tables for text in batch["html"]]
            yield pd.DataFrame({"page": batch["page"], "n": n})

    rows = pages.select(F.col(key).alias("page"), F.col(html).alias("html"))
    return rows.mapInPandas(count, f"page {kind}, n int").withColumnRenamed("page", key)


def page_tables(pages: DataFrame, table_id: str, columns: list[str], key: str = "page_id", html: str = "html", marker: str = "data-append-csv") -> DataFrame:
    """Rows of the table with the given id on every page, as text, with the value of
    the marker attribute. Rows of header cells alone are dropped, as is a repeated
    header; cells beyond the declared columns are in the array ``extra``."""
    kind = pages.schema[key].dataType.simpleString()
    schema = ", ".join([f"page {kind}", "place int", "ref string", *[f"`{c}` string" for c in columns], "extra array<string>"])
    header, width = list(columns), len(columns)

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [pa.int64(), pa.int32(), *[pa.string()] * (1 + width), pa.list_(pa.string())]
        for batch in batches:
            out = []
            for at, text in enumerate(batch.column(1).to_pylist()):
                place = 0
                for cells, ref, headers_only in _read_table(text, table_id, marker).rows:
                    cells = [c[0].strip() for c in cells]
                    if not cells or headers_only or cells == header:
                        continue
                    padded = cells[:width] + [None] * (width - len(cells))
                    out.append((at, place, ref, *padded, cells[width:] or None))
                    place += 1
            at, *values = [pa.array(c, type=t) for c, t in zip(zip(*out) if out else [()] * len(types), types)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *values], names=["page", "place", "ref", *header, "extra"])

    rows = pages.select(F.col(key).alias("page"), F.col(html).alias("html"))
    return rows.mapInArrow(read, schema).withColumnRenamed("page", key)

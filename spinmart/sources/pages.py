"""Table rows out of stored HTML pages: all pages of a crawl are rows of one DataFrame."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A character reference, or a stretch without one.
PIECE = r"(?s)&(?:#[0-9]{1,9}|#[xX][0-9a-fA-F]{1,8}|[A-Za-z][A-Za-z0-9]*);?|[^&]+|&"
LAST_CHARACTER = 0x10FFFF


def _named_references() -> Column:
    """The standard library's table of named references as one map, made of one text when the plan is optimised."""
    return F.from_json(F.lit(json.dumps(html5)), "map<string, string>")


def _numbered_reference(number: Column) -> Column:
    """The character of a code point; 128 to 159 are read as Windows letters, as browsers do."""
    windows = {n: bytes([n]).decode("cp1252", "replace") for n in range(128, 160)}
    letters = F.create_map(*[F.lit(x) for n, c in windows.items() if c != "\ufffd" for x in (n, c)])
    plain = F.decode(F.unhex(F.lpad(F.hex(number), 8, F.lit("0"))), "UTF-32")
    none = number.isNull() | (number == 0) | (number > LAST_CHARACTER) | number.between(0xD800, 0xDFFF)
    return (F.when(none, "\ufffd").when(number.between(128, 159), F.coalesce(
        F.try_element_at(letters, number.cast("int")), plain)).otherwise(plain))


def decode_references(text: Column) -> Column:
    """Character references, numbered and named, as the characters they stand for; others stay as they are."""
    def read(piece: Column) -> Column:
        bare = F.regexp_replace(piece, ";$", "")
        return (
            F.when(piece.rlike("^&#[0-9]"), _numbered_reference(F.substring(bare, 3, 9).cast("bigint")))
            .when(piece.rlike("^&#[xX][0-9a-fA-F]"), _numbered_reference(
                F.conv(F.substring(bare, 4, 8), 16, 10).cast("bigint")))
            .when(piece.rlike("^&[A-Za-z]"), F.coalesce(F.try_element_at(_named_references(), F.substring(
                piece, 2, 2_147_483_647)), piece))
            .otherwise(piece))

    pieces = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, read), "")).otherwise(text)


def _elements(html: Column, tag: str, *ends: str) -> Column:
    """Inner HTML of every ``tag`` element, for elements that do not hold one of their own kind.

    An end tag may be left out: the next ``tag``, or a start or end of one of ``ends``, ends the element too.
    """
    stop = "|".join([rf"</?{name}(?:\s[^>]*)?>" for name in (tag, *ends)])
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)(?={stop}|\z)"), F.lit(1))


def _plain_text(html: Column) -> Column:
    """Text as a reader sees it: white space runs as one space, a line break tag as a line break."""
    text = F.regexp_replace(html, r"[\s\u00a0]+", " ")
    text = F.regexp_replace(text, r"(?i)<br\s*/?>", "\n")
    text = decode_references(F.regexp_replace(text, r"<[^>]*>", ""))
    text = F.regexp_replace(F.regexp_replace(text, r"[ \t\u00a0]+", " "), r" ?\n ?", "\n")
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def html_rows(pages: DataFrame, row_tag: str = "tr", cell_tag: str = "td") -> DataFrame:
    """(page_id, pos, cells) for every row with cells, by expressions only.

    For tables without nested rows. End tags of rows and cells may be left out; scripts, styles and comments hold no
    rows and no text. ``(page_id, pos)`` is the order of the crawl.
    """
    markup = F.regexp_replace("html", r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>", "")
    return (
        pages.select("page_id", F.posexplode(_elements(markup, row_tag, "table")).alias("pos", "_row"))
        .select("page_id", "pos", F.transform(_elements(F.col("_row"), cell_tag), _plain_text).alias("cells"))
        .where(F.size("cells") > 0)
    )


class _RowParser(HTMLParser):
    """Collects, for each row in document order, the texts of all cells below it.

    End tags of rows and cells may be left out, as HTML allows: a new cell ends the one before it,
    and a new row ends the row before it unless a table was opened in between.
    """

    def __init__(self, table_tag: str | None, row_tag: str, cell_tag: str):
        super().__init__()
        self.table_tag, self.row_tag, self.cell_tag = table_tag, row_tag, cell_tag
        self.rows: list[list[list[str]]] = []
        self.open: list[tuple[str, list]] = []
        self.hidden = False

    def _close(self, *tags: str) -> None:
        """Close the innermost element of ``tags`` with all inside it, within the current table."""
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] in tags:
                del self.open[at:]
                return
            if self.open[at][0] == self.table_tag:
                return

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.hidden = True
        elif tag == "br":
            self.handle_data("\0")
        elif tag == self.table_tag:
            self.open.append((tag, []))
        elif tag == self.row_tag:
            if self.table_tag:
                self._close(self.row_tag)
            row: list[list[str]] = []
            self.rows.append(row)
            self.open.append((tag, row))
        elif tag == self.cell_tag:
            if self.open and self.open[-1][0] == tag:
                self.open.pop()
            cell: list[str] = []
            for kind, row in self.open:
                if kind == self.row_tag:
                    row.append(cell)
            self.open.append((tag, cell))

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = False
        elif tag == self.table_tag:
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at][0] == tag:
                    del self.open[at:]
                    break
        elif tag in (self.row_tag, self.cell_tag):
            self._close(tag)

    def handle_data(self, data):
        if not self.hidden:
            for kind, cell in self.open:
                if kind == self.cell_tag:
                    cell.append(data)

    def texts(self) -> Iterator[tuple[int, list[str]]]:
        for pos, row in enumerate(self.rows):
            if row:
                yield pos, ["\n".join(" ".join(line.split()) for line in "".join(cell).split("\0")).strip()
                            for cell in row]


def html_rows_nested(pages: DataFrame, row_tag: str = "tr", cell_tag: str = "td",
                     table_tag: str | None = "table") -> DataFrame:
    """As ``html_rows``, for tables nested in one another: a row also lists the cells of its inner
    rows, and an inner row follows the row around it. All character references are read."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page_ids, positions, cells = [], [], []
            for page_id, html in zip(batch["page_id"].to_pylist(), batch["html"].to_pylist()):
                parser = _RowParser(table_tag, row_tag, cell_tag)
                parser.feed(html or "")
                parser.close()
                for pos, texts in parser.texts():
                    page_ids.append(page_id)
                    positions.append(pos)
                    cells.append(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(page_ids, pa.int64()), pa.array(positions, pa.int32()),
                 pa.array(cells, pa.list_(pa.string()))],
                names=["page_id", "pos", "cells"],
            )

    return pages.select("page_id", "html").mapInArrow(parse, "page_id bigint, pos int, cells array<string>")


def cells_to_columns(rows: DataFrame, positions: dict[str, int]) -> DataFrame:
    """Pick cells by position and name them; a short row gives NULL."""
    return rows.select("page_id", "pos", *[F.get("cells", F.lit(i)).alias(n) for n, i in positions.items()])


# The parser goes to the workers inside the task, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Readable text of HTML: a small stdlib parser per row, the clean-up as Spark expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv

_SILENT = {"head", "script", "style", "template", "noscript"}
_BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "dd", "details", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "li", "main",
    "nav", "ol", "p", "pre", "section", "summary", "table", "tr", "ul",
}
_ONE_BREAK = {"li", "tr", "dt", "dd"}


class _TextParser(HTMLParser):
    """Collects visible text; blocks are set apart by blank lines, table cells by '| '."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.silent = 0
        self.preformatted = 0
        self.cell_in_row = 0

    def _break(self, tag: str) -> None:
        self.parts.append("\n" if tag in _ONE_BREAK else "\n\n")

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            # The end tag of the head, and those of what stands in it, may be left out.
            self.silent = 0
        if tag in _SILENT:
            self.silent += 1
        elif tag == "br":
            self.parts.append("\n")
        elif tag == "hr":
            self.parts.append("\n\n* * *\n\n")
        elif tag in ("td", "th"):
            if self.cell_in_row:
                self.parts.append("| ")
            self.cell_in_row += 1
        elif tag in _BLOCKS:
            if tag == "tr":
                self.cell_in_row = 0
            if tag == "pre":
                self.preformatted += 1
            self._break(tag)

    def handle_startendtag(self, tag, attrs):
        if tag in ("br", "hr"):
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in _BLOCKS:
            if tag == "pre":
                self.preformatted = max(0, self.preformatted - 1)
            self._break(tag)

    def handle_data(self, data):
        if self.silent:
            return
        if self.preformatted:
            self.parts.append(data)
            return
        words = " ".join(data.split())
        if not words:
            self.parts.append(" " if data else "")
            return
        before = " " if data[0].isspace() else ""
        after = " " if data[-1].isspace() else ""
        self.parts.append(before + words + after)


def html_to_text(html: str) -> str:
    parser = _TextParser()
    parser.feed(html)
    parser.close()
    return "".join(parser.parts)


#: Rows that a worker holds as Python texts at a time.
_ROWS_AT_A_TIME = 100


def html_text_mapper(
    convert: Callable[[str], str] = html_to_text, html_col: str = "html"
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``raw_text`` and ``error``; a row that fails has no text and a message.

    A batch stays in Arrow's buffers; a few rows of it at a time become Python texts and
    go back, so that a worker's memory does not grow with the rows of a batch.
    """

    def one(html) -> tuple[str | None, str | None]:
        try:
            # a missing document reads "None", as text of a missing value does
            return convert(str(html)), None
        except Exception as problem:
            return None, f"{type(problem).__name__}: {problem}"

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS_AT_A_TIME):
                rows = batch.slice(start, _ROWS_AT_A_TIME)
                results = [one(html.as_py()) for html in rows.column(html_col)]
                texts = pa.array([text for text, _ in results], pa.string())
                errors = pa.array([error for _, error in results], pa.string())
                yield pa.RecordBatch.from_arrays([*rows.columns, texts, errors], [*rows.schema.names, "raw_text", "error"])

    return mapper


def clean_text(raw: Column | str) -> Column:
    """The clean-up rules in their order, then the outer white space."""
    text = F.col(raw) if isinstance(raw, str) else raw
    for pattern, replacement in fv.TEXT_RULES:
        # (?U): white space as in Unicode, not in ASCII alone
        text = F.regexp_replace(text, F.lit("(?U)" + pattern), F.lit(replacement))
    return F.regexp_replace(text, F.lit(r"(?U)^\s+|\s+$"), F.lit(""))


def text_md5(text: Column | str) -> Column:
    """md5 of the text; null for null and empty texts."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(F.length(text) > 0, F.md5(text))

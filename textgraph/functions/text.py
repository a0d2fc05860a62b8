"""Column expressions over text: tokenizers, PMI score, result snippets, output formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns, record terminators and the snippet widths.
ALPHA_TOKEN = "[A-Za-z]+"
BLANKS = r"\s+"
# Line breaks besides the last, in the order in which they become one.
LINE_BREAKS = ("\r\n", "\r")
SNIPPET_WHOLE_BELOW = 82
SNIPPET_WIDTH = 80


def alpha_tokens(text: Column) -> Column:
    """Every run of ASCII letters, case kept."""
    return F.regexp_extract_all(text, F.lit(ALPHA_TOKEN), F.lit(0))


def ws_tokens(text: Column) -> Column:
    """Blank-separated tokens; the empty token before a leading blank is dropped."""
    return F.filter(F.split(text, BLANKS), lambda token: token != "")


def lines_in(text: Column) -> Column:
    """The lines of a text, blank ones included; a final line break opens no further line.

    All breaks become one character first, at which a text is split much faster than at a pattern.
    """
    for mark in LINE_BREAKS:
        text = F.replace(text, F.lit(mark), F.lit("\n"))
    lines = F.split(text, "\n")
    return F.when(F.endswith(text, F.lit("\n")), F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)


def pmi_score(n: Column, df_x: Column, df_y: Column, lines: Column) -> Column:
    """log10 of the observed over the expected number of lines holding both words."""
    return F.log10(n.cast("double") * lines / (df_x.cast("double") * df_y))


def snippet(line: Column) -> Column:
    """A short line as it is; of a long one the first 80 characters, control characters and blanks trimmed."""
    head = F.substring(line, 1, SNIPPET_WIDTH)
    trimmed = F.regexp_replace(head, r"^[\x00-\x20]+|[\x00-\x20]+\z", "")
    return F.when(F.length(line) < SNIPPET_WHOLE_BELOW, line).otherwise(trimmed)


def tab_joined(columns: list[Column]) -> Column:
    """Fields of an output line; a null is an empty field."""
    return F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def tuple_text(columns: list[Column]) -> Column:
    """``(a,b)`` text of a row."""
    return F.concat(F.lit("("), F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("null")) for c in columns]), F.lit(")"))


def score_text(p: Column, node: Column) -> Column:
    """``0.38841 9470136``: probability with five decimals, then the node."""
    return F.format_string("%.5f %d", p, node)

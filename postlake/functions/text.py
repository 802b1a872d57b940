"""Text columns: blank trimming, labels, slugs and plain text from HTML."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions import markup

# The characters that count as blank space around and inside a field.
BLANK_CODES = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BLANKS = "".join(map(chr, BLANK_CODES))
BLANK_RUN = "[" + "".join(f"\\x{{{code:x}}}" for code in BLANK_CODES) + "]+"


def non_empty(text: Column) -> Column:
    """The text, or NULL where it is empty."""
    return F.nullif(text, F.lit(""))


def clean(text: Column) -> Column:
    """Trim Unicode blanks; empty becomes NULL."""
    return non_empty(F.trim(text, F.lit(BLANKS)))


def squeeze(text: Column) -> Column:
    """Collapse every run of blanks to one space and trim."""
    return F.trim(F.regexp_replace(text, BLANK_RUN, " "))


def humanize(text: Column) -> Column:
    """``full_time`` / ``full-time`` / ``fullTime`` -> ``Full Time``."""
    spaced = F.regexp_replace(F.translate(text, "-_", "  "), "([a-z0-9])([A-Z])", "$1 $2")
    return F.initcap(squeeze(spaced))


def slugify(text: Column) -> Column:
    """Lower-cased text with blank runs replaced by a hyphen."""
    return F.regexp_replace(F.lower(F.trim(text, F.lit(BLANKS))), BLANK_RUN, "-")


@F.pandas_udf(T.StringType())
def html_text(html: pd.Series) -> pd.Series:
    """Readable text of an HTML fragment, one line per text node, blanks collapsed."""
    return html.map(markup.plain_text, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def text_lines(html: pd.Series) -> pd.Series:
    """Trimmed non-empty text lines of a page, inner blanks kept."""
    return html.map(markup.lines, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def html_texts(fragments: pd.Series) -> pd.Series:
    """``html_text`` of every fragment of an array."""
    return fragments.map(lambda parts: [None if p is None else markup.plain_text(p) for p in parts], na_action="ignore")


@F.pandas_udf(T.StructType([T.StructField("lines", T.ArrayType(T.StringType())), T.StructField("meta", T.StringType())]))
def lines_and_meta(html: pd.Series) -> pd.DataFrame:
    """Text lines of a page and the content of its ``description`` meta element."""
    lines = html.map(markup.lines, na_action="ignore")
    return pd.DataFrame({"lines": lines, "meta": html.map(markup.meta_description, na_action="ignore")}, index=html.index)


def sections(*parts: tuple[str | None, Column]) -> Column:
    """Join ``(heading, text)`` parts by a blank line, leaving out the empty ones."""
    texts = [text if heading is None else F.concat(F.lit(heading + "\n"), text) for heading, text in parts]
    return non_empty(F.concat_ws("\n\n", *texts))

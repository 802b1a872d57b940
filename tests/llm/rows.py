"""Small tables with the odd cases every operator must take."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD_TEXTS = [None, "", " ", "\n\n", "a", "one two three", "Ünïcode ÉÀ ß 日本語 \U0001f600 done", "x" * 3000, "word " * 4000, "tab\there\r\nand \x0b there\x0c"]


def documents(spark, texts, start=0, more=()):
    rows = [(start + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, *more], SCHEMA)


def odd(spark, extra_column=None):
    """Odd texts, a NULL id, repeated rows, one id with two texts, and perhaps a column that clashes with a result's."""
    more = [(None, "text without an id, long enough", None, None, None), (7, "x" * 3000, "en", "s", 3000), (4, "another text under the id 4", "en", "s", 27)]
    docs = documents(spark, ODD_TEXTS, more=more)
    return docs if extra_column is None else docs.selectExpr("*", f"'mine' AS {extra_column}")


N_ODD = len(ODD_TEXTS) + 3

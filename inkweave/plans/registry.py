"""Where the corpus queries and their SQL are named."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from inkweave.functions import text as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Tables with each key once, as SQL.
ONCE = """
b AS (SELECT DISTINCT ON (vol, id) * FROM han_boxes), h AS (SELECT DISTINCT ON (vol, id) * FROM han_sentences),
v AS (SELECT DISTINCT ON (vol, id) * FROM vi_sentences)"""
CJK_SQL = "[\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}\\x{F900}-\\x{FAFF}\\x{20000}-\\x{2A6DF}\\x{2A700}-\\x{2EBEF}\\x{2F800}-\\x{2FA1F}]"


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql.replace("$ONCE", ONCE).replace("$VI", T.VI_LETTERS).replace("$MARKED", T.VI_MARKED).replace("$CJK", CJK_SQL)
        return f

    return add

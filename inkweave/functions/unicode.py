"""Unicode normal forms inside the JVM.

Spark has no ``normalize`` function, but it ships ICU, whose static methods the SQL function
``java_method`` can call; so no row has to travel to Python to be composed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Format characters, variation selectors and other characters without a mark of their own.
IGNORABLE = (
    r"[\p{Cf}\x{034F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{3164}\x{FE00}-\x{FE0F}"
    r"\x{FFA0}\x{E0100}-\x{E01EF}]"
)


def _icu(method: str, text: Column, compatibility: bool) -> Column:
    called = F.call_function(
        "java_method", F.lit("com.ibm.icu.text.Normalizer"), F.lit(method), F.coalesce(text, F.lit("")), F.lit(compatibility)
    )
    return F.when(text.isNotNull(), called)


def nfc(text: Column) -> Column:
    """Canonical composition; null stays null."""
    return _icu("compose", text, False)


def nfd(text: Column) -> Column:
    """Canonical decomposition; null stays null."""
    return _icu("decompose", text, False)


def nfkc(text: Column) -> Column:
    """Compatibility composition; null stays null."""
    return _icu("compose", text, True)


def nfkd(text: Column) -> Column:
    """Compatibility decomposition; null stays null."""
    return _icu("decompose", text, True)


def strip_ignorable(text: Column) -> Column:
    """Without zero-width, soft-hyphen, joiner and variation-selector characters."""
    return F.regexp_replace(text, IGNORABLE, "")


def trim_space(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")

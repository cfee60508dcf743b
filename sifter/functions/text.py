"""Text column expressions (JVM-side, codegen'd).

All functions take and return ``Column`` so they compose inside
``select``/``withColumn`` and stay in whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace class that equals Python's ``str.split()``
# for every whitespace code point of the Basic Multilingual Plane.
# Written with \x{..} escapes, which both Java regex and RE2 accept.
WS_CLASS = (
    r"[\t\n\x{0b}\x{0c}\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}"
    r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WS_RUN = WS_CLASS + "+"

# Questions that end an interactive session.
STOP_COMMANDS = ("exit", "quit", "q")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_ws(c) -> Column:
    """Every whitespace run becomes one space; ends trimmed. Null stays null."""
    return F.trim(F.regexp_replace(_c(c), WS_RUN, " "))


def clean_text(c) -> Column:
    """Lower-case, collapse every Unicode whitespace run to one space, trim."""
    return collapse_ws(F.lower(_c(c)))


def strip_ws(c) -> Column:
    """Remove leading and trailing whitespace of any kind (Python ``strip``)."""
    return F.regexp_replace(_c(c), f"^{WS_RUN}|{WS_RUN}$", "")


def words(c) -> Column:
    """Whitespace tokens of a text (empty text -> empty array)."""
    t = collapse_ws(c)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " "))


def is_stop_command(c) -> Column:
    return _c(c).isin(*STOP_COMMANDS)


def digit_tokens(c) -> Column:
    """All-digit whitespace tokens of a text, in order."""
    return F.filter(words(c), lambda x: x.rlike("^[0-9]+$"))


def url_host(c) -> Column:
    """Host of an absolute URL, null when it does not parse."""
    return F.try_parse_url(_c(c), F.lit("HOST"))


def truncate_words(c, n: int) -> Column:
    """First ``n`` whitespace tokens joined by one space."""
    return F.array_join(F.slice(words(c), 1, n), " ")

"""Column functions with Python string semantics, shared by every operator.

Python's ``str.split()`` / ``str.strip()`` / ``\\s`` are Unicode-aware and also
treat the separators U+001C..U+001F as blanks; Java's ``\\s`` is ASCII unless
``(?U)`` is set. Everything text-shaped in the package goes through these
helpers so the two agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python str.isspace() == Java (?U)\s plus the four information separators.
WS_CLASS = r"[\s\x1c-\x1f]"
WS_RUN = r"(?U)" + WS_CLASS + "+"
# The same characters one by one.
PY_BLANKS = "".join(chr(x) for x in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                     0x2028, 0x2029, 0x202F, 0x205F, 0x3000))

# The 32 ASCII punctuation characters of Python's string.punctuation (fixed value).
ASCII_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: drop leading and trailing Unicode blanks. Only the ends are looked at, and no
    regular expression scans the text."""
    return F.btrim(col_of(c), F.lit(PY_BLANKS))


def ws_split(c) -> Column:
    """``str.split()``: tokens between blank runs, no empty tokens; null stays null."""
    return F.filter(F.split(col_of(c), WS_RUN), lambda t: t != F.lit(""))


def ws_collapse(c) -> Column:
    """``" ".join(s.split())``."""
    return F.regexp_replace(py_strip(c), WS_RUN, " ")


def py_str(c) -> Column:
    """``str(x)`` for string / integer columns: null becomes the text ``None``."""
    return F.coalesce(col_of(c).cast("string"), F.lit("None"))


def is_py_digits(c) -> Column:
    """``str(x).isdigit()`` for ASCII digit strings (non-empty)."""
    return col_of(c).cast("string").rlike(r"^[0-9]+$")


def is_py_float(c) -> Column:
    """True when Python ``float(s)`` accepts the text (decimal / exponent forms,
    inf, nan; surrounding blanks allowed). Spark's ``try_cast`` is looser (it
    takes ``5d``), so numeric casts are gated with this."""
    return col_of(c).rlike(
        r"^(?U)\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\s*$"
    )


def let(value, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (a lambda binding), so a large
    sub-expression used several times is not recomputed per use."""
    return F.element_at(F.transform(F.array(col_of(value)), fn), 1)


def ngrams(tokens, n: int) -> Column:
    """Contiguous n-grams of a token array as space-joined strings.

    Guarded: arrays shorter than ``n`` give ``[]`` (``sequence(1, 0)`` would
    count down)."""

    def build(t):
        return F.when(
            F.size(t) >= n,
            F.transform(F.sequence(F.lit(1), F.greatest(F.size(t) - n + 1, F.lit(1))),
                        lambda i: F.array_join(F.slice(t, i, n), " ")),
        ).otherwise(F.array().cast("array<string>"))

    return let(tokens, build)


def first_regex_removed(c, pattern: str) -> Column:
    """``re.sub(pattern, '', s, 1)``: remove only the first match."""
    import re

    s = col_of(c)
    rx = r"(?s)^(.*?)(?:" + pattern + r")(.*)$"
    tail = 2 + re.compile(pattern).groups  # the pattern's own groups come before the tail
    hit = s.rlike(r"(?s)" + pattern)
    return F.when(hit, F.concat(F.regexp_extract(s, rx, 1), F.regexp_extract(s, rx, tail))).otherwise(s)


def round6(c) -> Column:
    """Stable rendering of doubles for result tables (also turns -0.0 into 0.0)."""
    return F.round(col_of(c) + F.lit(0.0), 6)

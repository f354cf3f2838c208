"""Text tests used by the pattern flags."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vendor-only SQL constructs, each with the literals that give it away.
VENDOR_SQL_PATTERNS: Mapping[str, tuple[str, ...]] = {
    "sys_context": ("sys_context",),
    "connect by": ("connect by",),
    "from dual": ("from dual", "join dual"),
    "(+)": ("(+)",),
    "nchar_cs": ("nchar_cs",),
}


def collapsed(text: Column) -> Column:
    """Lower case, with every run of white space as one blank."""
    return F.regexp_replace(F.lower(text), r"\s+", " ")


def holds(lowered: Column, literal: str) -> Column:
    """True where the collapsed form of a lower-case text contains ``literal``.

    The text itself is not rebuilt: a literal of one word is a plain search, and for one
    with blanks the words are searched first, so that few rows reach the regular
    expression.
    """
    words = re.split(r"(\s+)", literal.lower())
    found = F.lit(True)
    for word in words[::2]:
        if word:
            found = found & lowered.contains(word)
    if len(words) == 1:
        return found
    spaced = "".join(r"\s+" if i % 2 else re.escape(w) for i, w in enumerate(words))
    return found & lowered.rlike(spaced)


def pattern_tests(lowered: Column, patterns: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """Per pattern name, whether one of its literals occurs in a lower-case text."""
    return {name: reduce(or_, [holds(lowered, lit) for lit in lits]) for name, lits in patterns.items()}


def whole_value_matches(text: Column, regex: str) -> Column:
    """True where the trimmed value as a whole matches ``regex``, in any letter case."""
    return F.trim(text).rlike(f"(?i)^(?:{regex})$")

"""Ordered, first-match-wins classification of messages as column expressions.

The rule words are literals, so they are tested with ``contains`` (a byte search
inside generated code) rather than with a regular expression, which would decode
every message to a Java string once per rule.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .extract import hresult_code
from .rules import AUTH_WORDS, ERROR_TYPE_WORDS, SEVERITY_WORDS


def contains_any(message: Column, words: tuple[str, ...]) -> Column:
    """True when the message holds one of the words.

    Words implied by a shorter one are not tested, and words with the same first part ("CPU fault",
    "CPU overload") are only searched where that part occurs, so most messages take few searches.
    """
    shortest = dict.fromkeys(w for w in words if not any(o != w and o in w for o in words))
    by_start: dict[str, list[str]] = {}
    for word in shortest:
        by_start.setdefault(word.partition(" ")[0] + " " if " " in word else word, []).append(word)
    tests = []
    for start, found in by_start.items():
        test = reduce(or_, (message.contains(w) for w in found))
        tests.append(message.contains(start) & test if len(found) > 1 else test)
    return reduce(or_, tests)


def _first_match(message: Column, choices, value=F.lit) -> Column:
    chain = F
    for label, words in choices:
        chain = chain.when(contains_any(message, words), value(label))
    return chain


def category(message: Column, family: str) -> Column:
    """severe_error, mild_error, warning or success, by the family's ordered rules."""
    return _first_match(message, SEVERITY_WORDS[family].items()).otherwise(F.lit("success"))


def error_types(message: Column, family: str) -> Column:
    """ARRAY<STRING> of known error types: at most one per group of the family."""
    none = F.array().cast("array<string>")
    if family == "cbs":
        code = hresult_code(message)
        return F.when(code != "", F.array(code)).otherwise(none)
    one = lambda label: F.array(F.lit(label))
    groups = [_first_match(message, group, one).otherwise(none) for group in ERROR_TYPE_WORDS[family]]
    return F.concat(*groups) if len(groups) > 1 else groups[0]


def auth_event(message: Column) -> Column:
    """auth_failure, sudo, session or other."""
    return _first_match(message, [(kind, (word,)) for kind, word in AUTH_WORDS]).otherwise(F.lit("other"))

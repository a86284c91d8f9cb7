"""Turning values into labels: ordered thresholds and ordered text patterns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def _ordered(branches: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """First true branch wins; a null condition falls through."""
    (head_cond, head_label), *rest = branches
    chain = F.when(head_cond, F.lit(head_label))
    for cond, label in rest:
        chain = chain.when(cond, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def below(c: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first step whose bound is above the value (``value < bound``)."""
    return _ordered([(c < F.lit(bound), label) for bound, label in steps], otherwise)


def at_least(c: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first step whose bound is reached (``value >= bound``)."""
    return _ordered([(c >= F.lit(bound), label) for bound, label in steps], otherwise)


def first_match(c: Column, rules: Sequence[tuple[str, Sequence[str]]], otherwise: str) -> Column:
    """Label of the first rule one of whose words occurs in the text, in any case."""

    def mentions(words: Sequence[str]) -> Column:
        return reduce(lambda a, b: a | b, [c.ilike(f"%{w}%") for w in words])

    return _ordered([(mentions(words), label) for label, words in rules], otherwise)

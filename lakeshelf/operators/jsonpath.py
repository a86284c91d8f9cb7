"""JSON paths such as ``main.temp`` or ``weather[0].main`` over one parsed struct."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F, types as T

_STEP = re.compile(r"([^.\[\]]+)|\[(\d+)\]")


def _steps(path: str) -> list[str | int]:
    return [name if name else int(index) for name, index in _STEP.findall(path)]


def _insert(tree: dict, steps: list[str | int]) -> None:
    """Grow a nested dict; the key ``0`` of type int stands for 'any array index'."""
    for step in steps:
        tree = tree.setdefault(0 if isinstance(step, int) else step, {})


def _to_type(tree: dict) -> T.DataType:
    if not tree:
        return T.StringType()
    if 0 in tree:
        if len(tree) > 1:
            raise ValueError("a JSON path reads the same node as an array and as an object")
        return T.ArrayType(_to_type(tree[0]))
    return T.StructType([T.StructField(name, _to_type(sub)) for name, sub in tree.items()])


def path_schema(paths: Iterable[str]) -> T.StructType:
    """The smallest schema that holds every path, with text leaves."""
    tree: dict = {}
    listed = [_steps(p) for p in paths]
    for steps in sorted(listed, key=len):
        _insert(tree, steps)
    for steps in listed:
        node = tree
        for step in steps:
            node = node[0 if isinstance(step, int) else step]
        if node:
            raise ValueError("a JSON path is a prefix of another one")
    return _to_type(tree)


def path_column(parsed: Column, path: str) -> Column:
    """Walk the path; a missing node or a short array gives null."""
    for step in _steps(path):
        parsed = F.get(parsed, F.lit(step)) if isinstance(step, int) else parsed.getField(step)
    return parsed

"""Declarative column mapping: rename, default, tolerant cast, range check.

The four steps run in that order for every column, so a value that a failed cast
or the range check turned into null does not get the default. All of it compiles
into a single ``select``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakeshelf.functions import between_or_null, number_of, tolerant_cast
from lakeshelf.operators.jsonpath import path_column, path_schema

JSON_PREFIX = "$."


@dataclass(frozen=True)
class FieldRule:
    """How one source column becomes one target column."""

    source: str
    target: str
    type: str = ""
    required: bool = False
    default: Any = None
    minimum: float | None = None
    maximum: float | None = None
    formats: tuple[str, ...] = ()

    @classmethod
    def from_dict(cls, source: str, rule: Mapping[str, Any]) -> FieldRule:
        bounds = rule.get("validation") or {}
        formats = rule.get("format") or ()
        return cls(
            source=source,
            target=rule.get("target", source),
            type=(rule.get("type") or "").lower(),
            required=bool(rule.get("required", False)),
            default=rule.get("default"),
            minimum=bounds.get("min"),
            maximum=bounds.get("max"),
            formats=(formats,) if isinstance(formats, str) else tuple(formats),
        )

    @property
    def is_path(self) -> bool:
        return self.source.startswith(JSON_PREFIX)

    @property
    def flat_name(self) -> str:
        """The column a flattened record has for this rule's path."""
        return self.source.removeprefix(JSON_PREFIX) if self.is_path else self.source

    def with_default(self, c: Column, source_type: T.DataType) -> Column:
        if self.default is None:
            return c
        # The default takes the type of the raw column: the cast comes afterwards.
        return F.coalesce(c, F.lit(self.default).cast(source_type))

    def cast(self, c: Column, source_type: T.DataType) -> Column:
        return tolerant_cast(c, self.type, source_type, self.formats) if self.type else c

    def rejected(self, c: Column, source_type: T.DataType) -> Column:
        """Aggregate: how many non-null raw values the cast turns into null."""
        filled = self.with_default(c, source_type)
        return F.count_if(filled.isNotNull() & self.cast(filled, source_type).isNull()).alias(self.target)

    def in_range(self, c: Column, source_type: T.DataType) -> Column:
        if self.minimum is None and self.maximum is None:
            return c
        # Text that stayed text is compared as a number; what is no number passes.
        number = c if self.type in _NUMERIC else number_of(c, source_type)
        kept = between_or_null(number, self.minimum, self.maximum)
        return F.when(number.isNull() | kept.isNotNull(), c)

    def compile(self, c: Column, source_type: T.DataType) -> Column:
        return self.in_range(self.cast(self.with_default(c, source_type), source_type), source_type)


_NUMERIC = ("integer", "int", "bigint", "long", "double", "float", "real")


@dataclass(frozen=True)
class FieldMapping:
    """An ordered set of field rules."""

    rules: tuple[FieldRule, ...] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        targets = [r.target for r in self.rules]
        repeated = sorted({t for t in targets if targets.count(t) > 1})
        if repeated:
            raise ValueError(f"several rules write the same column: {repeated}")

    @classmethod
    def from_dict(cls, mapping: Mapping[str, Mapping[str, Any]] | None) -> FieldMapping:
        return cls(tuple(FieldRule.from_dict(src, rule or {}) for src, rule in (mapping or {}).items()))

    @property
    def required_targets(self) -> list[str]:
        return [r.target for r in self.rules if r.required]

    def _steps(self, df: DataFrame) -> dict[str, FieldRule]:
        """Column of ``df`` -> its rule. Rules for absent columns are ignored."""
        by_source = {}
        for rule in self.rules:
            name = rule.source if rule.source in df.columns else rule.flat_name
            if name in df.columns:
                by_source[name] = rule
        return by_source

    def apply(self, df: DataFrame) -> DataFrame:
        """Map the columns of ``df``; columns without a rule pass through unchanged."""
        steps = self._steps(df)
        out = []
        for f in df.schema.fields:
            raw = F.col(_quoted(f.name))
            rule = steps.get(f.name)
            out.append(raw if rule is None else rule.compile(raw, f.dataType).alias(rule.target))
        return df.select(*out)

    def apply_to_json(
        self,
        df: DataFrame,
        json_column: str,
        keep_raw: bool = True,
        watch: Callable[[DataFrame, Sequence[Column]], DataFrame] | None = None,
    ) -> DataFrame:
        """Map the paths of a JSON text column; ``watch`` as in ``ingest.transform``.

        One ``from_json`` with a schema made from the paths reads every path in a
        single parse; leaves stay text, so the casts are the same as for CSV.
        """
        parsed = F.from_json(F.col(json_column), path_schema([r.flat_name for r in self.rules]))
        others = [c for c in df.columns if c != json_column or keep_raw]
        tmp = "__parsed"
        mapped = [
            r.compile(path_column(F.col(tmp), r.flat_name), T.StringType()).alias(r.target)
            for r in self.rules
        ]
        carried = df.select("*", parsed.alias(tmp))
        if watch:
            text = T.StringType()
            carried = watch(carried, [r.rejected(path_column(F.col(tmp), r.flat_name), text) for r in self.rules])
        return carried.select(*mapped, *[F.col(_quoted(c)) for c in others])

    def rejected_casts(self, df: DataFrame) -> list[Column]:
        """Per rule: how many non-null raw values the cast turns into null."""
        counts = []
        for name, rule in self._steps(df).items():
            counts.append(rule.rejected(F.col(_quoted(name)), df.schema[name].dataType))
        return counts

    def split_required(self, mapped: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows with all required columns, and the rows that miss one."""
        required = [c for c in self.required_targets if c in mapped.columns]
        if not required:
            return mapped, mapped.where(F.lit(False))
        complete = reduce(lambda a, b: a & b, [F.col(_quoted(c)).isNotNull() for c in required])
        return mapped.where(complete), mapped.where(~complete)


def _quoted(name: str) -> str:
    """Column names may hold dots (``PM2.5``)."""
    return "`" + name.replace("`", "``") + "`"


def columns_of(df: DataFrame, names: Iterable[str]) -> list[Column]:
    return [F.col(_quoted(n)) for n in names]

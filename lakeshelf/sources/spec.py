"""Source specs: what to read, how to map it, where to put it, what to check.

A spec is a dictionary, written as YAML or JSON. Files live in one folder; adding a
source means adding a file.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from lakeshelf.operators.mapping import FieldMapping

try:
    import yaml
except ImportError:  # JSON specs work without it
    yaml = None

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class SourceSpec:
    source_id: str
    source_type: str
    format: str = "csv"
    enabled: bool = True
    name: str = ""
    # the block named after the source type: file, kaggle, api or kafka
    settings: dict[str, Any] = field(default_factory=dict)
    target_table: str = ""
    write_mode: str = "append"
    partition_by: str | None = None
    mapping: FieldMapping = field(default_factory=FieldMapping)
    quality_checks: tuple[dict[str, Any], ...] = ()
    expected_rows: tuple[int | None, int | None] = (None, None)

    @classmethod
    def from_dict(cls, raw: dict[str, Any]) -> SourceSpec:
        missing = [k for k in ("source_id", "source_type") if not raw.get(k)]
        if missing:
            raise ValueError(f"source spec without {', '.join(missing)}")
        target = raw.get("target") or {}
        meta = raw.get("metadata") or {}
        return cls(
            source_id=raw["source_id"],
            source_type=raw["source_type"],
            format=(raw.get("format") or "csv").lower(),
            enabled=bool(raw.get("enabled", True)),
            name=raw.get("source_name", ""),
            settings=dict(raw.get(raw["source_type"]) or {}),
            target_table=target.get("table") or f"bronze_{raw['source_id']}",
            write_mode=target.get("write_mode", "append"),
            partition_by=target.get("partition_by"),
            mapping=FieldMapping.from_dict(raw.get("schema_mapping")),
            quality_checks=tuple(raw.get("quality_checks") or ()),
            expected_rows=(meta.get("expected_row_count_min"), meta.get("expected_row_count_max")),
        )

    @property
    def partition_column(self) -> str | None:
        """``ingestion_date`` names the audit column of that meaning."""
        return "_ingestion_date" if self.partition_by == "ingestion_date" else self.partition_by

    def checks(self) -> list[dict[str, Any]]:
        """The declared checks, and the expected row count as one more."""
        low, high = self.expected_rows
        counted = [] if low is None and high is None else [
            {"check_type": "row_count", "min_rows": low or 0, "max_rows": high}
        ]
        return [*self.quality_checks, *counted]


def _parse(path: Path) -> dict[str, Any]:
    text = path.read_text(encoding="utf-8")
    if path.suffix == ".json":
        return json.loads(text)
    if yaml is None:
        raise RuntimeError(f"PyYAML is needed to read {path}")
    return yaml.safe_load(text)


class SpecFolder:
    """All specs of a folder (``<root>/sources`` if it exists, else ``<root>``)."""

    def __init__(self, root: str | Path):
        root = Path(root)
        self.folder = root / "sources" if (root / "sources").is_dir() else root

    def __iter__(self) -> Iterator[SourceSpec]:
        """Enabled specs by file name; a spec that cannot be read is logged and left out."""
        if not self.folder.is_dir():
            log.warning("no spec folder %s", self.folder)
            return
        paths = [p for p in self.folder.iterdir() if p.suffix in (".yaml", ".yml", ".json")]
        for path in sorted(paths):
            try:
                spec = SourceSpec.from_dict(_parse(path))
            except Exception:  # noqa: BLE001 - one bad file must not stop the others
                log.exception("cannot load source spec %s", path)
                continue
            if spec.enabled:
                yield spec

    def all(self) -> list[SourceSpec]:
        return list(self)

    def by_id(self, source_id: str) -> SourceSpec | None:
        return next((s for s in self if s.source_id == source_id), None)

    def by_type(self, source_type: str) -> list[SourceSpec]:
        return [s for s in self if s.source_type == source_type]

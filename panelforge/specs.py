"""Table specs: plain dataclasses for the two user-facing configurations.

``SelectSpec`` describes one table of Stage 1 (per-year projection and reshape); ``BuildSpec``
describes one multi-year table of Stage 2 (union, optional key aggregation, optional shards).
Both can be built from the dicts the YAML configs hold (``from_dict``).
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import Any

DEFAULT_MONTHLY_PATTERN = r"^(.+)_mo_(\d{2})$"


def fill(template: str, **values) -> str:
    """Substitute ``{name}`` placeholders by name only, leaving any other braces untouched."""
    for k, v in values.items():
        template = template.replace("{" + k + "}", str(v))
    return template


@dataclass
class SelectSpec:
    name: str
    path_pattern: str
    columns: list[str]
    output_dir: str | None = None
    output_name: str | None = None
    explode_arrays: bool = False
    monthly_columns: bool = False
    monthly_pattern: str = DEFAULT_MONTHLY_PATTERN
    period_col: str = "month"
    n_periods: int = 12
    primary_key: list[str] | None = None
    lineage_col: str = "filename"

    @classmethod
    def from_dict(cls, conf: dict[str, Any]) -> "SelectSpec":
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in conf.items() if k in known})

    def resolved_pattern(self, year: int) -> str:
        # only the placeholder is substituted: the rest may hold glob braces such as {a,b}
        return fill(self.path_pattern, year=year)

    def resolved_output_name(self, year: int) -> str:
        return fill(self.output_name or f"{self.name}_{{year}}", year=year)

    def output_path(self, year: int) -> str:
        if not self.output_dir:
            raise ValueError(f"table '{self.name}' has no output_dir")
        return f"{self.output_dir.rstrip('/')}/{self.resolved_output_name(year)}.parquet"


@dataclass
class BuildSpec:
    name: str
    year_min: int
    year_max: int
    path_pattern: str
    output_name: str
    primary_key: list[str] | None = None
    shard_by: str | None = None
    #: Set where the input is one dataset with ``<year_column>=<year>`` folders, not a dataset a year;
    #: ``path_pattern`` is then without ``{year}``.
    year_column: str | None = None
    extra: dict[str, Any] = field(default_factory=dict)

    REQUIRED = ("year_min", "year_max", "path_pattern", "output_name")

    @classmethod
    def from_dict(cls, name: str, conf: dict[str, Any]) -> "BuildSpec":
        absent = sorted(set(cls.REQUIRED) - set(conf))
        if absent:
            raise ValueError(f"table {name!r} lacks settings: {', '.join(absent)}")
        known = {f.name for f in fields(cls)} - {"name", "extra"}
        extra = {k: v for k, v in conf.items() if k not in known}
        return cls(name=name, extra=extra, **{k: v for k, v in conf.items() if k in known})

    def __post_init__(self):
        if self.shard_by and self.primary_key and self.shard_by not in self.primary_key:
            raise ValueError(f"table {self.name!r} is sharded by {self.shard_by!r}, which is no part of its key")

    @property
    def years(self) -> list[int]:
        return list(range(int(self.year_min), int(self.year_max) + 1))

    def year_path(self, basepath: str, year: int) -> str:
        return fill(self.path_pattern, basepath=basepath, year=year)

    def formatted_output_name(self) -> str:
        return fill(self.output_name, year_min=self.year_min, year_max=self.year_max)

    @property
    def aggregated(self) -> bool:
        return bool(self.primary_key)

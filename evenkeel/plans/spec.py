"""A declarative mapping from a source table to a target table."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column

TRANSFORMS = ("direct", "rename", "cast", "derived", "constant", "drop")
JOIN_TYPES = ("LEFT", "INNER", "RIGHT")
NULL_POLICIES = ("error", "fill_zero", "fill_empty", "fill_default")

Rule = str | Callable[[Column | None], Column] | None


class SpecError(ValueError):
    """The mapping contradicts itself."""


@dataclass(frozen=True)
class JoinDef:
    """An enrichment join; fetched columns appear as ``alias_column``."""

    alias: str
    table: str
    left_key: str
    right_key: str
    fetch: tuple[str, ...] = ()
    how: str = "LEFT"
    database: str = ""

    @property
    def full_table(self) -> str:
        return f"{self.database}.{self.table}" if self.database else self.table


@dataclass(frozen=True)
class SourceColumn:
    name: str
    dtype: str = "UNKNOWN"
    nullable: bool = True
    is_key: bool = False
    is_unique: bool = False


@dataclass(frozen=True)
class ColumnRule:
    """How one target column is made.

    ``rule`` is a Spark SQL expression over source columns, ``alias.column`` of
    a join and ``val`` for the source column, or a function from the source
    ``Column`` to a ``Column``.  An empty null policy or ``error`` makes the
    target column required.
    """

    transform: str
    source: str | None = None
    target: str | None = None
    rule: Rule = None
    dtype: str = ""
    force_dtype: str | None = None
    nulls: str = ""
    default: Any = None

    @property
    def effective_dtype(self) -> str:
        return self.force_dtype or self.dtype

    def problems(self) -> list[str]:
        name = self.target or self.source or "?"
        if not self.transform:
            return [f"{name}: the transform is empty"]
        if self.transform not in TRANSFORMS:
            return [f"{name}: unknown transform {self.transform!r}"]
        found = []
        if self.transform == "drop":
            if not self.source:
                found.append(f"{name}: drop needs a source column")
            return found
        if not self.target:
            found.append(f"{name}: {self.transform} needs a target column")
        if self.transform in ("constant", "cast", "derived") and (self.rule is None or self.rule == ""):
            found.append(f"{name}: {self.transform} needs a rule")
        if self.transform in ("direct", "rename") and not self.source and not self.rule:
            found.append(f"{name}: neither a source column nor a rule")
        if self.nulls and self.nulls not in NULL_POLICIES:
            found.append(f"{name}: unknown null policy {self.nulls!r}")
        if self.nulls == "fill_default" and self.default is None:
            found.append(f"{name}: fill_default needs a default")
        return found


_JOIN_REF = re.compile(r"\b([A-Za-z_]\w*)\.([A-Za-z_]\w*)\b")


@dataclass(frozen=True)
class TableSpec:
    """Source table, target table, joins and column rules; checked when made."""

    source_table: str
    target_table: str
    source_columns: tuple[SourceColumn, ...]
    rules: tuple[ColumnRule, ...]
    joins: tuple[JoinDef, ...] = field(default=())

    def __post_init__(self):
        problems = [p for r in self.rules for p in r.problems()]
        targets = [r.target.lower() for r in self.rules if r.target and r.transform != "drop"]
        problems += [f"{t}: mapped more than once" for t in sorted({t for t in targets if targets.count(t) > 1})]
        names = [c.name.lower() for c in self.source_columns]
        problems += [f"{n}: source column listed twice" for n in sorted({n for n in names if names.count(n) > 1})]
        problems += [
            f"{j.alias}: join type must be one of {JOIN_TYPES}" for j in self.joins if j.how.upper() not in JOIN_TYPES
        ]
        known = {n.lower() for n in names} | {
            f"{j.alias}.{c}".lower() for j in self.joins for c in j.fetch
        }
        for r in self.rules:
            if r.source and "." not in r.source and r.source.lower() not in known:
                problems.append(f"{r.source}: not a source column")
        if problems:
            raise SpecError("; ".join(problems))
        object.__setattr__(self, "joins", self._with_referenced_columns())

    def _with_referenced_columns(self) -> tuple[JoinDef, ...]:
        """Joins that also fetch the columns rules mention but the join does not list."""
        mentioned = [m for r in self.rules for text in (r.rule, r.source) if isinstance(text, str)
                     for m in _JOIN_REF.findall(text)]
        joins = []
        for j in self.joins:
            fetch = list(j.fetch)
            for alias, column in mentioned:
                if alias.lower() == j.alias.lower() and column.lower() not in [c.lower() for c in fetch]:
                    fetch.append(column)
            joins.append(replace(j, fetch=tuple(fetch)))
        return tuple(joins)

    @property
    def source_keys(self) -> list[str]:
        return [c.name for c in self.source_columns if c.is_key]

    @property
    def target_keys(self) -> list[str]:
        """Targets of the rules that carry a source key over."""
        keys = {k.lower() for k in self.source_keys}
        return [
            r.target for r in self.rules
            if r.transform in ("direct", "rename", "cast") and r.source and r.source.lower() in keys
        ]

    @property
    def unique_columns(self) -> list[str]:
        return [c.name for c in self.source_columns if c.is_unique]

    @property
    def target_columns(self) -> list[str]:
        return [r.target for r in self.rules if r.transform != "drop"]

    @property
    def compare_columns(self) -> list[str]:
        return [c for c in self.target_columns if c not in self.target_keys]

    @property
    def required_columns(self) -> list[str]:
        return [r.target for r in self.rules if r.transform != "drop" and r.nulls in ("", "error")]

    def needed_columns(self) -> list[str]:
        """Source columns that a rule or a join reads; dropped ones only if a rule names them."""
        words = {w.lower() for r in self.rules if isinstance(r.rule, str) for w in re.findall(r"\w+", r.rule)}
        used = {r.source.lower() for r in self.rules if r.source and r.transform != "drop"}
        used |= {j.left_key.lower() for j in self.joins} | words
        if any(callable(r.rule) for r in self.rules):
            # a function may read any column, so only those that are dropped outright are left out
            dropped = {r.source.lower() for r in self.rules if r.transform == "drop"}
            used |= {c.name.lower() for c in self.source_columns if c.name.lower() not in dropped}
        needed = [c.name for c in self.source_columns if c.name.lower() in used]
        return needed or [c.name for c in self.source_columns]

    @classmethod
    def from_dict(cls, data: dict) -> TableSpec:
        """Read the spec from its JSON form."""
        return cls(
            data["source_table"],
            data["target_table"],
            tuple(SourceColumn(**c) for c in data["source_columns"]),
            tuple(ColumnRule(**r) for r in data["rules"]),
            tuple(JoinDef(**{**j, "fetch": tuple(j.get("fetch", ()))}) for j in data.get("joins", ())),
        )

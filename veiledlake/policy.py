"""Dataset policies: what to rename, drop, strip, parse, mask, tokenise and key on."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

# The types whose columns are replaced by tokens, and the one
# type whose columns are masked as dates. Any other type is an error.
TOKEN_TYPES = ("case_id", "ssn", "fein", "email", "person_nm", "user_cd", "phone_num")
DATE_TYPE = "dob"


class PolicyError(ValueError):
    """A policy that cannot be applied as written."""


@dataclass(frozen=True)
class DatasetPolicy:
    """The rules of one dataset.

    Every rule but ``renames`` speaks of the column names after renaming.
    """

    table: str
    keys: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ()
    pii: Mapping[str, str] = field(default_factory=dict)
    drops: tuple[str, ...] = ()
    folder: str = ""
    dates: Mapping[str, str] = field(default_factory=dict)
    timestamps: Mapping[str, str] = field(default_factory=dict)
    renames: Mapping[str, str] = field(default_factory=dict)
    strips: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        unknown = sorted({t for t in self.pii.values() if t not in TOKEN_TYPES and t != DATE_TYPE})
        if unknown:
            raise PolicyError(f"{self.table}: unknown PII types {unknown}")
        for what, names in (("key", self.keys), ("partition", self.partitions)):
            if len({n.lower() for n in names}) != len(names):
                raise PolicyError(f"{self.table}: a {what} column is listed twice")
        dropped = {n.lower() for n in self.drops}
        for what, names in (
            ("key", self.keys),
            ("partition", self.partitions),
            ("PII", self.pii),
        ):
            clash = sorted(n for n in names if n.lower() in dropped)
            if clash:
                raise PolicyError(f"{self.table}: {what} columns {clash} are also dropped")

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> DatasetPolicy:
        """Read a registry entry. Absent entries, and a list where a map belongs, mean no rule."""

        def mapping(name: str) -> dict[str, Any]:
            value = config.get(name) or {}
            if isinstance(value, Mapping):
                return dict(value)
            raise PolicyError(f"{config.get('table_name')}: {name} must map column to rule")

        return cls(
            table=config["table_name"],
            keys=tuple(config.get("primary_key_col") or ()),
            partitions=tuple(config.get("partition_cols") or ()),
            pii=mapping("pii_col"),
            drops=tuple(config.get("exclude_cols") or ()),
            folder=config.get("s3_target_write_folder") or "",
            dates=mapping("date_trns_cols"),
            timestamps=mapping("ts_trns_cols"),
            renames=mapping("rename_cols"),
            strips={c: tuple(p) for c, p in mapping("char_rep_trns").items()},
        )

    def to_config(self) -> dict[str, Any]:
        """The policy as a registry entry."""
        return {
            "table_name": self.table,
            "primary_key_col": list(self.keys),
            "partition_cols": list(self.partitions),
            "pii_col": dict(self.pii),
            "exclude_cols": list(self.drops),
            "s3_target_write_folder": self.folder,
            "date_trns_cols": dict(self.dates),
            "ts_trns_cols": dict(self.timestamps),
            "rename_cols": dict(self.renames),
            "char_rep_trns": {c: list(p) for c, p in self.strips.items()},
        }

    @classmethod
    def load_registry(cls, text: str) -> dict[str, DatasetPolicy]:
        """Read a JSON object that maps dataset names to registry entries."""
        return {name: cls.from_config(config) for name, config in json.loads(text).items()}

    def path(self, base: str) -> str:
        """Where this dataset lives below a layer's base path."""
        return f"{base.rstrip('/')}/{self.folder or self.table}"

    @property
    def token_columns(self) -> dict[str, str]:
        return {c: t for c, t in self.pii.items() if t != DATE_TYPE}

    @property
    def masked_columns(self) -> tuple[str, ...]:
        return tuple(c for c, t in self.pii.items() if t == DATE_TYPE)

    @property
    def moves_between_partitions(self) -> bool:
        """Whether a row may change partition while keeping its key."""
        keys = {k.lower() for k in self.keys}
        return any(p.lower() not in keys for p in self.partitions)

    def resolve(self, columns: Sequence[str], strict: bool = True) -> DatasetPolicy:
        """Match the rules to the columns of the renamed input, ignoring case.

        Drop, date and timestamp rules on absent columns fall away. Absent
        key, partition, PII and strip columns raise when ``strict``.
        """
        actual = {c.lower(): c for c in columns}
        if len(actual) != len(columns):
            raise PolicyError(f"{self.table}: column names differ only in case or repeat")

        def names(wanted: Iterable[str]) -> tuple[str, ...]:
            return tuple(actual[w.lower()] for w in wanted if w.lower() in actual)

        def rules(wanted: Mapping[str, Any]) -> dict[str, Any]:
            return {actual[c.lower()]: r for c, r in wanted.items() if c.lower() in actual}

        if strict:
            needed = [*self.keys, *self.partitions, *self.pii, *self.strips]
            absent = sorted({n for n in needed if n.lower() not in actual})
            if absent:
                raise PolicyError(f"{self.table}: columns {absent} are not in the data")
        return replace(
            self,
            keys=names(self.keys),
            partitions=names(self.partitions),
            pii=rules(self.pii),
            drops=names(self.drops),
            dates=rules(self.dates),
            timestamps=rules(self.timestamps),
            strips=rules(self.strips),
        )


def dump_registry(policies: Mapping[str, DatasetPolicy]) -> str:
    """Policies as the JSON text ``load_registry`` reads."""
    return json.dumps({name: p.to_config() for name, p in policies.items()}, indent=2)

"""The checks and contract fields the oracle judges by, as literal data beside this file; nothing comes from the engine.

``full`` and ``split`` are the two suites, ``contract`` the checks of the contracts, ``rules`` the rule catalogue.
"""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Check:
    no: int
    kind: str
    columns: tuple[str, ...]
    args: dict
    mostly: float = 1.0
    dimension: str = "Validity"
    issue_id: str | None = None
    predicted: str | None = None
    rule_id: str | None = None
    severity: str | None = None

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


@dataclass(frozen=True)
class Suite:
    name: str
    table: str
    checks: tuple[Check, ...]

    def only(self, wanted) -> "Suite":
        return replace(self, checks=tuple(c for c in self.checks if wanted(c)))


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool
    pii: bool
    primary: bool

    @property
    def length(self) -> int | None:
        found = re.search(r"char\((\d+)\)", self.type)
        return int(found[1]) if found else None


def _load(name: str):
    with open(os.path.join(os.path.dirname(__file__), f"{name}.json"), encoding="utf-8") as file:
        return json.load(file)


def _suites(name: str) -> dict[str, Suite]:
    return {s["table"]: Suite(s["suite"], s["table"], tuple(
        Check(**{**c, "columns": tuple(c["columns"])}) for c in s["checks"])) for s in _load(name)}


FULL, SPLIT, CONTRACT, RULES = map(_suites, ("full", "split", "contract", "rules"))
FIELDS = {c["table"]: [Field(**f) for f in c["fields"]] for c in _load("contracts")}


def matching(suites: dict[str, Suite], wanted) -> dict[str, Suite]:
    """The checks that fit, table by table; tables without any are left out."""
    chosen = {t: s.only(wanted) for t, s in suites.items()}
    return {t: s for t, s in chosen.items() if s.checks}


def by_kind(suites: dict[str, Suite], *kinds: str) -> dict[str, Suite]:
    return matching(suites, lambda c: c.kind in kinds)

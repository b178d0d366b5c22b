"""Suites on disk: small JSON files the driver reads before a run."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import replace
from pathlib import Path

from plumbline.operators.checks import Suite, from_expectations


def save_suites(folder: str | Path, suites: Mapping[str, Suite]) -> None:
    """One file per suite; saving again replaces it."""
    target = Path(folder)
    target.mkdir(parents=True, exist_ok=True)
    for suite in suites.values():
        (target / f"{suite.name}.json").write_text(suite.to_json(), encoding="utf-8")


def load_suites(folder: str | Path) -> dict[str, Suite]:
    """Suites by table, in either stored form."""
    loaded = [Suite.from_json(path.read_text(encoding="utf-8")) for path in sorted(Path(folder).glob("*.json"))]
    return {suite.table: suite for suite in loaded}


def load_project(root: str | Path) -> dict[str, Suite]:
    """Suites of a file project that keeps ``expectations/*.json`` and ``validation_definitions/*.json``.

    A definition says which table a suite is run on; suites without one go by their name.
    """
    root = Path(root)
    suites = {raw["name"]: from_expectations(raw) for raw in
              (json.loads(p.read_text(encoding="utf-8")) for p in sorted((root / "expectations").glob("*.json")))}
    for path in sorted((root / "validation_definitions").glob("*.json")):
        pair = json.loads(path.read_text(encoding="utf-8"))
        name, table = pair["suite"]["name"], pair["data"]["asset"]["name"]
        if name in suites:
            suites[name] = replace(suites[name], table=table)
    return {s.table: s for s in suites.values()}

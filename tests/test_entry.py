"""The driver contract without the training-data subpackage."""

from __future__ import annotations

import runpy
import sys
from pathlib import Path

ENTRY = str(Path(__file__).resolve().parents[1] / "__spark_entry__.py")


class Missing:
    def __init__(self, name):
        self.name = name

    def find_spec(self, name, path=None, target=None):
        if name == self.name:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)


def test_subpackage_can_be_left_out(monkeypatch):
    for loaded in [m for m in sys.modules if m.startswith(("claimlens.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, loaded)
    monkeypatch.setattr(sys, "meta_path", [Missing("claimlens.llm"), *sys.meta_path])
    names = runpy.run_path(ENTRY)["queries"]()
    assert "severity_by_year" in names
    assert not any(n.startswith("op") or n == "pipeline" for n in names)

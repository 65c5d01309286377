"""What the driver contract does when modules of the subpackage are missing."""

from __future__ import annotations

import runpy
import sys
from pathlib import Path

import pytest

ENTRY = str(Path(__file__).resolve().parents[2] / "__spark_entry__.py")


class Missing:
    def __init__(self, name):
        self.name = name

    def find_spec(self, name, path=None, target=None):
        if name == self.name:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)


def without(monkeypatch, name):
    for loaded in [m for m in sys.modules if m.startswith(("claimlens.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, loaded)
    monkeypatch.delitem(sys.modules, name, raising=False)
    monkeypatch.setattr(sys, "meta_path", [Missing(name), *sys.meta_path])
    return runpy.run_path(ENTRY)["queries"]()


@pytest.mark.parametrize("name", ["claimlens.llm", "corpus_pipeline"])
def test_subpackage_and_pipeline_can_be_left_out(monkeypatch, name):
    names = without(monkeypatch, name)
    assert "severity_by_year" in names and "pipeline" not in names
    assert ("op1_simhash" in names) == (name == "corpus_pipeline")


@pytest.mark.parametrize("name", ["claimlens.llm.packing", "claimlens.llm.oracles"])
def test_what_they_need_cannot(monkeypatch, name):
    with pytest.raises(ModuleNotFoundError):
        without(monkeypatch, name)

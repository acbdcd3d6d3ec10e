"""Registration of the queries without the packages that only an optional part needs."""

from __future__ import annotations

import importlib.util
import os
import sys
import warnings

import pytest

ENTRY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")


@pytest.mark.parametrize("package", ["ahocorasick", "zstandard", "xxhash", "regex", "public_tokenizers", "stellata.llm"])
def test_a_missing_package_leaves_the_other_queries(monkeypatch, package):
    for name in list(sys.modules):
        if name.startswith(("stellata.llm", "corpus_pipeline")) or name == package:
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, package, None)  # its import fails
    spec = importlib.util.spec_from_file_location("entry_without", ENTRY)
    module = importlib.util.module_from_spec(spec)
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        spec.loader.exec_module(module)
    if package != "stellata.llm" and os.path.exists(os.path.join(os.path.dirname(ENTRY), "corpus_pipeline.py")):
        assert any(package in str(w.message) for w in said)
    own = module.queries()
    assert len(own) >= 55 and not [q for q in own if q.startswith("op")] and "pipeline" not in own
    assert set(module.oracle_sql()) <= set(own)


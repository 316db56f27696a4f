"""Every core query: against its SQL where it has one, else it must run with a stable schema."""

import pytest

from linecorpus.plans import catalog

@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_sql(name, same):
    same(catalog.queries()[name], catalog.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(name, spark, data):
    df = catalog.queries()[name](spark, data)
    assert df.columns
    # all columns are made and written, not counted away
    df.write.format("noop").mode("overwrite").save()


def test_flagship(spark, data):
    assert catalog.flagship(spark, data).count() > 0


def test_entry_works_without_llm(monkeypatch):
    import importlib.util
    import sys

    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, *a: None if n.startswith("linecorpus.llm") else real(n, *a))
    sys.modules.pop("__spark_entry__", None)
    import __spark_entry__ as e

    assert set(e.queries()) == set(catalog.queries())
    assert set(e.oracle_sql()) == set(catalog.oracle_sql())
    sys.modules.pop("__spark_entry__", None)


def test_no_core_module_imports_llm():
    from pathlib import Path

    root = Path(catalog.__file__).parents[1]
    for p in root.rglob("*.py"):
        if p.relative_to(root).parts[0] != "llm":
            assert "linecorpus.llm" not in p.read_text(), p

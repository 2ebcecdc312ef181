import __spark_entry__ as e


def test_registry():
    q, o = e.queries(), e.oracle_sql()
    assert "p3_found" in q and set(o) <= set(q) and len(q) > 50


def test_core_needs_no_other_subpackage():
    import pathlib
    import re

    root = pathlib.Path(e.__file__).parent / "telarium"
    for f in root.rglob("*.py"):
        if "llm" not in f.parts:
            assert not re.search(r"telarium[./]llm|from \.+llm", f.read_text()), f

"""The entry works without the folder of training-data operators, and hides no other import error."""

import subprocess
import sys

import pytest

import __spark_entry__


def test_without_the_optional_folder():
    code = "import sys; sys.modules['quire.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'repeated_lines' in q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], check=True)


def test_other_import_errors_are_not_hidden(tmp_path, monkeypatch):
    (tmp_path / "broken_module.py").write_text("import a_module_that_is_not_there\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    with pytest.raises(ModuleNotFoundError):
        __spark_entry__._optional("broken_module")
    assert __spark_entry__._optional("a_module_that_is_not_there") is None

"""The entry works with and without the optional subpackage."""

import os
import subprocess
import sys

import pytest

from souk.catalog import QUERIES
from tests.conftest import ROOT


@pytest.mark.parametrize("missing", ["souk.llm", "souk.llm.queries", "xxhash"])
def test_queries_without_the_subpackage_or_what_it_needs(missing):
    """An empty module table entry makes the import fail."""
    code = (f"import sys; sys.path.insert(0, {ROOT!r}); sys.modules[{missing!r}] = None; "
            "import __spark_entry__ as e; print(*e.queries())")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         cwd="/tmp", env={**os.environ, "PYTHONDONTWRITEBYTECODE": "1"})
    assert out.returncode == 0, out.stderr
    assert set(QUERIES) <= set(out.stdout.split())
    if missing != "xxhash":
        assert set(QUERIES) == set(out.stdout.split())

"""Every registered query against its SQL twin."""

import subprocess
import sys
from pathlib import Path

import pytest
from conftest import SF_DIR

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from compare import connect, differences  # noqa: E402

import __spark_entry__ as driver  # noqa: E402
from limitlens.queries.oracle import ORACLE  # noqa: E402
from limitlens.queries.registry import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, con, name):
    assert differences(spark, con, SF_DIR, name) is None


def test_every_twin_has_a_query():
    assert set(driver.oracle_sql()) - set(driver.queries()) == set()
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert driver.entry(spark).count() == 46


HIDDEN = """
import sys

class Hide:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(HIDE):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Hide())
import __spark_entry__ as driver
print(*sorted(driver.queries()))
print(*sorted(driver.oracle_sql()))
"""


@pytest.mark.parametrize("hidden", [("limitlens.llm",), ("limitlens.llm", "corpus_pipeline"), ("corpus_pipeline",)])
def test_entry_works_without_the_training_data_part(hidden):
    root = Path(__file__).resolve().parents[1]
    run = subprocess.run(
        [sys.executable, "-c", HIDDEN.replace("HIDE)", f"{hidden!r})")], cwd=root, capture_output=True, text=True, timeout=120
    )
    assert run.returncode == 0, run.stderr
    names, twins = (line.split() for line in run.stdout.splitlines())
    assert set(QUERIES) <= set(names) and set(ORACLE) <= set(twins)
    if "limitlens.llm" in hidden:
        assert set(names) == set(QUERIES)
    else:
        assert "pipeline" not in names

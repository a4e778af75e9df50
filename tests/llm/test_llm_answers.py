"""Every query of the subpackage that has SQL, against it; the rest runs over its whole tables."""

import sys

import pytest

import __spark_entry__ as entry
import compare
from plumbline.llm import oracles, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.database(SF_DIR)


def test_registered():
    assert set(queries.queries()) <= set(entry.queries())
    assert set(oracles.oracles()) <= set(queries.queries())
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in entry.queries())] == []
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(oracles.oracles()))
def test_answer(spark, connection, name):
    assert compare.difference(queries.queries()[name](spark, SF_DIR), connection, oracles.oracles()[name]) is None


def test_nothing_else_imports_it():
    import subprocess

    code = ("import sys; sys.modules['corpus_pipeline'] = None; import plumbline, catalogue.queries, plumbline.jobs; "
            "assert not [m for m in sys.modules if m.startswith('plumbline.llm')]")
    assert subprocess.run([sys.executable, "-c", code]).returncode == 0

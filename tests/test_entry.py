"""The entry module without the optional subpackage, or without what it needs."""

import os
import subprocess
import sys

import pytest

from tideline.plans.registry import ORACLE, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(*missing):
    code = ("import sys\n" + "".join(f"sys.modules[{m!r}] = None\n" for m in missing)
            + "import __spark_entry__ as e\nprint(*sorted(e.queries()))\nprint(*sorted(e.oracle_sql()))")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return [set(line.split()) for line in done.stdout.splitlines()]


@pytest.mark.parametrize("missing", [("tideline.llm",), ("tideline.llm.registry", "corpus_pipeline"), ("public_tokenizers",)])
def test_core_queries_do_not_need_the_optional_subpackage(missing):
    queries, oracle = names(*missing)
    assert queries == set(QUERIES) and oracle == set(ORACLE)


def test_only_the_pipeline_hangs_on_its_file():
    every, _ = names()
    without, _ = names("corpus_pipeline")
    assert "pipeline" not in without and every - without <= {"pipeline"}

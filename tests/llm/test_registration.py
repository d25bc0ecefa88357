import os
import re
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_one_query_per_operator_and_the_pipeline():
    names = [q for q in entry.queries() if re.match(r"op\d+_", q)]
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()


def test_entry_works_without_the_package():
    code = ("import sys; sys.modules['trestle.llm'] = None\n"
            "import __spark_entry__ as e\n"
            "q = e.queries()\n"
            "assert 'revenue_metrics' in q and 'pipeline' not in q and 'op2_byte_bpe' not in q, sorted(q)\n"
            "assert set(e.oracle_sql()) <= set(q)\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_the_package():
    found = []
    for folder, _, files in os.walk(os.path.join(ROOT, "trestle")):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py") and "trestle.llm" in open(os.path.join(folder, f), encoding="utf-8").read():
                found.append(f)
    assert found == []

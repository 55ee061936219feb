"""The entry points with and without the operators for training data."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), sum(n[:2] == 'op' for n in q), 'pipeline' in q, set(o) <= set(q))"
HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[0] == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hidden())
"""


def counted(code):
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    total, operators, pipeline, twins = run.stdout.split()
    return int(total) - int(operators) - (pipeline == "True"), int(operators), twins == "True", run.stderr


def test_without_a_module_of_the_operators():
    from botiquin.plans.registered import QUERIES

    for name in ("tokenizers", "public_tokenizers"):
        own, operators, twins, said = counted(HIDE.format(name=name) + COUNT)
        assert (own, operators, twins) == (len(QUERIES), 0, True) and "left out" in said and name in said


def test_without_the_pipeline():
    own, operators, twins, _ = counted(HIDE.format(name="corpus_pipeline") + COUNT)
    assert own >= 79 and operators == 0 and twins

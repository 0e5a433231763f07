"""The registered queries do not depend on the operators for training data."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
BLOCK = "import sys; sys.path.insert(0, {root!r}); sys.modules[{name!r}] = None; import __spark_entry__ as e; print(*sorted(e.queries()))"


def names_without(module):
    done = subprocess.run([sys.executable, "-c", BLOCK.format(root=str(ROOT), name=module)], capture_output=True, text=True, check=True)
    return set(done.stdout.split())


def test_other_queries_stay_without_the_training_data_part():
    rest = names_without("kerbflow.llm")
    assert len(rest) > 100 and not any(n.startswith("op") or n == "pipeline" for n in rest)


def test_no_other_module_imports_it():
    for path in [*ROOT.glob("kerbflow/**/*.py"), *ROOT.glob("workload/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path

"""The entry points work without the subpackage of training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_without_the_subpackage(tmp_path):
    shutil.copytree(f"{ROOT}/firelark", tmp_path / "firelark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(f"{ROOT}/{name}", tmp_path)
    code = "import sys; sys.dont_write_bytecode = True; import __spark_entry__ as e; q = e.queries(); assert set(q) == set(e.oracle_sql()) and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)


def test_nothing_else_imports_it():
    for folder, _, names in os.walk(f"{ROOT}/firelark"):
        for n in names:
            if n.endswith(".py") and "/llm" not in folder:
                assert "firelark.llm" not in open(os.path.join(folder, n)).read()

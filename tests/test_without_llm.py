"""The rest of the library stands without the training-text operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_without_the_operators(tmp_path):
    for name in ("__spark_entry__.py", "bench.py"):
        shutil.copy(ROOT / name, tmp_path)
    shutil.copytree(ROOT / "sluice", tmp_path / "sluice", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q) and len(q) > 90; assert not [n for n in q if n.startswith('op') and n[2].isdigit()]; assert 'pipeline' not in q"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=300)


def test_nothing_else_imports_the_operators():
    others = [p for p in (ROOT / "sluice").rglob("*.py") if "llm" not in p.parts]
    assert others and not [p for p in others if "sluice.llm" in p.read_text()]

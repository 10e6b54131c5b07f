import re
import sys
from pathlib import Path


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_rest_does_not_import_the_pipeline_part():
    top = Path(__file__).resolve().parents[1] / "folioforge"
    for p in top.rglob("*.py"):
        if "llm" not in p.relative_to(top).parts:
            assert not re.search(r"^\s*(?:from|import)\b.*\bllm\b", p.read_text(), re.M), p


def test_entry_without_the_pipeline_part(tmp_path):
    import shutil
    import subprocess

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "folioforge", tmp_path / "folioforge", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 100 and not any(k.startswith('op') for k in e.queries()); assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "HOME": "/root", "PYTHONPATH": str(tmp_path)})

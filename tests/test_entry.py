import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_optional_parts(tmp_path):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'quote_grounding' in q and not any(n.startswith('op') and n[2].isdigit() for n in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True, timeout=120)

"""The entry module and the package as others find them: parts left out, workers without the package on their path."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def run(code, cwd, **env):
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", code], cwd=cwd, env=clean | env, capture_output=True, text=True, timeout=300)


def test_entry_without_the_training_data_operators(tmp_path):
    shutil.copytree(ROOT / "tickloom", tmp_path / "tickloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for left in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / left).exists():
            shutil.copy(ROOT / left, tmp_path / left)
        done = run("import __spark_entry__ as e; print(len(e.queries()), sorted(x for x in e.queries() if x[:2] == 'op' or x == 'pipeline'))", tmp_path)
        assert done.returncode == 0, done.stderr
        assert int(done.stdout.split()[0]) > 100 and done.stdout.split(maxsplit=1)[1].strip() == "[]"


def test_workers_get_the_package(tmp_path):
    """The package lies on the driver's path only, and workers start in another folder."""
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from tickloom.session import local_session, ship
spark = local_session(2, shuffle_partitions=2, memory="1g")
ship(spark)
ship(spark)
def where(batches):
    from tickloom.functions import scalars
    for b in batches:
        yield b.select(["id"])
print("rows", spark.range(10).mapInArrow(where, "id long").count())
spark.stop()
"""
    done = run(code, tmp_path)
    assert "rows 10" in done.stdout, done.stderr[-2000:]

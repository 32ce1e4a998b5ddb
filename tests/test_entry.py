"""The driver's contract: every query of the engine against its SQL counterpart, and imports without the optional part."""

import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from citeweave.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    got = registry.queries()[name](spark, FOLDER)
    rows = Counter(tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in got.collect())
    if sql := registry.oracle_sql().get(name):
        wanted = con.execute(f"select {', '.join(chr(34) + c + chr(34) for c in got.columns)} from ({sql})").fetchall()
        assert rows == Counter(tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in wanted)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_import_without_optional_part(tmp_path, with_pipeline):
    """A copy without the optional folders imports and has the engine's queries, whether or not the pipeline's module is left."""
    root = Path(__spark_entry__.__file__).parent
    shutil.copytree(root / "citeweave", tmp_path / "citeweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    if with_pipeline and (root / "corpus_pipeline.py").exists():
        shutil.copy(root / "corpus_pipeline.py", tmp_path)
    # Nothing but the copy may be found, whatever the environment's path is.
    code = f"import sys; sys.path.insert(0, {str(tmp_path)!r}); import __spark_entry__ as e; from citeweave.plans import registry; assert set(e.queries()) == set(registry.queries()) and e.oracle_sql(); assert {str(tmp_path)!r} in registry.__file__"
    subprocess.run([sys.executable, "-B", "-I", "-c", code], cwd=tmp_path, check=True)

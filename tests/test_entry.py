import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    return float(v) if isinstance(v, int) and not isinstance(v, bool) else v if v is None or isinstance(v, (bool, str)) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n not in ("pipeline", "render_parse_roundtrip")))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted([tuple(map(plain, r)) for r in df.select(*columns).collect()], key=repr)
    result = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted([tuple(plain(r[i]) for i in at) for r in result.fetchall()], key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() == 1


def test_the_rest_works_without_the_optional_operators(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True)
    # A folder of compiled files may stay behind.
    (copy / "loomspark" / "llm" / "__pycache__").mkdir(parents=True)
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True)


def test_the_rest_works_without_a_library_of_the_optional_operators():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; assert 'run_summary' in e.queries() and 'op4_simhash' not in e.queries(); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)

"""Column stemming against the per-word function, and queries away from the repository."""

import os
import subprocess
import sys

import pytest

from conftest import MEDIUM, SMALL
from kestrel.functions import porter, porter_sql
from kestrel.functions import text as X
from kestrel.plans import q_text
from kestrel.session import local_fallback


def test_stems_of_the_whole_vocabulary(spark):
    words = q_text.stem_vocabulary(spark, MEDIUM).collect()
    assert len(words) > 50_000
    assert [r.word for r in words if porter.stem(r.word) != r.stem] == []


def test_y_and_double_letters(spark):
    words = ["y", "yy", "yyy", "toy", "syzygy", "say", "happy", "dying", "yes", "bay", "playing",
             "hopping", "hissing", "falling", "filing", "failing", "agreed", "feed", "sky", "oed",
             "ying", "aing", "ee", "eee", "lll", "yyyyyyyyying", "yyyyyyyyyyying", "sayyying", "cyyyyyed", "y" * 40 + "ings", "adoption", "controll", "rate", "cease", "is", "a"]
    d = spark.createDataFrame([(words,)], "t array<string>")
    got = d.select(X.porter_stems("t").alias("s")).first().s
    assert got == [porter.stem(w) for w in words]


def test_no_python_in_the_plans(spark):
    for q in (q_text.clean_text, q_text.double_stem):
        plan = q(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_duckdb_and_spark_text_differ_only_in_syntax():
    a, b = porter_sql.stems("t"), porter_sql.stems("t", porter_sql.DUCKDB)
    assert a.count("LIKE") == b.count("LIKE")


def test_query_from_a_foreign_folder(tmp_path):
    """Workers find nothing of the package: no PYTHONPATH, another working directory."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {repo!r})\n"
            "from kestrel.session import build_session\nfrom kestrel.plans import q_text\n"
            "s = build_session('local[2]', 4)\n"
            f"print('ROWS', q_text.clean_text(s, {SMALL!r}).count())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=300)
    assert "ROWS 200" in out.stdout, out.stderr[-500:]


def test_no_local_fallback_on_a_cluster():
    with pytest.raises(RuntimeError):
        local_fallback("spark://host:7077")
    with pytest.raises(RuntimeError):
        local_fallback("local-cluster[2,1,1024]")
    assert os.path.isdir(local_fallback("local[4]"))

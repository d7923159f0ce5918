"""The registry imports without looking into Spark's install folder."""

import glob
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_import_without_jars():
    code = ("import glob, zipfile\n"
            "glob.glob = lambda *a, **k: []\n"
            "def no(*a, **k): raise OSError('no archives')\n"
            "zipfile.ZipFile = no\n"
            "import __spark_entry__ as e\n"
            "assert len(e.queries()) >= 85 and len(e.oracle_sql()) >= 80")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_stop_words_equal_spark_default():
    import zipfile

    import pyspark

    from sentiscope.functions.text import SPARK_ENGLISH_STOPWORDS

    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    if not jars:
        pytest.skip("Spark's jars are elsewhere")
    with zipfile.ZipFile(jars[0]) as z:
        words = z.read("org/apache/spark/ml/feature/stopwords/english.txt").decode().split("\n")
    assert SPARK_ENGLISH_STOPWORDS == tuple(w for w in words if w)


def test_missing_plan_module_raises(monkeypatch):
    from sentiscope import catalog

    monkeypatch.setattr(catalog, "PLAN_MODULES", ("no_such_module",))
    with pytest.raises(ModuleNotFoundError):
        catalog.load_all()

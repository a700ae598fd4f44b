import subprocess
import sys
import textwrap


def test_workers_get_the_package(tmp_path):
    """A session started elsewhere, whose workers know nothing of the repository's folder."""
    code = textwrap.dedent("""
        import sys
        sys.path.insert(0, sys.argv[1])
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        import __spark_entry__ as entry
        print("ROWS", entry.queries()["op7_quality"](spark, "/root/testdata/sf0.001").count())
    """)
    (tmp_path / "run.py").write_text(code)
    repo = __file__.rsplit("/tests/", 1)[0]
    done = subprocess.run([sys.executable, "run.py", repo], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "ROWS 200" in done.stdout, done.stderr[-2000:]

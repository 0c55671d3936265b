"""What the launcher sets wins over the library's defaults."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(code, submit="", **env):
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300,
                          env=os.environ | {"PYSPARK_SUBMIT_ARGS": f"{submit} pyspark-shell"} | env)


def test_launcher_settings_win():
    code = ("from strata.session import build_session; s = build_session(); "
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), "
            "s.conf.get('spark.sql.session.timeZone'))")
    p = _run(code, "--master local[3] --conf spark.sql.shuffle.partitions=333 --conf spark.ui.enabled=false")
    assert "GOT local[3] 333 UTC" in p.stdout, p.stderr[-2000:]


def test_defaults_without_launcher():
    code = ("from strata.session import build_session; s = build_session(); "
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))")
    p = _run(code, BENCH_CPUS="2")
    assert "GOT local[2] 2" in p.stdout, p.stderr[-2000:]


def test_no_private_folder_off_a_local_master():
    import pytest

    from strata.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())

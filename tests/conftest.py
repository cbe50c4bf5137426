import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from quarry.session import ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[4]").appName("quarry-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quarry-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def write_file(tmp_path):
    """Write ``content`` (str or bytes) to a file under tmp_path; return its path."""
    def w(name, content):
        p = tmp_path / name
        if isinstance(content, str):
            content = content.encode("utf-8")
        p.write_bytes(content)
        return str(p)
    return w

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from revlens.session import build_session

    # Tests run without a cluster-provided spark.checkpoint.dir: use a fresh
    # scratch folder of our own.
    ckpt = tempfile.mkdtemp(prefix="revlens-test-ckpt-")
    s = build_session("local[*]", app_name="revlens-tests", shuffle_partitions=8,
                      extra_conf={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture
def write_csv_file(tmp_path):
    """Write text to ``tmp_path/<name>`` and return the path."""

    def _write(name: str, text: str) -> str:
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
        return str(p)

    return _write

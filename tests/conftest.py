import os
import sys
import zipfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("lading-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def workdir(spark):
    from lading.session import scratch_path

    return scratch_path(spark, "test")


def make_zip(path: str, entries: dict) -> None:
    """Write an archive; values are str (UTF-8) or bytes."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", compression=zipfile.ZIP_DEFLATED) as zf:
        for name, data in entries.items():
            zf.writestr(name, data.encode("utf-8") if isinstance(data, str) else data)


@pytest.fixture()
def land(workdir):
    """land(provider, version, entries) → writes an archive into the landing
    folder and returns the landing root."""
    root = f"{workdir}/landing"

    def _land(provider, version, entries, name="feed.zip"):
        make_zip(f"{root}/provider={provider}/version={version}/{name}", entries)
        return root

    return _land

"""Session helpers: a local session for tests and benches, and the shared
scratch folder taken from ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "lading",
                  shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benches on one machine.  Cluster jobs take the
    session their launcher built; nothing here is required there."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide scratch folder: ``spark.checkpoint.dir``.

    On a cluster this names shared storage.  Only when the setting is absent
    (tests, a laptop) do we create one and register it, so that later
    ``checkpoint()`` calls and our staged tables land in the same place.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        # Only sessions without the setting (tests, a laptop) get here; a
        # cluster names shared storage.  spark.checkpoint.dir is a core
        # setting that cannot change at run time, so the context is told.
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="lading-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared scratch folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by ``BATCH_BYTES``.  Ten thousand whole texts in one
    batch take much of an executor's memory outside the heap: in the JVM, in
    the worker, and on the way back."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers.

    Functions run by ``mapInArrow`` are pickled by reference, so executors
    must be able to import ``lading``.  The package is zipped into the shared
    scratch folder and added with ``addPyFile`` once per application — the
    usual way to ship Python code to a cluster; harmless where the package
    is installed already.
    """
    import hashlib
    import io
    import os
    import zipfile

    import lading
    from lading.sources.fs import exists, open_output

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(lading.__file__))
    base = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, dirnames, files in os.walk(pkg):
            dirnames[:] = sorted(d for d in dirnames if d != "__pycache__")
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    with open(full, "rb") as fh:
                        zf.writestr(os.path.relpath(full, base), fh.read())
    data = buf.getvalue()
    path = f"{shared_dir(spark)}/pyfiles/lading-{hashlib.sha1(data).hexdigest()[:16]}.zip"
    if not exists(path):
        with open_output(path) as out:
            out.write(data)
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)

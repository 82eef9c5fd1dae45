"""Session helpers: building a session for tests/bench and finding the shared work folder.

Intermediate tables (block logs written by a query, stream sinks and
checkpoints) go under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (local tests)
do we create one of our own.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"
#: Drops a query's shuffle files when it has ended, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, app: str = "sweepframe",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with the settings the library relies on."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Register the custom source and set session options the operators need.

    Safe to call repeatedly and on a session built by someone else.
    """
    from sweepframe.sources.blocklog import BlockLogDataSource
    from sweepframe.sources.namedfiles import NamedFilesDataSource

    _ship_package(spark)
    spark.dataSource.register(BlockLogDataSource)
    spark.dataSource.register(NamedFilesDataSource)
    # Parameter CSVs must fail on short rows even when few columns are read.
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")
    # Header maps: a later key overrides an earlier one, as in a dict.
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    # Rows given to Python may name blocks of 64 KiB: batches stay bounded.
    records = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(records, "10000")) <= 2048:
        spark.conf.set(records, "2048")
    work_root(spark)
    return spark


def _ship_package(spark: SparkSession) -> None:
    """Make the package usable in Python workers, once per SparkContext.

    Functions and data-source classes travel inside the pickled command (by
    value), so a Python process that never sees added files needs nothing
    installed; one zip goes out with ``addPyFile`` for imports inside them.
    The zip is built on the driver, whose file server hands it to executors.
    """
    import sys
    import zipfile

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules["sweepframe"])
    sc = spark.sparkContext
    if getattr(sc, "_sweepframe_pyfile", None):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    zpath = os.path.join(tempfile.mkdtemp(prefix="sweepframe-pkg-"), f"sweepframe-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(pkg):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(base, n)
                    z.write(full, os.path.join("sweepframe", os.path.relpath(full, pkg)))
    sc.addPyFile(zpath)
    sc._sweepframe_pyfile = zpath


def work_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediate tables.

    ``spark.checkpoint.dir`` names it; else the folder given to
    ``setCheckpointDir``; else, in local mode only, a temporary folder of
    our own.  The setting itself is static and is only ever read.  Paths
    are passed on as Hadoop paths, with whatever scheme they have.
    """
    sc = spark.sparkContext
    root = getattr(sc, "_sweepframe_root", None)
    if root:
        return root
    root = spark.conf.get(_CKPT_KEY, None) or sc.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="sweepframe-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:|/", root):
        root = os.path.abspath(root)
    sc._sweepframe_root = root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared work folder."""
    return f"{work_root(spark).rstrip('/')}/sweepframe/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """The queries run inside leave no shuffle files behind."""
    kept = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if kept is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, kept)

"""Session set-up shared by tests, bench and the driver entry points.

Settings follow SURVEY 2.X.1: UTC session zone, ``timestamp_ntz`` as the default
timestamp type (so wall-clock hours never move), ANSI mode left on, AQE on so
that skewed shuffle partitions are split and small join sides are broadcast only
after their runtime size is known.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # cp949 / euc-kr readers (S3) need the legacy charset list in Spark 4.
    "spark.sql.legacy.javaCharsets": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "stationflow", extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and bench, with ``extra`` settings. On a cluster, use the
    cluster's session and call :func:`configure` on it instead."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``stationflow`` importable in the Python workers (the grouped pandas
    functions are pickled by reference to their module). The package is zipped once
    per SparkContext and added with ``addPyFile``, as ``--py-files`` would on a
    cluster; a worker that can already import it is unaffected."""
    sc = spark.sparkContext
    if getattr(sc, "_stationflow_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="stationflow-pkg-"), "stationflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    sc._stationflow_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder for lineage cuts.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is used as
    given. Only when the setting is absent (local tests) a private scratch folder
    is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="stationflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return configured

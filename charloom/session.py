"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_CKPT_CONF = "spark.checkpoint.dir"
_SHIPPED: set = set()


def get_spark(master: str | None = None, app: str = "charloom",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session or build a local one configured for this library."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = (SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         # checkpoints go with the frames that read them
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         # one BLAS thread per Python worker: Spark already runs one worker per core
         .config("spark.executorEnv.OPENBLAS_NUM_THREADS", "1")
         .config("spark.executorEnv.OMP_NUM_THREADS", "1"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``charloom`` importable in the Python workers of this session's
    context (tasks unpickle functions defined in the package), as
    ``--py-files`` would: zip the package once per SparkContext and add it."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="charloom-pkg-"), f"charloom_{os.getpid()}_{len(_SHIPPED)}.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.join("charloom", os.path.relpath(full, root)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset
    (local runs and tests) create a private scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CKPT_CONF, None) or sc.getConf().get(_CKPT_CONF, None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError(f"set {_CKPT_CONF} to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="charloom-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured

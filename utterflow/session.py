"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "utterflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session tuned for the corpus plans.

    AQE stays on so shuffle partition counts and skewed joins are re-planned at
    run time; the broadcast threshold is left at Spark's size-checked default,
    so only sides whose *measured* size is below it are broadcast.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # text work is CPU-bound per byte (regex, edit distance): 64 MB input
        # splits give 2x the scan tasks of the default for better balance,
        # still far above per-task overhead at 100 TB (~1.6M tasks)
        "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # whole transcripts are long: small Arrow batches bound Python-worker
        # memory and keep the JVM and Python sides of a task overlapping
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        "spark.driver.memory": os.environ.get("UTTERFLOW_DRIVER_MEMORY", "16g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``utterflow`` importable in executor Python workers.

    Pandas UDFs and mapInPandas functions defined in this package are
    pickled by reference, so workers must import it. The package is zipped
    once per SparkContext and distributed with ``addPyFile``.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:             # e.g. Spark Connect: ship through artifacts instead
        sc, app = None, f"session-{id(spark)}"
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="utterflow-pkg-"), "utterflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only when it is unset in local mode (tests) a fresh scratch folder is
    made; on a cluster that would be one machine's disk, so it is an error.
    """
    d = spark.conf.get(CHECKPOINT_KEY, None)
    try:
        sc = spark.sparkContext
    except Exception:             # e.g. Spark Connect: the server owns the context
        sc = None
    if not d and sc is not None:
        d = sc.getConf().get(CHECKPOINT_KEY, None)
    if not d:
        master = sc.master if sc is not None else ""
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all nodes share (master: {master or 'remote'})")
        d = tempfile.mkdtemp(prefix="utterflow-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"

"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces partitions
# from runtime sizes, and splits skewed join partitions (a hot user or item).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Settings we would submit with at 100 TB (the submitter owns the session; these
# are recommendations, applied by nothing here): many shuffle partitions that
# AQE coalesces to ~256 MB, skew splitting on, input splits sized to executor
# memory, and the shared checkpoint folder for lineage cuts.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # "spark.checkpoint.dir": "<shared folder of the cluster>",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8,
              app_name: str = "sparkrec", extra: dict | None = None,
              driver_memory: str = "16g") -> SparkSession:
    """Local session for tests, the bench and dev tools. On a cluster the
    session comes from the submitter and only ``ensure_checkpoint_dir`` applies."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.driver.memory"] = driver_memory
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only a session without it (tests, local runs) gets a scratch
    folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir isn't set: a cluster needs a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="sparkrec-ckpt-", dir=os.environ.get("SPARKREC_SCRATCH"))
    sc.setCheckpointDir(path)
    return path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # read when a query ends


def materialize(df, tag: str = "t"):
    """Write ``df`` as Parquet under the reliable checkpoint folder and read it back.

    This cuts the lineage like ``checkpoint()`` and survives executor loss,
    but the re-read frame's size estimate comes from its files. (A checkpointed
    frame keeps the estimate of the plan it replaced; in iterative jobs those
    estimates compound, since an inner join is estimated as the product of its
    inputs.) The write's shuffle files go once it is done: nothing reads them again, and otherwise they would stay on
    the executors' disks until the driver happens to collect its garbage.
    """
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/sparkrec-tables/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.parquet(path)
    out._sparkrec_path = path
    return out


def drop_materialized(df) -> None:
    """Delete the table behind a ``materialize``d frame once nothing will read it."""
    path = getattr(df, "_sparkrec_path", None)
    if not path:
        return
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package's code, once for each application, as ``--py-files`` would.

    Python workers need it for functions that are more than one expression. The archive is written on the driver only; Spark's own file server hands it out.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="sparkrec-code-"), "sparkrec_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)

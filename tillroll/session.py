"""SparkSession construction and the shared working folder.

Cluster deployments pass their own session (with ``spark.checkpoint.dir``
pointing at a shared, durable folder).  Local runs and tests call
:func:`local_session`, which fills in the settings only where they are unset.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Spark notes the Python call site of every column expression otherwise, which slows the forming of large plans
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "tillroll") -> SparkSession:
    """A ``local[cores]`` session for tests, benches and the CLI."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir`` (read, never changed);
    only a local session with none at all -- tests, the bench -- gets a scratch
    folder, registered with ``SparkContext.setCheckpointDir``; any other
    master without the setting is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.split("[")[0] == "local":
        raise RuntimeError(f"spark.checkpoint.dir is not set: on {sc.master} the executors need a shared folder")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tillroll-ckpt-"))
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path inside the shared checkpoint folder (never machine-local on a
    cluster: the folder is whatever the cluster configured)."""
    root = ensure_checkpoint_dir(spark)
    return "/".join([root.rstrip("/"), *parts])


def unique_name(prefix: str) -> str:
    return f"{prefix}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def drop_work(spark: SparkSession, *parts: str) -> bool:
    """Delete a folder under the session's checkpoint folder (e.g.
    ``"tables"`` for the intermediate ranking inputs; no argument: everything
    this session wrote there) through the cluster's file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(work_path(spark, *parts))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))


def files_state(spark: SparkSession, paths) -> str:
    """Names, sizes and modification times of the files under ``paths``, as one
    digest, from listings through the cluster's file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            seen.append(f"{p} missing")
            continue
        found = fs.listFiles(path, True)
        while found.hasNext():
            st = found.next()
            seen.append(f"{st.getPath().toString()} {st.getLen()} {st.getModificationTime()}")
    return hashlib.sha1("\n".join(sorted(seen)).encode()).hexdigest()


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def remove_path(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))

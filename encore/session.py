"""Session helpers.

The engine needs two things from a session: UTC as the session zone (timestamps
are instants; local wall clocks are stored as TIMESTAMP_NTZ) and a checkpoint
directory on shared storage. Both are read from the session first; we only set
them where they are unset, as in tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # PySpark 4 records the Python call site of every Column call for error
    # messages (several JVM round trips each); plans are built faster without it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


#: Most tasks of a folder listing. Spark's default is a task a folder up to 10,000, each of which costs far more than
#: the listing of its folder; where a session leaves the default, a few tasks a core share the folders.
LISTING, LISTING_DEFAULT = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "10000"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "encore", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs; clusters bring their own config."""
    b = SparkSession.builder.master(master).appName(app_name)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", "8g")
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC (trap T1), bound the tasks of a listing and make sure a checkpoint dir exists."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get(LISTING, LISTING_DEFAULT) == LISTING_DEFAULT:
        spark.conf.set(LISTING, str(max(32, 4 * spark.sparkContext.defaultParallelism)))
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session names none and runs in local mode (tests) do we create
    a scratch folder; on a cluster a machine-local folder would not survive the
    loss of an executor, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder on shared storage for this cluster")
        d = tempfile.mkdtemp(prefix="encore-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return str(d)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for materialised intermediates."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{os.getpid()}-{next(_counter)}"


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()

"""Job options and the Spark session used by jobs, tests and the bench."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class JobOptions:
    """Settings of the ingest job.

    Fixed values: the defaults below are the reference's settings
    (broker, group id, topic, warehouse, table name and namespace, commit
    interval in ms).
    """

    bootstrap_servers: str = "localhost:9092"
    group_id: str = "iceberg-kafka-group"
    topic: str = "new-york-data"
    warehouse: str = "file:///path/to/data/warehouse"
    table_name: str = "json_data"
    table_namespace: str = "default"
    checkpoint_interval_ms: int = 300000

    @property
    def table_path(self) -> str:
        """K9: warehouse/namespace/name."""
        return f"{self.warehouse.rstrip('/')}/{self.table_namespace}/{self.table_name}"

    @property
    def trigger_interval(self) -> str:
        return f"{self.checkpoint_interval_ms // 1000} seconds"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tripstream") -> SparkSession:
    """Session with the settings the library relies on.

    * session time zone UTC: stored wall clocks are UTC (SURVEY §1.3);
    * AQE on, with skew handling for joins and rebalances;
    * no web UI.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if shuffle_partitions is None and master.split("[")[0] == "local":
            shuffle_partitions = 8
    if shuffle_partitions is not None:   # else the cluster's own setting holds
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TRIPSTREAM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tripstream`` importable in Python workers (as ``--py-files`` would).

    Done once per SparkContext: the package is zipped on the driver and
    handed to ``addPyFile``, which copies it to every executor.
    """
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    import tempfile
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, zpath = tempfile.mkstemp(prefix="tripstream-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    Read from ``spark.checkpoint.dir``; only on a local master (tests) a folder
    under the system temp dir is set when there is none.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        d = os.path.join(tempfile.gettempdir(), "tripstream-checkpoints")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_root(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint dir for one run."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tripstream/{label}-{uuid.uuid4().hex[:12]}"

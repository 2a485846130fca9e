"""Session helpers: one place for the settings every job in this package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the builders assume. Time zone UTC keeps date parts and text forms of
# zone-less timestamps stable; AQE re-plans joins from runtime sizes and splits
# skewed shuffle partitions.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files once their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "trip_star",
    shuffle_partitions: int | None = None,
    checkpoint_dir: str | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``checkpoint_dir`` is used only when the cluster names none in
    ``spark.checkpoint.dir``; tests and the bench pass a scratch folder.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        pass
    if checkpoint_dir:
        ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the reliable checkpoint folder, setting one only if none is configured.

    Order: the session's own checkpoint dir, then ``spark.checkpoint.dir``, then
    ``fallback``, then a folder inside the warehouse (shared storage on a
    cluster, like every managed table). A warehouse on the driver's own disk
    is refused unless the master is local: executors would not share it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect client: the server owns the folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    target = configured or fallback
    if not target:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if warehouse.startswith(("file:", "/")) and not sc.master.startswith("local"):
            raise ValueError("name a shared folder in spark.checkpoint.dir: the warehouse is on a local disk")
        target = warehouse.rstrip("/") + "/_trip_star_checkpoints"
    # setCheckpointDir creates the folder through the Hadoop file system.
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

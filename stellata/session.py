"""SparkSession defaults used by the library, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI arithmetic (overflow and bad casts raise, as
# the source warehouse does), adaptive execution (runtime broadcast of measured
# small sides, partition coalescing, skew-join splitting) and a fixed time zone.
_DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a join on (sk_municipio, sk_tempo) may use tables bucketed by sk_municipio
    # as they are, without re-shuffling on both keys
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "stellata", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster, ``master`` is left to spark-submit; locally pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names a shared (fault-tolerant) folder there. Only where it is unset, as
    in tests and local runs, a folder beside the session's warehouse is used: the
    warehouse is shared by the driver and the executors in any deployment."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")
    return sc.getCheckpointDir()

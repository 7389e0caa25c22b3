"""Session settings the job relies on.

``recommended_conf`` lists what a cluster submission should carry; the values
are sizing rules, not tuned to the test data. ``local_session`` is for tests and
single-node benchmarks.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def recommended_conf(shuffle_partitions: int) -> dict[str, str]:
    """Settings for the report job. ``shuffle_partitions``: input bytes / ~128 MB."""
    return {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        # Runtime re-planning: coalesce small shuffle partitions, split skewed ones.
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        # Text splits of 128 MB keep scan tasks short and retry cheap.
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        # Broadcasts are decided by the job after measuring, never guessed from
        # file sizes of text inputs.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "salaria",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    conf = recommended_conf(shuffle_partitions)
    # Small local inputs: let a few-MB file still split over all cores (the 4 MB
    # default open cost would keep it in one or two tasks).
    conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(16 * 1024 * 1024)
    conf["spark.sql.files.openCostInBytes"] = str(256 * 1024)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

"""Session settings for local runs (tests, bench).

Library functions never change session settings; they take the SparkSession
the caller built.  This module is only for local sessions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings this code is tuned for: adaptive execution re-plans joins from real
# shuffle sizes (broadcast when a side turns out small, split skewed
# partitions, merge tiny ones), and a fixed UTC zone keeps timestamps stable.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    warehouse_dir: str | None = None,
    driver_memory: str = "8g",
    app_name: str = "tableworks",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

"""A local session for tests and the benchmark; on a cluster, use the session the cluster gives."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", memory: str = "10g") -> SparkSession:
    partitions = str(cpus) if cpus != "*" else "8"
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("textgraph")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", partitions)
        # Most aggregates here have far more groups than the small first-level map holds.
        .config("spark.sql.codegen.aggregate.map.twolevel.enabled", "false")
        .getOrCreate()
    )

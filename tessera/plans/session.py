"""The Spark session of command lines and benches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(cores: str = "*", memory: str | None = None, partitions: int | None = None, spill: str | None = None, name: str = "tessera") -> SparkSession:
    """A session with adaptive plans; cores, memory and spill folder count only where all runs on this machine, not on a cluster that is there already."""
    conf = {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    conf |= {k: str(v) for k, v in (("spark.driver.memory", memory), ("spark.sql.shuffle.partitions", partitions), ("spark.local.dir", spill)) if v}
    return SparkSession.builder.appName(name).master(f"local[{cores}]").config(map=conf).getOrCreate()

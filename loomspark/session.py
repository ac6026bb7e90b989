"""Session helper for scripts, benchmarks and tests; on a cluster the caller brings the session."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(app: str = "loomspark", cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session in UTC with adaptive execution. Only for one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LOOMSPARK_DRIVER_MEMORY", memory))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.gettempdir(), "loomspark-warehouse"))
        .getOrCreate()
    )

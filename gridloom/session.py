"""Session settings that the engine's plans rely on."""
from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "gridloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; on a cluster, leave master unset and size shuffles by data."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    given = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.ui.enabled": "false"} | conf
    return builder.config(map=given).getOrCreate()

"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "veiledlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, which sizes shuffles and splits skewed joins at run time.

    Pass further settings with ``_`` for ``.``, e.g. ``spark_sql_shuffle_partitions="8"``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()

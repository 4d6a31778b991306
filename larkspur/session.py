"""Session settings the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps dates free of zone shifts, ANSI turns silent overflow and bad casts into errors, AQE sizes
# reduce tasks and splits skewed ones from what the map side really wrote.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "larkspur", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above.

    ``master`` stays unset on a cluster, where spark-submit decides.  ``conf`` keys use ``__`` for dots, for
    example ``spark__sql__shuffle__partitions="4000"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

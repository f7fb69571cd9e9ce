"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Sizes below are per task, so they hold whatever the volume of data.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot join key over several tasks, also where that costs a shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Wide cleaning projections compile to methods too long for the JVM to
    # optimise; above this size Spark generates split methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Bronze tasks write to few partitions each: keep these files open instead of
    # sorting all rows by partition. Beyond this number Spark sorts the rest.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # A partition folder called 007 must come back as text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Accident files name the same column in different cases.
    "spark.sql.caseSensitive": "false",
}


def make_session(
    app: str = "bronzeway",
    master: str | None = None,
    options: dict[str, str] | None = None,
) -> SparkSession:
    """Session for the jobs.

    ``options`` passes anything else through, such as an object-store connector
    or ``spark.sql.shuffle.partitions``. Master and sizes are left to
    ``spark-submit`` unless given.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(options or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def own_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster with the settings; the caller's stays as it is."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key) and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    for key, value in SETTINGS.items():
        own.conf.set(key, value)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the cluster shares (``spark.checkpoint.dir``).

    Only a local session may leave that setting out; it then gets a folder beside
    its warehouse. On a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-scratch"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/bronzeway/{name}-{uuid.uuid4().hex}"

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SQL_SETTINGS = {
    # received_at is an instant; dates are derived in UTC
    "spark.sql.session.timeZone": "UTC",
    # a rerun of a day replaces only that day's partition
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.adaptive.enabled": "true",
    # a visitor or a video may own a third of the rows: split its join partition at run time
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # also where an aggregation could have reused the join's partitioning: a hot key must not
    # be aggregated in one task to save a shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # no join in this package is hinted: a side is broadcast only when Spark finds it below
    # this size, and every other join shuffles
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
}


# Read when the context starts. Recording the Python call site of every column costs more than
# planning a wide query; switch it on to trace an error.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "reelstar", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_SETTINGS, **SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    Only a local session without that setting falls back to a temporary folder; on a cluster
    a machine-local path would be lost with its executor, so the setting is demanded there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        root = _LOCAL_ROOTS.get(app) or tempfile.mkdtemp(prefix="reelstar-")
        _LOCAL_ROOTS[app] = root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """Zero rows of a schema, known to be empty when the query is planned.

    Spark then drops joins with it from the plan, which it cannot do for an empty RDD.
    """
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*nulls).limit(0)


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a frame that feeds several jobs to the shared scratch folder and read it back.

    Unlike a cache it survives lost executors, and it is read in the given session: a stream's
    own session plans without adaptive execution.
    """
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

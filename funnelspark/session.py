"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this package expects. None of them depends on the data size:
#: AQE sizes the shuffles and splits skewed join partitions at run time.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python call site of every column costs a round trip to the JVM each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The constraint sets of stacked derived columns double with every alias; operators that need a
    # not-NULL filter below a join state it themselves.
    "spark.sql.constraintPropagation.enabled": "false",
}


def build_session(app: str = "funnelspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`SESSION_CONF`; extra settings as keyword ``spark_sql_x=...`` pairs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


_PRIVATE_ROOTS: dict[str, str] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new empty path under the shared folder named by ``spark.checkpoint.dir``.

    Where the session names none, a private temporary folder is used in local mode (one machine, as in unit tests); on a
    cluster that is an error, since executors and driver do not share such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        root = _PRIVATE_ROOTS.setdefault(app, "") or tempfile.mkdtemp(prefix="funnelspark-")
        _PRIVATE_ROOTS[app] = root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

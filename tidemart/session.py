"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE sizes shuffles and splits skewed join sides at run time; the time zone is
# pinned so that casts between TIMESTAMP and TIMESTAMP_NTZ are stable.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


MIB = 1 << 20


def cluster_settings(input_bytes: int) -> dict[str, str]:
    """Partition sizes for a job over ``input_bytes``, to pass to ``build_session``.

    Adaptive execution merges shuffle partitions but never adds any, so the
    starting number must suit the data: about 128 MiB each, which an executor
    core sorts and aggregates in memory. At least 200, with no upper limit.

        build_session("job", **{k.replace(".", "__"): v for k, v in cluster_settings(size).items()})
    """
    partitions = max(-(-input_bytes // (128 * MIB)), 200)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * MIB),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MIB),
    }


def build_session(app: str = "tidemart", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder: on a cluster that
    folder would exist on one machine and its files would die with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tidemart-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def restage(df: DataFrame, path: str, session: SparkSession, **options: str) -> DataFrame:
    """Lineage cut for repeated use: a table that the next call replaces.

    It is read back by ``session``, so that a batch session can go on where a
    streaming one, which runs without adaptive execution, has produced rows.
    """
    df.write.mode("overwrite").options(**options).parquet(path)
    return session.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more, in any file system that Spark reaches."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)

"""Session defaults and the durable staging folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the library relies on; everything else stays at the cluster's own values.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_staged: list[str] = []


def local_session(cores: int = 8, **extra: str) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("emberline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; on a cluster a machine-local path
    would vanish with its executor, so an unset folder is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="emberline-stage-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def stage(df: DataFrame, *partition_by: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet to the staging folder and read it back; ``options`` are the writer's.

    Cuts lineage before a fan-out of several jobs, survives lost executors, and unlike an RDD
    checkpoint keeps column pruning, pushed filters and size statistics for the readers.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark).rstrip('/')}/staged/{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _staged.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files behind a stored table, as the file system lists them."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for name in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


def staged_so_far() -> int:
    """How many tables this process has staged; marks the begin of a job for ``drop_staged``."""
    return len(_staged)


def drop_staged(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Delete what this process staged since then, but for what ``keep`` reads.

    Nothing else read from it may be in use any more.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files = keep.inputFiles() if keep is not None else []
    kept = {p for p in _staged[since:] if any(p.rsplit("/", 1)[1] in f for f in files)}
    for staged in [p for p in _staged[since:] if p not in kept]:
        path = jvm.org.apache.hadoop.fs.Path(staged)
        path.getFileSystem(conf).delete(path, True)
    _staged[since:] = [p for p in _staged[since:] if p in kept]

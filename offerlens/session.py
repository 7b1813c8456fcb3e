"""Session defaults and the shared folder for tables handed from stage to stage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def local_session(cores: str | int = "*", **settings) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("offerlens")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local folder would lose data with its executor.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="offerlens-")
    return _local_folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nobody has used yet."""
    return f"{shared_folder(spark)}/offerlens/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage before a frame is read more than once. Unlike a cached
    frame it survives lost executors, and later reads prune columns.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by_key(df: DataFrame, name: str, key: Sequence[str], buckets: int) -> DataFrame:
    """Like ``stage``, but stored in buckets of the key, sorted in each.

    Tables staged with the same key types and number of buckets join and group on
    that key without a shuffle. The rows are brought together by key before the write, so a bucket
    is one file. The catalog of the session holds the table under a name of its own.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    table = "offerlens_" + path.rsplit("-", 1)[1]
    df.repartition(buckets, *[df[f"`{k}`"] for k in key]).write.bucketBy(buckets, *key).sortBy(*key).option("path", path).saveAsTable(table)
    return spark.table(table)

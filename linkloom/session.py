"""Session settings the jobs expect, and where intermediate data may be cut."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

# AQE splits skewed join partitions and coalesces small ones at run time; UTC keeps timestamps
# and the dates derived from them independent of the machine.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A session for tests and the benchmark; on a cluster use the one it provides."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("linkloom")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; only in local mode make one, and say so."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="linkloom-checkpoint-")
        warnings.warn(f"spark.checkpoint.dir is not set, using {folder}", stacklevel=2)
        context.setCheckpointDir(folder)
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the table to the shared checkpoint folder and read it back.

    Unlike a checkpoint the copy is columnar, so later reads take only the columns they need.
    ``discard`` deletes it; what is left goes when the driver's Python ends.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _left[path] = spark
    return spark.read.schema(df.schema).parquet(path)


#: Folders that ``stored`` wrote and nobody deleted yet.
_left: dict[str, SparkSession] = {}


def discard(table: DataFrame) -> None:
    """Delete the copy that ``stored`` made of a table; it can be read no more afterwards."""
    names = {file.rsplit("/", 2)[1] for file in table.inputFiles()}
    for path in [p for p in _left if p.rsplit("/", 1)[1] in names]:
        _delete(path)


def _delete(path: str) -> None:
    spark = _left.pop(path)
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@atexit.register
def _delete_what_is_left() -> None:
    for path in list(_left):
        try:
            _delete(path)
        except Exception:  # the session's JVM may be gone already; its folder is the cluster's to clear
            return

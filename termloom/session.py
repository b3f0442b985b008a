"""Session settings and the shared folder for relations that must outlive a job."""

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Joins go by measured sizes. An estimate from a scan knows nothing of the words
    # that its texts are split into.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # What durable() wrote goes when nothing can read it any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# What lets measured sizes choose between hashing and sorting.
MEASURED = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"

# Of each application, the folder of its scratch relations; and those that scratch() owns.
_FOLDERS: dict[str, str] = {}
_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def build_session(app_name: str = "termloom", **settings: str) -> SparkSession:
    """A session with the recommended settings; master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def measure_joins(spark: SparkSession) -> None:
    """Let a session that says nothing about it hash what is small in every partition.

    Spark's own default sorts both sides of each join, whatever their measured sizes.
    """
    if spark.conf.get(MEASURED, None) is None:
        spark.conf.set(MEASURED, SETTINGS[MEASURED])


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may go without: it gets a temporary folder.
    """
    context = spark.sparkContext
    folder = context.getConf().get(CHECKPOINT_DIR) or spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="termloom-")


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder below the shared one; it goes when the application ends."""
    context = spark.sparkContext
    if context.applicationId not in _FOLDERS:
        folder = f"{shared_folder(spark).rstrip('/')}/termloom-{uuid.uuid4().hex}"
        files, place = _file_system(spark, folder)
        files.mkdirs(place)
        files.deleteOnExit(place)
        _FOLDERS[context.applicationId] = folder
    return _FOLDERS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a relation that is needed for a while.

    It belongs to the innermost :func:`scratch` around the call, else to the application.
    """
    path = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owner of the scratch relations made inside: they are removed at its end.

    What is computed from them must be read or written inside, too.
    """
    made: list[str] = []
    before = _OWNED.set(made)
    try:
        yield
    finally:
        _OWNED.reset(before)
        for path in made:
            files, place = _file_system(spark, path)
            files.delete(place, True)


def release_shuffles(spark: SparkSession) -> None:
    """Have the files of shuffles that nothing can read any more deleted now.

    Spark deletes them when the driver's garbage is collected, which it may not be
    for as long as a whole pipeline runs. The listeners hold the plan of the last query
    until the next one, so a small one is run first.
    """
    spark.range(1).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def durable(relation: DataFrame) -> DataFrame:
    """Compute a relation once and keep it where lost executors cannot take it."""
    spark = relation.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return relation.checkpoint()

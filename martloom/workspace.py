"""Where written intermediates go.

On a cluster that is the shared folder of ``spark.checkpoint.dir``, so that a written table
outlives the executor that wrote it. Only a local master may fall back to a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_ROOTS[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


# Of written tables: half the bytes of the default, for little more work.
CODEC = "zstd"

# Older versions of Spark don't know the setting, and keep the files.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_STORED: dict[tuple[str, ...], str] = {}


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files: they go when its query ends, not when the driver happens to collect
    its garbage. Else a job of many steps holds on disk what all of them have shuffled."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(TIDY)
        else:
            spark.conf.set(TIDY, before)


def stored_once(spark: SparkSession, name: tuple[str, ...], make: Callable[[], DataFrame]) -> DataFrame:
    """A table that many queries of a session read, written when the first one asks for it.

    ``name`` says all that the table depends on, such as the folder of its input.
    """
    key = (spark.sparkContext.applicationId, *name)
    df = make()
    if key not in _STORED:
        path = fresh_dir(spark, name[0])
        with tidy(df.sparkSession):
            df.write.parquet(path, compression=CODEC)
        _STORED[key] = path
    return spark.read.schema(df.schema).parquet(_STORED[key])


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Cuts the lineage on reliable storage and, unlike a plain checkpoint, keeps column pruning,
    pushdown and a known size, which is what lets the planner choose its join strategy.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    with tidy(spark):
        df.write.parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a table from ``stage`` that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

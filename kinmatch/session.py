"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # text work is heavy per byte: let small exchanges keep more tasks
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # a hot key on the many side of a look-up join is split by map range at run time
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Arrow batches are bounded by rows and by bytes, however long the texts are
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}


_made_up: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators count on."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "kinmatch", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; made up only on a single machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _made_up:
        _made_up[application] = tempfile.mkdtemp(prefix="kinmatch-")
    return _made_up[application]


#: Shuffle files of a write are of no use once its rows are in the shared folder.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The lineage ends in the written files, so a lost executor costs no recomputation, and the
    optimiser knows the true size: small tables are broadcast by the engine's own size check and
    large ones are not. The table lives until the :func:`scratch` around it ends, or at ``path`` until
    the caller deletes it.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, f"stage/{name}")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the :func:`scratch` around it ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if (held := _scratch.get()) is not None:
        held.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Delete what is staged inside when the block ends; no DataFrame over it may be used after.

    It gives a :func:`stage` whose tables outlive the block and belong to the one around it.
    """
    outer = _scratch.get()

    def keep(df: DataFrame, name: str) -> DataFrame:
        inner = _scratch.set(outer)
        try:
            return stage(df, name)
        finally:
            _scratch.reset(inner)

    token = _scratch.set(held := [])
    try:
        yield keep
    finally:
        _scratch.reset(token)
        for path in held:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Stage the rows of ``make()`` and delete what was staged on the way to them."""
    with scratch(spark) as keep:
        return keep(make(), name)


#: Rows that a step moves at a time, up to a share of all rows.
SLICE_ROWS = 4_000_000
MOST_SLICES = 8


def slice_count(rows: int, most: int = MOST_SLICES) -> int:
    return max(1, min(most, -(-rows // SLICE_ROWS)))


def slice_of(key: str, i: int, n: int) -> Column:
    """Whether a row is in slice ``i`` of ``n``. The salt keeps slices apart from other hashes of the key."""
    return F.lit(True) if n == 1 else F.pmod(F.xxhash64(key, F.lit("slice")), F.lit(n)) == i


def in_slices(spark: SparkSession, path: str, n: int, make: Callable[[int], DataFrame]) -> DataFrame:
    """Stage the rows of ``make(0)`` to ``make(n - 1)`` at ``path``, one after the other.

    The shuffle files of a slice, and what was staged on the way to it, are deleted before the next.
    """
    paths = [f"{path}/{i}" for i in range(n)]
    for i, part in enumerate(paths):
        with scratch(spark):
            schema = stage(make(i), "slice", part).schema
    return spark.read.schema(schema).parquet(*paths)

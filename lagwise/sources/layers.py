"""Parquet layers: write once, check the contract, reuse, describe."""
from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagwise.errors import ContractError

_OWN_FOLDER: dict[str, str] = {}
_STAMP = "lagwise.stamp"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if "path" not in _OWN_FOLDER:
        _OWN_FOLDER["path"] = tempfile.mkdtemp(prefix="lagwise-")
    return _OWN_FOLDER["path"]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/lagwise/{name}-{uuid.uuid4().hex}"


def write_layer(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite ``path`` with ZSTD Parquet.

    A partitioned write is rebalanced on its key first: each date gets few, evenly sized files,
    and a date that holds most rows is still cut into many tasks.
    """
    if partition_by:
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def _stamped(df: DataFrame, stamp: str) -> DataFrame:
    """``df`` with what it was built from noted on its first column; Parquet keeps the note."""
    first = df.columns[0]
    return df.withMetadata(first, df.schema[first].metadata | {_STAMP: stamp})


def is_complete(spark: SparkSession, path: str, stamp: str | None = None) -> bool:
    """Whether a write to ``path`` was finished and, if ``stamp`` is given, was made from the same."""
    marker, fs = _hadoop_path(spark, f"{path}/_SUCCESS")
    if not fs.exists(marker):
        return False
    return stamp is None or any(f.metadata.get(_STAMP) == stamp
                                for f in spark.read.parquet(path).schema.fields)


def missing_columns(spark: SparkSession, path: str, required: Iterable[str]) -> set[str] | None:
    """Required columns the layer lacks, or None if there is no layer at ``path``."""
    try:
        return set(required) - set(spark.read.parquet(path).columns)
    except AnalysisException:
        return None


def add_dates(df: DataFrame, path: str, partition_by: str, stamp: str | None = None) -> None:
    """Write the dates of ``df`` that the layer at ``path`` does not hold; its files stay as they are.

    The dates held (one value per day) become a filter on ``df``, which prunes partitions. Each new
    date is replaced as a whole, so a write that was broken off is simply done again. A date that the
    layer holds is final: later rows of it need a rebuild. No new date writes nothing.
    """
    held = [r[0] for r in df.sparkSession.read.parquet(path).select(partition_by).distinct().collect()]
    known = F.col(partition_by).isin([d for d in held if d is not None])
    new = df.filter(~F.coalesce(known, F.lit(None in held)))
    if stamp is not None:
        new = _stamped(new, stamp)
    new.hint("rebalance", partition_by).write.mode("overwrite").option("compression", "zstd").option(
        "partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)


def build_layer(spark: SparkSession, path: str, required: Iterable[str],
                build: Callable[[], DataFrame], partition_by: str | None = None,
                rebuild: bool = False, stamp: str | None = None, grow: bool = False) -> DataFrame:
    """Read the layer if it is there, finished, with all its columns and, if ``stamp`` is given,
    built under the same one (a run's configuration); otherwise build, write and check it.

    With ``grow``, a partitioned layer that could be read as it is first gets the dates it lacks."""
    required = set(required)
    usable = not rebuild and missing_columns(spark, path, required) == set() and is_complete(
        spark, path, stamp)
    if usable and grow and partition_by:
        add_dates(build(), path, partition_by, stamp)
    if not usable:
        built = build()
        write_layer(built if stamp is None else _stamped(built, stamp), path, partition_by)
        lost = missing_columns(spark, path, required)
        if lost != set():
            raise ContractError(f"layer {path} lacks {sorted(lost or required)} after the write")
    return spark.read.parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go when it has ended; a stage that needs them is run again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


class Scope:
    """The staged tables of some steps. They are deleted when the scope ends, but for those kept."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def keep(self, *tables: DataFrame) -> None:
        """Leaves staged tables to the scope around this one, or to whoever clears the folder."""
        for df in tables:
            path = getattr(df, "_staged_at", None)
            if path in self.paths:
                self.paths.remove(path)
                around = _scopes()[:_scopes().index(self)] if self in _scopes() else []
                if around:
                    around[-1].paths.append(path)

    def drop(self, *tables: DataFrame) -> None:
        """Deletes staged tables whose last consumer is written."""
        for df in tables:
            path = getattr(df, "_staged_at", None)
            if path in self.paths:
                self.paths.remove(path)
                _delete(self.spark, path)


_STACKS = threading.local()


def _scopes() -> list[Scope]:
    if not hasattr(_STACKS, "open"):
        _STACKS.open = []
    return _STACKS.open


def _hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _delete(spark: SparkSession, path: str) -> None:
    found, fs = _hadoop_path(spark, path)
    fs.delete(found, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """``with scope(spark) as s``: tables staged inside (by this thread) are deleted at its end.

    What is returned must be written or kept (``s.keep``) before that. If the steps fail, nothing is
    deleted and the paths are written as a table under the shared folder, in ``left-over``.
    """
    own = Scope(spark)
    _scopes().append(own)
    try:
        yield own
    except BaseException:
        if own.paths:
            spark.createDataFrame([(p,) for p in own.paths], "path string").write.mode(
                "append").parquet(f"{shared_folder(spark)}/lagwise/left-over")
        raise
    else:
        for path in own.paths:
            _delete(spark, path)
    finally:
        _scopes().remove(own)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage in a way that survives lost executors, and gives the planner the real size,
    so its own broadcast threshold decides by what is there and not by an estimate. Shuffle files of
    the write are dropped with it; inside a :func:`scope` the table is, too, at the scope's end.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if _scopes():
        _scopes()[-1].paths.append(path)
    with _shuffles_dropped(spark):
        write_layer(df, path)
    read = spark.read.schema(df.schema).parquet(path)
    read._staged_at = path
    return read


def layer_footprint(layer: DataFrame) -> DataFrame:
    """Files, bytes and rows of a file-backed layer, from file metadata only."""
    files = layer.groupBy("_metadata.file_path", "_metadata.file_size").agg(
        F.count(F.lit(1)).alias("rows"))
    return files.agg(F.count(F.lit(1)).alias("files"),
                     F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"),
                     F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


def layer_partitions(layer: DataFrame, key: str) -> DataFrame:
    """Rows per value of the partition column; reads no data column."""
    return layer.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)

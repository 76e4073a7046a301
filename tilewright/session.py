"""Session defaults, small frames, and the one place where lineage is cut."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def build_session(
    app_name: str = "tilewright",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with adaptive execution on and the UI off; a cluster supplies the rest."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


CONCURRENT_PLANS = 4  # plans that run at the same time


def local_frame(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """A small frame of known size, so that joins with it are planned by its size.

    Rows passed as a plain list would become an RDD the optimizer knows nothing about.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.names
    data = [dict(zip(names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(data, to_arrow_schema(schema)), schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, else one in the session's warehouse.

    Every executor must reach it: a warehouse that is local to one machine, which it is
    by default, is an error unless all of Spark runs there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = spark.sparkContext.master.split("[")[0] == "local"
    if not local and warehouse.split(":")[0] in ("file", warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_stored"


class Folder:
    """A folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._target = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._target.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._files.exists(self._target)

    def rename(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        # Into a folder that exists, it would move below it.
        if self._files.exists(target) or not self._files.rename(self._target, target):
            raise OSError(f"could not rename {self.path} to {path}")

    def delete(self) -> None:
        self._files.delete(self._target, True)

    def delete_on_exit(self) -> None:
        self._files.deleteOnExit(self._target)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the session ends."""
    folder = Folder(spark, f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    folder._files.mkdirs(folder._target)
    folder.delete_on_exit()
    return folder.path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Meant for catalog-sized results that several later steps read, such as the
    report: the scans of the user tables behind it then run once. The files
    survive the loss of an executor, and their size is known to the optimizer.
    They are removed when the session ends.
    """
    spark = df.sparkSession
    path = f"{scratch(spark, name)}/rows"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by halves: a chain would analyse its first members once per union."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return union_all(parts[:half]).unionByName(union_all(parts[half:]), allowMissingColumns=True)

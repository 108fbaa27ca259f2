"""Where intermediate tables go: the folder that all executors share."""

from __future__ import annotations

import contextlib
import functools
import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"linkframe-{application}-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset a local session makes one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder(spark.sparkContext.applicationId)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/linkframe/{name}-{uuid.uuid4().hex}"


@functools.cache
def _shipped(application: str) -> str:
    package = pathlib.Path(__file__).resolve().parent.parent
    path = pathlib.Path(tempfile.mkdtemp(prefix="linkframe-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    return str(path)


def ship(spark: SparkSession) -> None:
    """Let the session's Python workers import this package wherever they run: Spark deals out a copy of its code."""
    application = spark.sparkContext.applicationId
    if application not in _done:
        spark.sparkContext.addPyFile(_shipped(application))
        _done.add(application)


_done: set[str] = set()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, lost executors lose nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def bucketed(df: DataFrame, key: str, name: str) -> Iterator[DataFrame]:
    """``df`` as a table in the shared folder, bucketed by ``key``: joins on it leave its rows where they lie.

    Its name leaves the catalog at the end, so whatever reads the table is to be written by then; the files stay.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = fresh_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    df.repartition(parts, key).write.bucketBy(parts, key).option("path", path).saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")

"""Session settings and the one way in which the library cuts lineage."""

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # no call site kept per column expression: wide plans are built several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks. A cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("flowtide")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back on a folder of its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="flowtide-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/flowtide/{label}-{uuid.uuid4().hex}"


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that are written inside, once all that reads them is done.

    For jobs that end in tables or models of their own. A result that is still lazy
    must not leave the block.
    """
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            drop_table(spark, path)


def write_table(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write ``df`` as a table in the shared folder. Returns its path."""
    path = shared_path(df.sparkSession, label)
    if _scratch:
        _scratch[-1].append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return path


def materialize(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    For a result that several later passes read: it is computed once, keeps its
    columns prunable, and a lost executor costs a re-read and not a recompute.
    """
    path = write_table(df, label, partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table that :func:`write_table` wrote, once nothing reads it any more."""
    if not path.startswith(f"{shared_folder(spark)}/flowtide/"):
        raise ValueError(f"{path} is no table of the shared folder")
    delete_path(spark, path)


def _on_storage(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def delete_path(spark: SparkSession, path: str) -> None:
    storage, folder = _on_storage(spark, path)
    storage.delete(folder, True)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path on any storage, hidden ones left out."""
    storage, folder = _on_storage(spark, path)
    if not storage.exists(folder):
        return []
    found = (s.getPath().getName() for s in storage.listStatus(folder) if s.isDirectory())
    return [name for name in found if name[0] not in "._"]


def path_exists(spark: SparkSession, path: str) -> bool:
    storage, folder = _on_storage(spark, path)
    return storage.exists(folder)


def list_files(spark: SparkSession, path: str, folders: bool = False) -> list[str]:
    """Names of the files below a path, or with ``folders`` of the folders; dotted ones left out."""
    storage, folder = _on_storage(spark, path)
    if not storage.exists(folder):
        return []
    found = (s.getPath().getName() for s in storage.listStatus(folder) if s.isDirectory() == folders)
    return [name for name in found if not name.startswith(".")]


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file on any storage."""
    storage, file = _on_storage(spark, path)
    stream = storage.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small text file, whole or not at all. False if there is one of that name.

    On a file system the text is written beside and linked to its name, which fails if
    the name is taken; elsewhere it is renamed without overwriting, or created so where
    renaming is no single step.
    """
    storage, file = _on_storage(spark, path)
    storage.mkdirs(file.getParent())
    if storage.getUri().getScheme() == "file":
        name = file.toUri().getPath()
        beside = f"{os.path.dirname(name)}/.{uuid.uuid4().hex}"
        with open(beside, "x", encoding="utf-8") as out:
            out.write(text)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(beside, name)
        except FileExistsError:
            return False
        finally:
            os.unlink(beside)
        return True
    jvm = spark.sparkContext._jvm
    renames = storage.getUri().getScheme() in ("hdfs", "viewfs")
    target = jvm.org.apache.hadoop.fs.Path(file.getParent(), f".{uuid.uuid4().hex}") if renames else file
    try:
        stream = storage.create(target, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        return storage.rename(target, file) if renames else True
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise

"""Zip archives by member: a task reads one member, by ranges, and never a whole archive.

An archive's table of contents stands at its end. The first step reads that alone, of each
archive in a task, and gives one small row a member; the rows are dealt over tasks, and each
task opens its members where they stand. The same two steps serve a stream, in which Spark's
file source keeps the record of the archives it has handed out.
"""

import io
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from typing import BinaryIO

import pyarrow as pa
import pyarrow.csv
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flowtide.operators.clean import stage_trips
from flowtide.schemas import TRIP_TEXT

ARCHIVE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
MEMBER = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("size", T.LongType()),
    ]
)


# Bytes asked for at a time.
RANGE = 1 << 20


class _Ranges(io.RawIOBase):
    """An Arrow file as Python's, with its error for a place before the start."""

    def __init__(self, file: pa.NativeFile):
        self._file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._file.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        start = (0, self._file.tell(), self._file.size())[whence]
        if start + offset < 0:
            raise OSError("before the start of the file")
        return self._file.seek(start + offset)

    def readinto(self, buffer) -> int:
        return self._file.readinto(buffer)


@contextmanager
def open_ranges(path: str) -> Iterator[BinaryIO]:
    """A file on any storage that Arrow knows, read by ranges where it is sought."""
    if path.startswith(("s3a:", "s3n:")):
        path = "s3" + path[3:]
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    storage, place = pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)
    with storage.open_input_file(place) as file:
        yield io.BufferedReader(_Ranges(file), RANGE)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The CSV members of each archive, the copies under ``__MACOSX`` left out."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with open_ranges(path) as file, zipfile.ZipFile(file) as archive:
                found = [i for i in archive.infolist() if i.filename.endswith(".csv") and not i.filename.startswith("__MACOSX")]
            yield pa.RecordBatch.from_pydict(
                {
                    "path": pa.array([path] * len(found), pa.string()),
                    "member": pa.array([i.filename for i in found], pa.string()),
                    "size": pa.array([i.file_size for i in found], pa.int64()),
                }
            )


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = TRIP_TEXT.names
    options = pa.csv.ConvertOptions(
        column_types={n: pa.string() for n in names},
        include_columns=names,
        null_values=[""],
        strings_can_be_null=True,
        quoted_strings_can_be_null=True,
    )
    for batch in batches:
        for path, member, size in zip(*(batch.column(c).to_pylist() for c in MEMBER.names), strict=True):
            if size:
                with open_ranges(path) as file, zipfile.ZipFile(file) as archive, archive.open(member) as stream:
                    yield from pa.csv.open_csv(stream, convert_options=options)


def zip_members(archives: DataFrame) -> DataFrame:
    """``path, member, size`` of the CSV members of archives, given by ``path``."""
    return archives.select("path").mapInArrow(_contents, MEMBER)


def _trips(archives: DataFrame, tasks: int | None, strict: bool) -> DataFrame:
    members = zip_members(archives)
    # dealt in turn, so that as many members as tasks get a task each
    count = tasks or int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage_trips(members.repartition(count).mapInArrow(_lines, TRIP_TEXT), strict)


def read_zip_members(
    spark: SparkSession, paths: str | list[str], tasks: int | None = None, strict: bool = True
) -> DataFrame:
    """Trips out of the CSV members of zip archives, over ``tasks`` tasks (the shuffle's number).

    Archives may have any size: no more than a block of one member is held. An empty
    member or archive has no rows; a member that lacks a column, or a file that is no zip
    archive, fails the read. Executors reach the archives through Arrow's file systems; where
    Arrow has none for the storage, :func:`flowtide.sources.trip_files.read_trip_zips` reads
    whole archives through Spark's.
    """
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(paths)
    return _trips(archives, tasks, strict)


def stream_zip_members(
    spark: SparkSession, path: str, tasks: int | None = None, strict: bool = True, archives_per_batch: int | None = None
) -> DataFrame:
    """The trips of archives as they arrive in a folder, each archive once.

    Put archives there whole, by renaming: one that is still written has no table of contents.
    """
    reader = spark.readStream.format("binaryFile").schema(ARCHIVE).option("pathGlobFilter", "*.zip")
    if archives_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", archives_per_batch)
    return _trips(reader.load(path), tasks, strict)

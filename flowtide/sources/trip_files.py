"""Trip files: CSV, zipped CSV, and the tables they are loaded into."""

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.functions.calendar import parse_timestamp
from flowtide.operators.clean import stage_trips
from flowtide.schemas import TRIP, TRIP_TEXT


def read_trips_csv(
    spark: SparkSession, paths: str | list[str], year: int | None = None, strict: bool = True
) -> DataFrame:
    """Header CSVs as typed trips. With ``year``, the files named by it in a folder.

    Empty fields are NULL. Timestamps may have fractions or a zone suffix; text
    that is none fails the read, or becomes NULL when not ``strict``.
    """
    if year is not None:
        folders = [paths] if isinstance(paths, str) else paths
        paths = [f"{p.rstrip('/')}/{year}*.csv" for p in folders]
    text = spark.read.schema(TRIP_TEXT).option("header", True).option("nullValue", "").csv(paths)
    return stage_trips(text, strict)


def check_trips_csv(
    spark: SparkSession, paths: str | list[str], year: int | None = None, header: bool = True
) -> DataFrame:
    """Every line of CSV files: the typed trip, and where and why it is to be rejected.

    Besides the trip's columns: ``file``, ``line`` and ``reason``, NULL for a good line.
    Reasons are ``columns`` for a line with more or fewer fields than declared, else the
    columns whose text is no value of their type, comma-joined; those are NULL in the trip.
    ``line`` is the text of a rejected line, put together again from its fields unless their
    number is wrong. Empty fields are NULL and no reason. Blank lines are none. Store the
    result, or its good and rejected part: each use reads the files again.
    """
    if year is not None:
        folders = [paths] if isinstance(paths, str) else paths
        paths = [f"{p.rstrip('/')}/{year}*.csv" for p in folders]
    schema = T.StructType([*TRIP_TEXT, T.StructField("_broken", T.StringType())])
    text = (
        spark.read.schema(schema)
        .options(header=header, nullValue="", mode="PERMISSIVE", columnNameOfCorruptRecord="_broken")
        .csv(paths)
        .select("*", F.col("_metadata.file_path").alias("file"))
    )
    typed = {
        f.name: parse_timestamp(F.col(f.name), strict=False)
        if f.dataType.typeName() == "timestamp_ntz"
        else F.col(f.name).try_cast(f.dataType)
        for f in TRIP
    }
    bad = F.concat_ws(",", *[F.when(F.col(c).isNotNull() & v.isNull(), F.lit(c)) for c, v in typed.items()])
    reason = F.when(F.col("_broken").isNotNull(), F.lit("columns")).when(bad != "", bad)
    line = F.coalesce("_broken", F.to_csv(F.struct(*TRIP_TEXT.names)))
    return text.select(
        *[v.alias(c) for c, v in typed.items()], "file", F.when(reason.isNotNull(), line).alias("line"), reason.alias("reason")
    )


def good_trips(checked: DataFrame) -> DataFrame:
    """The trips of the lines that :func:`check_trips_csv` found good."""
    return checked.where(F.col("reason").isNull()).select(*TRIP.names)


def rejected_lines(checked: DataFrame) -> DataFrame:
    """``file, line, reason`` of the others."""
    return checked.where(F.col("reason").isNotNull()).select("file", "line", "reason")


def read_trip_zips(spark: SparkSession, paths: str | list[str], strict: bool = True) -> DataFrame:
    """Trips out of zip archives that lie on storage, one archive per task.

    Only CSV members count; the copies some archives keep under ``__MACOSX`` do
    not. An archive is read in the task that decompresses it, as a stream; its
    content is not shuffled.
    """
    # a file costs as much as a full partition to open, so none shares its task
    alone = spark.newSession()
    alone.conf.set("spark.sql.files.openCostInBytes", alone.conf.get("spark.sql.files.maxPartitionBytes"))
    archives = alone.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(paths)
    return stage_trips(archives.select("content").mapInArrow(_expand, TRIP_TEXT), strict)


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = TRIP_TEXT.names
    options = pa.csv.ConvertOptions(
        column_types={n: pa.string() for n in names},
        include_columns=names,
        null_values=[""],
        strings_can_be_null=True,
        quoted_strings_can_be_null=True,
    )
    for batch in batches:
        for content in batch.column("content"):
            with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as archive:
                for member in archive.namelist():
                    if member.endswith(".csv") and not member.startswith("__MACOSX"):
                        with archive.open(member) as stream:
                            yield from pa.csv.open_csv(stream, convert_options=options)


def load_year(trips: DataFrame, path: str) -> None:
    """Full refresh of a year's trip table."""
    trips.write.mode("overwrite").parquet(path)


def append_trips(trips: DataFrame, path: str) -> None:
    """Add one file's trips to a table."""
    trips.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV part files, for tools that read no parquet."""
    writer = df.write.mode("overwrite").option("header", True)
    # the default format cuts timestamps to milliseconds
    writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)

"""Series, feature and metric tables on storage."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.constants import LAG_COLUMNS, TARGET
from flowtide.operators.reshape import long_to_wide, wide_to_long
from flowtide.schemas import METRIC_TABLES
from flowtide.session import delete_path, list_folders, path_exists
from flowtide.sources.keyed_table import KeyedTable

STOCK = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("station", T.StringType()),
        T.StructField("rideable_type", T.StringType()),
        T.StructField("stock", T.LongType()),
    ]
)


FEATURES = T.StructType(
    [
        T.StructField("station", T.StringType()),
        T.StructField("rideable_type", T.StringType()),
        T.StructField("stock", T.LongType()),
        T.StructField("hour", T.DoubleType()),
        T.StructField("dayofweek", T.IntegerType()),
        T.StructField("is_rush_hour", T.IntegerType()),
        *[T.StructField(c, T.LongType()) for c in LAG_COLUMNS],
        T.StructField(TARGET, T.LongType()),
        T.StructField("date", T.DoubleType()),
    ]
)


def write_stock(stock: DataFrame, path: str) -> None:
    """Long series, one folder per day, so that a day's requests read one folder.

    Rows are spread by ranges of day and series: few files per day, none larger
    for having many stations, and each with a narrow range of stations to skip by.
    """
    dated = stock.select(*STOCK.names, F.to_date("time").alias("day"))
    spread = dated.repartitionByRange("day", "station", "rideable_type")
    ordered = spread.sortWithinPartitions("day", "station", "rideable_type", "time")
    ordered.write.mode("overwrite").partitionBy("day").parquet(path)


def read_stock(spark: SparkSession, path: str, with_day: bool = False) -> DataFrame:
    """The stored series; ``with_day`` keeps the folder's day, for joins to prune by."""
    schema = T.StructType([*STOCK, T.StructField("day", T.DateType())])
    stored = spark.read.schema(schema).parquet(path)
    return stored if with_day else stored.select(*STOCK.names)


def write_features(features: DataFrame, path: str) -> None:
    features.write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str, with_time: bool = False) -> DataFrame:
    """Stored features. ``with_time`` for tables written with their slot."""
    fields = [T.StructField("time", T.TimestampNTZType())] if with_time else []
    return spark.read.schema(T.StructType([*fields, *FEATURES])).parquet(path)


def write_wide_csv(stock: DataFrame, path: str, names: list[str] | None = None) -> None:
    """Wide series as CSV with one header line, ordered by time."""
    wide = long_to_wide(stock, names).orderBy("time")
    writer = wide.write.mode("overwrite").option("header", True)
    writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """A wide series file as the long series. Its header names the series."""
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType(
        [
            T.StructField(n, T.TimestampNTZType() if n == "time" else T.LongType())
            for n in names
        ]
    )
    return wide_to_long(spark.read.schema(schema).option("header", True).csv(path))


class VersionedTable:
    """A small keyed table whose every write is a new, complete version.

    Parquet has no merge, and a table must not be overwritten while it is read: a
    version is a folder, and readers take the highest one that its writer has closed
    with a success mark. A version may be empty. The last ``keep`` versions stay, for
    readers that have begun; older ones are deleted.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keep: int = 3):
        self.spark, self.path, self.schema, self.keep = spark, path, schema, keep

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def _versions(self) -> list[int]:
        """All versions, torn ones too, from the names of their folders."""
        names = list_folders(self.spark, self.path)
        return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))

    def create_if_absent(self) -> None:
        if self.version() is None:
            self._write(self.spark.createDataFrame([], self.schema), 0)

    def version(self) -> int | None:
        """The current version: the highest that is complete."""
        for version in reversed(self._versions()):
            if path_exists(self.spark, f"{self._folder(version)}/_SUCCESS"):
                return version
        return None

    def read(self) -> DataFrame:
        version = self.version()
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._folder(version))

    def replace(self, rows: DataFrame) -> None:
        versions = self._versions()
        self._write(rows, versions[-1] + 1 if versions else 0)
        for old in self._versions()[: -self.keep]:
            delete_path(self.spark, self._folder(old))

    def _write(self, rows: DataFrame, version: int) -> None:
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        rows.select(*columns).write.mode("overwrite").parquet(self._folder(version))


def ensure_metric_tables(spark: SparkSession, root: str) -> dict[str, KeyedTable]:
    """The monitoring tables under ``root``, created where absent.

    They have one bucket a few days, so that the rows of a new day rewrite one of them.
    """
    tables = {}
    for name, (schema, keys) in METRIC_TABLES.items():
        tables[name] = KeyedTable(spark, f"{root}/{name}", schema, keys, bucket_by=["timestamp"])
        tables[name].create_if_absent()
    return tables

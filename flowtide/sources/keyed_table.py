"""A keyed table in buckets: a merge rewrites the buckets that its keys fall in, no others."""

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.session import delete_path, list_files, materialize, read_text, write_new

BUCKET = "_bucket"

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class ConflictError(RuntimeError):
    """Other writers kept changing the same buckets."""


class KeyedTable:
    """Rows by key, in buckets of a hash of ``bucket_by`` (some of the keys, or all).

    A version is a manifest: a small file that names the folder of every bucket. A merge
    reads the buckets of its new rows, writes them to a folder of its own, and commits the
    next manifest, which must not exist yet. If another writer was first, one that changed
    other buckets costs a new manifest only, one that changed the same ones a new merge.
    Readers hold on to one manifest and never see half of a merge; an unfinished merge
    leaves a folder that nothing names.

    The commit is atomic on local and shared file systems and on HDFS. On an object store
    it is where creating a file can be made to fail if it exists; elsewhere let one writer
    write at a time. A NULL in ``bucket_by`` fails the merge: it is no key. Columns of new
    rows beyond the schema are dropped. The number of buckets stays what it was when the
    table was made.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        buckets: int = 64,
        bucket_by: Sequence[str] | None = None,
    ):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)
        self.buckets, self.bucket_by = buckets, list(bucket_by or keys)

    def _manifest(self, version: int) -> str:
        return f"{self.path}/manifests/{version:012d}.json"

    def versions(self) -> list[int]:
        names = list_files(self.spark, f"{self.path}/manifests")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def version(self) -> int | None:
        versions = self.versions()
        return versions[-1] if versions else None

    def create_if_absent(self) -> None:
        """An empty first version, unless there is one; another writer may be first."""
        if not self.versions():
            self._commit(0, {})

    def _commit(self, version: int, folders: dict[str, str]) -> bool:
        text = json.dumps({"buckets": self.buckets, "folders": folders}, sort_keys=True)
        return write_new(self.spark, self._manifest(version), text)

    def snapshot(self, version: int | None = None) -> tuple[int, dict[str, str]]:
        """A version, the newest by default, and the folder of each bucket that has rows."""
        if version is None:
            versions = self.versions()
            if not versions:
                return -1, {}
            version = versions[-1]
        held = json.loads(read_text(self.spark, self._manifest(version)))
        if held["buckets"] != self.buckets:
            raise ValueError(f"the table at {self.path} has {held['buckets']} buckets, not {self.buckets}")
        return version, held["folders"]

    def _read(self, folders: dict[str, str], only: Sequence[str] | None = None) -> DataFrame:
        chosen = sorted(folders[b] for b in (folders if only is None else only) if b in folders)
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{c}" for c in chosen])

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self.snapshot(version)[1])

    def _bucket(self) -> Column:
        null = F.raise_error(F.lit(f"NULL in {', '.join(self.bucket_by)}")).cast("int")
        known = F.lit(True)
        for c in self.bucket_by:
            known = known & F.col(c).isNotNull()
        return F.when(known, F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")).otherwise(null)

    def _typed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])

    def merge(self, new: DataFrame, how: Merge, attempts: int = 10) -> int:
        """Replace the rows of the new rows' buckets by ``how(existing, new)``. Returns the version.

        ``how`` is one of :mod:`flowtide.operators.upsert` with its keys filled in, or any
        function that keeps rows in their buckets. Its result is checked: a row that leaves its
        buckets fails the merge. Without new rows nothing is written.
        """
        new = materialize(self._typed(new).select("*", self._bucket().alias(BUCKET)), "new-rows")
        # at most one row a bucket
        touched = [str(r[BUCKET]) for r in new.select(BUCKET).distinct().collect()]
        version, folders = self.snapshot()
        written, basis = None, None
        for _ in range(attempts if touched else 0):
            current = {b: folders.get(b) for b in touched}
            if written is None or current != basis:
                if written is not None:
                    delete_path(self.spark, f"{self.path}/{written}")
                written, basis = self._write(folders, new, touched, how), current
            present = set(list_files(self.spark, f"{self.path}/{written}", folders=True))
            kept = {b: f for b, f in folders.items() if b not in basis}
            filled = {b: f"{written}/{BUCKET}={b}" for b in touched if f"{BUCKET}={b}" in present}
            if self._commit(version + 1, kept | filled):
                return version + 1
            version, folders = self.snapshot()
        if touched:
            delete_path(self.spark, f"{self.path}/{written}")
            raise ConflictError(f"{attempts} attempts to change {self.path} met other writers")
        return version

    def _write(self, folders: dict[str, str], new: DataFrame, touched: list[str], how: Merge) -> str:
        """The merged buckets in a folder of their own, in few files, a large bucket in several."""
        merged = self._typed(how(self._read(folders, touched), new.drop(BUCKET)))
        astray = F.raise_error(F.lit("a merged row has left the buckets of the new rows")).cast("int")
        bucket = self._bucket()
        placed = merged.select("*", F.when(bucket.isin([int(b) for b in touched]), bucket).otherwise(astray).alias(BUCKET))
        folder = f"data/{uuid.uuid4().hex}"
        spread = placed.repartitionByRange(BUCKET, *self.keys).sortWithinPartitions(BUCKET, *self.keys)
        spread.write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        return folder

    def expire(self, keep: int = 3) -> int:
        """Delete all versions but the last ``keep`` and the folders that only they name.

        Readers of those versions must be done. Folders of merges under way are in no
        manifest and stay. Returns the number of folders deleted.
        """
        versions = self.versions()
        gone, stay = versions[:-keep], versions[-keep:]
        named = lambda vs: {f for v in vs for f in self.snapshot(v)[1].values()}
        unused = named(gone) - named(stay)
        for version in gone:
            delete_path(self.spark, self._manifest(version))
        for folder in unused:
            delete_path(self.spark, f"{self.path}/{folder}")
        return len(unused)

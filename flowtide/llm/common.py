"""What several operators of this subpackage share."""

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """A column by its literal name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def fold_of(doc_id, folds: int) -> int:
    """The same in plain Python."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds

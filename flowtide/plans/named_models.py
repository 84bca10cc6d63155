"""Named tables that are built from each other, in the order of what they read.

A model is a function of DataFrames: those of the models and sources that it names. A view
stays a plan, a table is written whole at each run, and a growing table reads only the rows of
its input above the highest mark that it has stored, and adds what it makes of them.
"""

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.session import delete_path, list_files, read_text, write_new

KINDS = ("view", "table", "growing")


@dataclass(frozen=True)
class Model:
    """``build`` gets the DataFrames of ``refs`` in their order.

    A growing model has a ``mark``: a column of its first ref that only grows as rows arrive
    and that is never NULL in a row to be read. It has to make each output row of rows of one run alone.
    """

    name: str
    refs: Sequence[str]
    build: Callable[..., DataFrame]
    kind: str = "view"
    mark: str | None = None

    def __post_init__(self):
        if self.kind not in KINDS or (self.kind == "growing") != (self.mark is not None):
            raise ValueError(f"{self.name}: a kind of {KINDS}, and a mark if it is growing")


def build_order(models: Sequence[Model], sources: Sequence[str] = ()) -> list[str]:
    """Names of the models, each after those it reads. Circles and unknown names fail."""
    names = [m.name for m in models]
    twice = {n for n in names if names.count(n) > 1} | set(names) & set(sources)
    unknown = {r for m in models for r in m.refs} - set(names) - set(sources)
    if twice or unknown:
        raise ValueError(f"named twice: {sorted(twice)}, unknown: {sorted(unknown)}")
    return [n for n in TopologicalSorter({m.name: m.refs for m in models}).static_order() if n in names]


def _state(spark: SparkSession, folder: str) -> dict:
    """The parts of a stored model: folders, schema and highest mark, from the last run's note."""
    notes = sorted(n for n in list_files(spark, folder) if n.startswith("run-"))
    if not notes:
        return {"run": -1, "parts": [], "schema": None, "mark": None}
    return json.loads(read_text(spark, f"{folder}/{notes[-1]}"))


def read_model(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table, as its last finished run left it."""
    folder = f"{root}/{name}"
    state = _state(spark, folder)
    if state["schema"] is None:
        raise ValueError(f"{name} has not been run in {root}")
    schema = T.StructType.fromJson(state["schema"])
    return spark.read.schema(schema).parquet(*[f"{folder}/{part}" for part in state["parts"]])


def _store(spark: SparkSession, folder: str, rows: DataFrame, state: dict, grows: bool, mark: str | None) -> None:
    """One more part, or the only one, and then the note that makes it count.

    A run that ends before its note leaves a part that nothing names, and the next run writes
    over it. The note is made once: of two runs at a time one fails.
    """
    schema, run = json.loads(rows.schema.json()), state["run"] + 1
    if grows and state["schema"] is not None:
        held = T.StructType.fromJson(state["schema"])
        if [(f.name, f.dataType) for f in held] != [(f.name, f.dataType) for f in rows.schema]:
            raise ValueError(f"{folder} has other columns: {held.simpleString()}, {rows.schema.simpleString()}")
        schema = state["schema"]
    part = f"part-{run:06d}"
    rows.write.mode("overwrite").parquet(f"{folder}/{part}")
    parts = [*state["parts"], part] if grows else [part]
    note = {"run": run, "parts": parts, "schema": schema, "mark": mark}
    if not write_new(spark, f"{folder}/run-{run:06d}.json", json.dumps(note)):
        raise RuntimeError(f"another run of {folder} has ended in the meantime")
    # the part before stays for readers that have begun; the one before that goes
    if not grows and run >= 2:
        delete_path(spark, f"{folder}/part-{run - 2:06d}")


def _new_rows(source: DataFrame, mark: str, stored: str | None) -> tuple[DataFrame, str | None]:
    """The rows above the stored mark, and the highest mark that there is now.

    The highest is taken first and bounds the rows, so that rows which arrive while the run
    reads are left to the next one. A row with a mark below the stored one is not read.
    """
    kind = source.schema[mark].dataType
    (top,) = source.agg(F.max(mark).cast("string").alias("top")).first()
    if top is None:
        return source.limit(0), stored
    rows = source.where(F.col(mark) <= F.lit(top).cast(kind))
    return rows if stored is None else rows.where(F.col(mark) > F.lit(stored).cast(kind)), top


def run_models(
    spark: SparkSession,
    models: Sequence[Model],
    sources: Mapping[str, DataFrame],
    root: str,
    only: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Build all models, or ``only`` some and what they read, and return all that were built.

    Tables lie below ``root``, one folder each. Views are registered by their names for SQL, and
    tables too.
    """
    by_name = {m.name: m for m in models}
    order = build_order(models, list(sources))
    if only is not None:
        needed, left = set(), list(only)
        while left:
            name = left.pop()
            if name in by_name and name not in needed:
                needed.add(name)
                left.extend(by_name[name].refs)
        order = [n for n in order if n in needed]
    built = dict(sources)
    for name in order:
        model, folder = by_name[name], f"{root}/{name}"
        inputs = [built[r] for r in model.refs]
        if model.kind == "view":
            built[name] = model.build(*inputs)
        else:
            state, top = _state(spark, folder), None
            if model.kind == "growing":
                inputs[0], top = _new_rows(inputs[0], model.mark, state["mark"])
            if model.kind == "table" or state["schema"] is None or top != state["mark"]:
                _store(spark, folder, model.build(*inputs), state, model.kind == "growing", top)
            built[name] = read_model(spark, root, name)
        built[name].createOrReplaceTempView(name)
    return {n: built[n] for n in order}

"""Row-wise work on Arrow batches, with exact values: a null among longs turns none into floats."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Bytes of the rows that are taken into Python objects at a time; a larger row is taken by itself.
SLICE_BYTES = 2 << 20


def slices(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of `batches` in slices of at most `most` bytes, or of one row; nothing is copied.

    So a worker's memory is bounded by bytes, without touching the session's Arrow settings.
    """
    for b in batches:
        todo = [b]
        while todo:
            part = todo.pop()
            if part.nbytes <= most or part.num_rows <= 1:
                yield part
            else:
                half = part.num_rows // 2
                todo += [part.slice(half), part.slice(0, half)]


def map_lists(df: DataFrame, work: Callable[[dict[str, list]], Iterator[dict] | dict], schema: str) -> DataFrame:
    """`df` with each batch, as lists by column, made into columns of `schema` by `work`.

    `work` returns one set of columns, or yields several.
    """
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = work({name: b.column(i).to_pylist() for i, name in enumerate(b.schema.names)})
            for columns in [out] if isinstance(out, dict) else out:
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type, from_pandas=True) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kind)


def stream_lists(df: DataFrame, work: Callable[[Iterator[dict[str, list]]], Iterator[dict]], schema: str) -> DataFrame:
    """`df` with each partition's batches, as lists by column, made into columns of `schema` by `work`."""
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = ({name: b.column(i).to_pylist() for i, name in enumerate(b.schema.names)} for b in slices(batches))
        for columns in work(lists):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type, from_pandas=True) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kind)


def keep_rows(df: DataFrame, test: Callable[[list], list[bool]], column: str = "text") -> DataFrame:
    """The rows of `df` whose value in `column` passes; `test` takes a list of values."""
    place = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield b.filter(pa.array(test(b.column(place).to_pylist()), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


def change_column(df: DataFrame, change: Callable[[list], list], column: str = "text") -> DataFrame:
    """`df` with the strings of `column` changed; `change` takes a list of values and returns as many."""
    place = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            columns = list(b.columns)
            columns[place] = pa.array(change(columns[place].to_pylist()), type=columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return df.mapInArrow(run, df.schema)


def add_columns(df: DataFrame, work: Callable[[dict[str, list]], dict], schema: str, needs: list[str], drop: list[str] | None = None) -> DataFrame:
    """`df` with the columns of `schema` after its own, but for `drop`; `work` gets the columns in `needs`.

    Columns of `df` with such names give way to the new ones.
    """
    added = StructType.fromDDL(schema)
    kept = [f for f in df.schema.fields if f.name not in added.names and f.name not in (drop or ())]
    places = [df.columns.index(f.name) for f in kept]
    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            names = b.schema.names
            out = work({c: b.column(names.index(c)).to_pylist() for c in needs})
            new = [pa.array(out[f.name], type=f.type, from_pandas=True) for f in arrow]
            fields = [b.schema.field(i) for i in places]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in places] + new, schema=pa.schema([*fields, *arrow]))

    return df.mapInArrow(run, StructType([*kept, *added.fields]))


def map_frames(df: DataFrame, work: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """`df` with each partition's slices, as pandas frames, made into frames of `schema` by `work`; no longs may be null."""
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(b.to_pandas() for b in slices(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type, from_pandas=True) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kind)

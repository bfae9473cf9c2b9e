"""What the operators share on the Spark side: shared folders, staged tables, appended columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.plans.shared import keep


_SIMPLE = {"long": T.LongType, "int": T.IntegerType, "double": T.DoubleType, "string": T.StringType, "boolean": T.BooleanType, "binary": T.BinaryType}


def kind(text: str) -> T.DataType:
    """A type by name, array<...> and struct<name:...> included; works without a session, as in workers."""
    text = text.strip()
    if text.startswith("array<"):
        return T.ArrayType(kind(text[6:-1]))
    if text.startswith("struct<"):
        return T.StructType([T.StructField(n, kind(t)) for n, t in (x.split(":", 1) for x in _parts(text[7:-1]))])
    return _SIMPLE[text]()


def _parts(text: str) -> list[str]:
    out, depth = [""], 0
    for c in text:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


def schema_of(text: str) -> T.StructType:
    """A schema from ``name type, name type``."""
    return T.StructType([T.StructField(n, kind(t)) for n, t in (x.split(" ", 1) for x in _parts(text))])


def stage(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write a table once to the shared folder and read it back: short lineage that survives lost executors. rows: the most that df can have, where known."""
    return keep(df, name, rows, compression="zstd")


def whole_ids(df: DataFrame, column: str) -> Column:
    """The column as long; an error where it does not hold whole numbers, which a cast would turn into nulls."""
    kind = df.select(F.col(column)).schema[0].dataType
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"{column} holds {kind.simpleString()}, not whole numbers")
    return F.col(column).cast("long")


def slots(spark: SparkSession) -> int:
    """Partitions to deal rows to: the session's shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of df has it (case ignored, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def map_texts(df: DataFrame, columns: list, fields: str, kernel: Callable[[pa.RecordBatch], list]) -> DataFrame:
    """The columns, then the fields that ``kernel`` makes of each Arrow batch of them, in place of the last column (the text)."""
    narrow = df.select(*columns)
    schema = T.StructType(narrow.schema.fields[:-1] + schema_of(fields).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            made = [*batch.columns[:-1], *kernel(batch)]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) if a.type != f.type else a for a, f in zip(made, arrow, strict=True)], schema=arrow)

    return narrow.mapInArrow(run, schema)


def append_columns(df: DataFrame, text_col: str, fields: list[tuple[str, str]], kernel: Callable[[pa.Array], list]) -> tuple[DataFrame, list[str]]:
    """df with the columns that ``kernel`` makes of the text column; their names avoid df's own."""
    names = []
    shadow = df
    for name, _ in fields:
        names.append(fresh(shadow, name))
        shadow = shadow.withColumn(names[-1], F.lit(None))
    schema = T.StructType(df.schema.fields + [T.StructField(n, kind(k)) for n, (_, k) in zip(names, fields, strict=True)])
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            made = [*batch.columns, *kernel(batch.column(at))]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) if a.type != f.type else a for a, f in zip(made, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema), names


def holdout(id_col, modulo: int, rest: int):
    """Whether crc32 of the id as text leaves ``rest`` modulo ``modulo``; false for a null id."""
    return F.coalesce((F.crc32(F.col(id_col).cast("string")) % modulo) == rest, F.lit(False))

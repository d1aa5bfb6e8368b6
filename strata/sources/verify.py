"""Verification of written tables: what went to the files against what a reader gets back.

The digest of a set of rows does not depend on their order or on how they are split: the number of rows, and the sum and the exclusive or of
their 64-bit hashes.  The writer takes it with ``observe`` in the tasks that write, so a write is verified with one read of the table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import quote_ident
from ..schemas import TableSpec
from ..session import observed
from .catalog import write_spec_table, write_table

REPORT = "table_name string, rows_written bigint, rows_read bigint, rows_equal boolean, digest_equal boolean, schema_equal boolean"


def _comparable(name: str, dt: T.DataType) -> Column:
    """A form of a column that hashes alike exactly when values are alike: maps, which have no order, as sorted entries."""
    c = F.col(quote_ident(name))
    if isinstance(dt, T.MapType):
        return F.array_sort(F.map_entries(c))
    if isinstance(dt, (T.StructType, T.ArrayType)):
        return F.to_json(F.struct(c.alias("v")))
    return c


def row_hash(fields: list[T.StructField]) -> Column:
    """64-bit hash of a row, in which the places of NULLs count (the engine's hash function skips them)."""
    if not fields:
        return F.lit(0).cast("bigint")
    nulls = F.concat(*(F.when(F.col(quote_ident(f.name)).isNull(), "1").otherwise("0") for f in fields))
    return F.xxhash64(nulls, *(_comparable(f.name, f.dataType) for f in fields))


def content_digest(fields: list[T.StructField]) -> list[Column]:
    """Aggregates ``rows``, ``hash_sum`` and ``hash_xor`` over rows of these columns, in any order and any split."""
    h = row_hash(fields)
    return [F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("hash_sum"), F.bit_xor(h).alias("hash_xor")]


def same_schema(a: T.StructType, b: T.StructType) -> bool:
    """Names, types and order of columns; nullability and metadata are the table's own."""
    return [(f.name, f.dataType.simpleString()) for f in a.fields] == [(f.name, f.dataType.simpleString()) for f in b.fields]


class Written:
    """The digest of a write, as its tasks took it, and the schema that was asked for."""

    def __init__(self, name: str, schema: T.StructType):
        self.name, self.schema, self.observation = name, schema, Observation(f"written_{uuid.uuid4().hex}")

    @property
    def observe(self) -> tuple[Observation, list[Column]]:
        return self.observation, content_digest(self.schema.fields)


def verified(written: Written, read: DataFrame) -> tuple:
    """One row of the report: the write's digest against one scan of ``read``, and the schemas."""
    there = {f.name for f in read.schema.fields}
    fields = written.schema.fields
    if all(f.name in there for f in fields):
        got = read.agg(*content_digest(fields)).first()
    else:  # a column is gone: the rows can be counted, their content cannot be equal
        got = read.agg(F.count(F.lit(1)).alias("rows"), F.lit(-1).alias("hash_sum"), F.lit(None).alias("hash_xor")).first()
    was = observed(written.observation) or {"rows": 0, "hash_sum": None, "hash_xor": None}
    digest = (was["hash_sum"], was["hash_xor"]) == (got["hash_sum"], got["hash_xor"])
    return written.name, was["rows"], got["rows"], was["rows"] == got["rows"], digest, same_schema(written.schema, read.schema)


def write_verified(df: DataFrame, name: str | None = None, *, spec: TableSpec | None = None, schema_name: str | None = None, **options) -> DataFrame:
    """Write ``df`` as :func:`catalog.write_table` (or, with ``spec``, ``write_spec_table`` into ``schema_name``) does, then read it back and
    compare: one row ``table_name, rows_written, rows_read, rows_equal, digest_equal, schema_equal``.

    The write must replace the table (an append has no digest of its own to compare with).  An empty table has no hashes and is equal to an
    empty table; rows that differ in the place of a NULL, in order of columns or in one repetition differ in the digest.
    """
    spark = df.sparkSession
    if options.get("mode", "overwrite") != "overwrite":
        raise ValueError("only a write that replaces the table can be verified")
    known = spec.schema if spec is not None else options.get("schema") or df.schema
    wanted = T.StructType([f for f in known.fields])
    cast = df.select(*(F.col(quote_ident(f.name)).cast(f.dataType).alias(f.name) for f in wanted.fields))
    record = Written(spec.name if spec is not None else name, wanted)
    if spec is not None:
        name = write_spec_table(cast, schema_name, spec, observe=record.observe, **options)
    else:
        write_table(cast, name, observe=record.observe, **options)
    return spark.createDataFrame([verified(record, spark.table(name))], REPORT)

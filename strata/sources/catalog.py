"""Catalog helpers: schemas, typed tables from specs, overwrite writes, renames, schema reports.

Tables are two-level ``schema.table`` names in the session catalog.  Writes
into an existing typed table go through ``insertInto`` so the DDL (column
comments, table comment) survives an overwrite; a plain ``saveAsTable``
overwrite would replace it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ALL_TABLES, LAYER_COMMENTS, TableSpec


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def qualified(schema: str, table: str) -> str:
    return f"{schema}.{table}"


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_schema(spark: SparkSession, name: str, comment: str | None = None) -> None:
    ddl = f"CREATE SCHEMA IF NOT EXISTS {_q(name)}"
    if comment:
        ddl += f" COMMENT {_lit(comment)}"
    spark.sql(ddl)


def ensure_layers(spark: SparkSession, prefix: str = "") -> dict[str, str]:
    """bronze / silver / gold schemas (optionally prefixed), with their comments."""
    names = {}
    for layer, comment in LAYER_COMMENTS.items():
        names[layer] = f"{prefix}{layer}"
        ensure_schema(spark, names[layer], comment)
    return names


def table_ddl(name: str, schema: T.StructType, comment: str | None = None, fmt: str = "parquet",
              bucket_by: tuple[str, ...] = (), buckets: int | None = None) -> str:
    cols = []
    for f in schema.fields:
        kind = f.dataType.simpleString()  # field names of nested types keep their case
        col = f"`{f.name}` {kind if '<' in kind else kind.upper()}"
        if f.metadata.get("comment"):
            col += f" COMMENT {_lit(f.metadata['comment'])}"
        cols.append(col)
    ddl = f"CREATE TABLE IF NOT EXISTS {_q(name)} (\n  " + ",\n  ".join(cols) + f"\n) USING {fmt}"
    if bucket_by:
        ddl += f" CLUSTERED BY ({', '.join(f'`{c}`' for c in bucket_by)}) INTO {int(buckets)} BUCKETS"
    if comment:
        ddl += f" COMMENT {_lit(comment)}"
    return ddl


def create_table(spark: SparkSession, name: str, schema: T.StructType, comment: str | None = None,
                 bucket_by: tuple[str, ...] = (), buckets: int | None = None) -> None:
    """Idempotent typed table creation; NOT NULL is kept as a data-quality rule, not a constraint."""
    spark.sql(table_ddl(name, schema, comment, bucket_by=bucket_by, buckets=buckets or default_buckets(spark)))


def default_buckets(spark: SparkSession) -> int:
    """Bucket count matching the shuffle partition count: a writer whose last shuffle is on the
    bucket key then needs no extra shuffle and writes one file per bucket."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table_buckets(spark: SparkSession, name: str) -> int | None:
    """Number of buckets of an existing table (from its extended description), or None."""
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_q(name)}").collect():
        if r[0] == "Num Buckets":
            return int(r[1])
    return None


def create_layer_tables(spark: SparkSession, layers: dict[str, str], buckets: int | None = None) -> list[str]:
    """Create every bronze / silver / gold table of the model in the given schemas."""
    made = []
    for spec in ALL_TABLES.values():
        name = qualified(layers[spec.layer], spec.name)
        create_table(spark, name, spec.schema, spec.comment, bucket_by=spec.bucket_by, buckets=buckets)
        made.append(name)
    return made


def write_table(df: DataFrame, name: str, *, schema: T.StructType | None = None, comment: str | None = None,
                mode: str = "overwrite", bucket_by: tuple[str, ...] = (), buckets: int | None = None,
                observe: tuple[Observation, list[Column]] | None = None) -> None:
    """Overwrite (or append to) a managed table, keeping its DDL when it already exists.

    The table is created from ``schema`` (or the DataFrame's) on first use; the
    data is then written with ``insertInto`` by column *name* order of the table.
    Bucketed tables are hash-partitioned on the bucket key first so every bucket
    is one file; Spark drops that repartition when the plan is already
    partitioned that way (e.g. by the dedupe window on the same key).  ``observe`` takes
    metrics of the rows as they go to the files, after that repartition: in the writing tasks, each of which
    counts once, and not in a map stage that may run again.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        create_table(spark, name, schema or df.schema, comment, bucket_by=bucket_by, buckets=buckets)
    cols = spark.table(name).columns
    out = df.select(*[F.col(c) for c in cols])
    if bucket_by:
        n = table_buckets(spark, name)
        if n:
            out = out.repartition(n, *bucket_by)
    if observe is not None:
        out = out.observe(observe[0], *observe[1])
    out.write.insertInto(name, overwrite=(mode == "overwrite"))


def write_spec_table(df: DataFrame, schema_name: str, spec: TableSpec, mode: str = "overwrite",
                     buckets: int | None = None, observe: tuple[Observation, list[Column]] | None = None) -> str:
    name = qualified(schema_name, spec.name)
    write_table(df, name, schema=spec.schema, comment=spec.comment, mode=mode, bucket_by=spec.bucket_by,
                buckets=buckets, observe=observe)
    return name


def rename_table(spark: SparkSession, old: str, new: str, *, replace: bool = False) -> None:
    """``ALTER TABLE old RENAME TO new``; with ``replace`` an existing target is dropped first
    so a rerun does not fail on ``TABLE_OR_VIEW_ALREADY_EXISTS``."""
    if replace and spark.catalog.tableExists(new):
        spark.sql(f"DROP TABLE {_q(new)}")
    spark.sql(f"ALTER TABLE {_q(old)} RENAME TO {_q(new)}")


def schema_report(df: DataFrame) -> list[tuple[str, str, bool, str | None]]:
    """(column_name, data_type, nullable, comment) of a DataFrame's schema (driver-side metadata only)."""
    return [(f.name, f.dataType.simpleString(), f.nullable, f.metadata.get("comment")) for f in df.schema.fields]


def use_schema(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def list_schemas(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]

"""CSV landing files -> typed bronze tables.

Reads always use an explicit schema (no inference pass over the data); the
CSV options below keep NULL, ``''`` and padded values distinct through a
write/read round trip, which the default options do not (they read ``''`` as
NULL and the writer strips surrounding spaces).  Schema inference stays
available as an opt-in for exploring unknown files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import IngestConfig
from ..session import observed
from .catalog import qualified, write_table

NULL_TOKEN = "\\N"
CORRUPT_COL = "_corrupt_record"

# enforceSchema=false: header names are checked against the schema, so a source that
# reorders its columns fails loudly instead of loading values into the wrong columns.
READ_OPTIONS = {"header": "true", "enforceSchema": "false", "nullValue": NULL_TOKEN, "mode": "PERMISSIVE",
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
WRITE_OPTIONS = {"header": "true", "nullValue": NULL_TOKEN, "emptyValue": '""',
                 "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


SOURCE_COL = "_source_file"
QUARANTINE = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("source_file", T.StringType()), T.StructField("line", T.StringType())])


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT_COL, T.StringType(), True)])


def write_quarantine(df: DataFrame, table: str, quarantine: str) -> None:
    """Append the lines of ``df`` (with the corrupt-line and source-file columns) that did not parse to ``quarantine``, as ``table_name, source_file, line``."""
    bad = df.where(F.col(CORRUPT_COL).isNotNull()).select(F.lit(table).alias("table_name"), F.col(SOURCE_COL).alias("source_file"), F.col(CORRUPT_COL).alias("line"))
    write_table(bad, quarantine, schema=QUARANTINE, comment="Lines that did not parse, with their file", mode="append")


def ingest_quarantined(spark: SparkSession, path: str, schema: T.StructType, table: str, quarantine: str, *, table_comment: str | None = None) -> tuple[int, int]:
    """CSV -> managed table without the lines that do not parse, which are appended to ``quarantine``; returns both counts.

    The counts are taken while the table is written; the files are read again only if some line is corrupt.
    """
    df = read_csv(spark, path, schema, keep_corrupt=True).select("*", F.col("_metadata.file_path").alias(SOURCE_COL))
    obs = Observation(f"ingest_{table.replace('.', '_')}")
    seen = df.observe(obs, F.count_if(F.col(CORRUPT_COL).isNull()).alias("rows"), F.count_if(F.col(CORRUPT_COL).isNotNull()).alias("corrupt"))
    write_table(seen.where(F.col(CORRUPT_COL).isNull()).select(*schema.fieldNames()), table, schema=schema, comment=table_comment)
    got = observed(obs)
    if got.get("corrupt", 0):
        bad = df.where(F.col(CORRUPT_COL).isNotNull()).persist()  # kept with all columns: a scan that prunes them would not parse them
        write_quarantine(bad, table, quarantine)
        bad.unpersist()
    return int(got.get("rows", 0)), int(got.get("corrupt", 0))


def merged_schema(spark: SparkSession, paths: list[str], options: dict | None = None) -> T.StructType:
    """One schema for several CSV files: columns in the order of their first appearance, each of the widest type that any file needs.

    Types are inferred file by file and widened int < bigint < double < string; date widens to timestamp; any other mixture is text.
    """
    wide = ["int", "bigint", "double"]
    found: dict[str, str] = {}
    for path in paths:
        for f in read_csv(spark, path, infer_schema=True, options=options).schema.fields:
            kind, was = f.dataType.simpleString(), found.get(f.name)
            if was is None or was == kind:
                found[f.name] = kind
            elif was in wide and kind in wide:
                found[f.name] = max(was, kind, key=wide.index)
            else:
                found[f.name] = "timestamp" if {was, kind} == {"date", "timestamp"} else "string"
    return T.StructType([T.StructField(c, T._parse_datatype_string(t), True) for c, t in found.items()])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, *,
             infer_schema: bool = False, keep_corrupt: bool = False, options: dict | None = None) -> DataFrame:
    """Typed CSV scan.  ``keep_corrupt`` adds ``_corrupt_record`` holding lines whose
    values did not parse (e.g. a bad date that would otherwise silently become NULL)."""
    opts = {**READ_OPTIONS, **(options or {})}
    reader = spark.read.options(**opts)
    if schema is not None:
        if keep_corrupt:
            schema = with_corrupt(schema)
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Write a landing-zone CSV folder that :func:`read_csv` reads back losslessly."""
    df.write.mode(mode).options(**WRITE_OPTIONS).csv(path)


def ingest(spark: SparkSession, path: str, schema: T.StructType, table: str, *,
           table_comment: str | None = None, mode: str = "overwrite", with_corrupt: bool = False):
    """CSV -> managed table in one job; returns the row count observed *during* the write
    (no second read of the files or the table).  With ``with_corrupt`` it returns
    ``(rows, corrupt_rows)``, counting lines whose values did not parse (they are
    still loaded, with NULL in the failed fields, as PERMISSIVE mode does)."""
    df = read_csv(spark, path, schema, keep_corrupt=with_corrupt)
    obs = Observation(f"ingest_{table.replace('.', '_')}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if with_corrupt:
        metrics.append(F.count_if(F.col(CORRUPT_COL).isNotNull()).alias("corrupt"))
    observed = df.observe(obs, *metrics)
    write_table(observed.select(*schema.fieldNames()), table, schema=schema, comment=table_comment, mode=mode)
    got = obs.get
    return (int(got["rows"]), int(got["corrupt"])) if with_corrupt else int(got["rows"])


def ingest_config(spark: SparkSession, config: IngestConfig, schemas: dict[str, T.StructType],
                  comments: dict[str, str] | None = None, parallel: int = 1) -> DataFrame:
    """Config-driven ingest of every source; returns (table_name, row_count, corrupt_rows, source_path).

    Each source is an independent job.  Large sources use the whole cluster on
    their own; many small ones leave it idle when run one by one, so
    ``parallel > 1`` submits that many ingest jobs concurrently from driver
    threads (Spark schedules concurrent jobs; each keeps its own observed
    counts).  The report is built from those counts, in config order.
    """
    from concurrent.futures import ThreadPoolExecutor

    def one(src):
        path = config.base_path.rstrip("/") + "/" + src.file_name
        table = qualified(config.target_schema, src.table_name)
        n, bad = ingest(spark, path, schemas[src.table_name], table, with_corrupt=True,
                        table_comment=(comments or {}).get(src.table_name) or src.description or None)
        return (src.table_name, n, bad, path)

    if parallel > 1 and len(config.sources) > 1:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            report = list(pool.map(one, config.sources))
    else:
        report = [one(src) for src in config.sources]
    return spark.createDataFrame(report, "table_name string, row_count bigint, corrupt_rows bigint, source_path string")

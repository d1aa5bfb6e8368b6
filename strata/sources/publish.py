"""Publishing a table: a new version is staged beside the old one and swapped in by one change of the catalog.

``INSERT OVERWRITE`` removes the old files before the new ones are committed, so readers may meet half a table, and a job that dies leaves
none.  Here every version is a folder of its own; the writer's commit marker must be there, and the content may be verified, before the
table's location moves to it.  A reader sees the old version or the new one, never a part; a job that dies leaves the old one in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .catalog import _lit, _q, table_ddl
from .verify import Written, verified

MARKER = "_SUCCESS"


def versions_root(spark: SparkSession, name: str) -> str:
    """The folder of a table's versions, in its schema's location (or the warehouse)."""
    parts = name.split(".")
    schema = parts[-2] if len(parts) > 1 else spark.catalog.currentDatabase()
    return f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{parts[-1]}__versions"


def current_version(spark: SparkSession, name: str) -> str | None:
    """The folder that the table reads now, or None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    return next(r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_q(name)}").collect() if r[0] == "Location")


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def committed(spark: SparkSession, version: str) -> bool:
    """Whether the version's writer finished: its commit marker is written after all tasks' files are in place."""
    fs, hadoop = _file_system(spark, version)
    return fs.exists(hadoop.Path(version, MARKER))


def publish_table(df: DataFrame, name: str, *, schema: T.StructType | None = None, comment: str | None = None, verify: bool = True) -> str:
    """Replace ``name``'s rows by ``df``'s in one step; returns the new version's folder.

    The table is created on first use, with ``schema``'s (or the DataFrame's) columns; later versions keep its columns, by name.  With ``verify``
    the staged files are read back and must match what was written.  On any failure the table still reads its last version;
    what was staged stays unread until :func:`drop_stale_versions`.  Versions that readers may still hold are not deleted here.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    known = spark.table(name).schema if exists else schema or df.schema
    wanted = T.StructType(list(known.fields))
    record = Written(name, wanted)
    version = f"{versions_root(spark, name)}/{uuid.uuid4().hex}"
    staged = df.select(*(df[c.name].cast(c.dataType).alias(c.name) for c in wanted.fields))
    staged.observe(record.observe[0], *record.observe[1]).write.parquet(version)
    if not committed(spark, version):
        raise RuntimeError(f"the writer of {version} left no commit marker")
    if verify:
        report = verified(record, spark.read.schema(wanted).parquet(version))
        if not all(report[3:]):
            raise RuntimeError(f"staged rows of {name} differ from what was written: {report}")
    if exists:
        spark.sql(f"ALTER TABLE {_q(name)} SET LOCATION {_lit(version)}")
    else:
        spark.sql(table_ddl(name, wanted, comment) + f" LOCATION {_lit(version)}")
    spark.catalog.refreshTable(name)
    return version


def drop_stale_versions(spark: SparkSession, name: str, keep: int = 1) -> int:
    """Delete all versions but the current one and the ``keep`` newest finished others; returns how many went.

    Run it when no reader of an older version and no publisher of this table is left.
    """
    root, now = versions_root(spark, name), current_version(spark, name)
    fs, hadoop = _file_system(spark, root)
    if not fs.exists(hadoop.Path(root)):
        return 0
    found = [s for s in fs.listStatus(hadoop.Path(root)) if s.getPath().getName() != (now or "").rstrip("/").split("/")[-1]]
    done = sorted((s for s in found if committed(spark, s.getPath().toString())), key=lambda s: s.getModificationTime(), reverse=True)
    spared = {s.getPath().toString() for s in done[:keep]}
    gone = [s for s in found if s.getPath().toString() not in spared]
    for s in gone:
        fs.delete(s.getPath(), True)
    return len(gone)

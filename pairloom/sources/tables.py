"""Named tables and table directories.

A table is replaced by writing the new rows beside it and moving the name over: a failing
write leaves the old rows, and a table may be replaced from a read of itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Between a table's name and the tag of a version that stands beside it for a moment.
_NEW, _OLD = "__new_", "__old_"


def load_dir(spark: SparkSession, base: str, rel: str, fmt: str = "parquet") -> DataFrame:
    """Scan the table directory ``base/rel``."""
    return spark.read.format(fmt).load(f"{base.rstrip('/')}/{rel}")


def load_table(spark: SparkSession, name: str) -> DataFrame:
    """The rows of table ``name``; one that a lost job left half replaced is put back first."""
    if not spark.catalog.tableExists(name):
        _put_back(spark, name)
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop ``name``, if it exists, with the rows that ``save_table`` wrote for it."""
    held = _location(spark, name) if spark.catalog.tableExists(name) else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if _own(held):
        remove_dir(spark, held)


def register_table(
    spark: SparkSession, name: str, path: str, fmt: str = "parquet", copy: bool = True
) -> DataFrame:
    """Register the directory ``path`` as table ``name``, replacing an earlier one.

    With ``copy`` the table owns its data. Without it the table points at ``path``:
    nothing is rewritten, which is the cheap choice for large inputs. A path that cannot be
    read leaves the earlier table as it is.
    """
    source = spark.read.format(fmt).load(path)
    if copy:
        return save_table(source, name)
    _put_back(spark, name)
    beside = f"{name}{_NEW}{uuid.uuid4().hex[:12]}"
    spark.catalog.createTable(beside, path=path, source=fmt)
    _take_name(spark, beside, name)
    return spark.table(name)


def save_table(
    df: DataFrame, name: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write ``df`` once and return the stored table.

    Reading the result back also cuts lineage: an expensive upstream, such as
    inference, runs once however often the table is used.

    An overwrite is safe against failures and may read the table it replaces. The new rows
    are written beside the old ones first. Then, where columns stay as they are, the table's
    location moves in one step of the catalog. Where columns or partitions change, the old
    table is renamed away and the new one takes its name; should the driver die between these
    two steps, the next ``load_table`` or ``save_table`` puts the old one back. Old rows are
    removed at the end.
    """
    spark = df.sparkSession
    if mode != "overwrite":
        df.write.mode(mode).partitionBy(*partition_by).saveAsTable(name)
        return spark.table(name)
    _put_back(spark, name)
    tag = f"{_NEW}{uuid.uuid4().hex[:12]}"
    *db, table = name.replace("`", "").split(".")
    base = spark.catalog.getDatabase(".".join(db) or spark.catalog.currentDatabase()).locationUri
    folder = f"{base.rstrip('/')}/{table}{tag}"
    moves = not partition_by and _moves(spark, name, df.schema)
    try:
        writer = df.write.format("parquet").option("path", folder)
        if moves:
            writer.save()
        else:
            writer.partitionBy(*partition_by).saveAsTable(f"{name}{tag}")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {name}{tag}")
        remove_dir(spark, folder)
        raise
    if moves:
        old = _location(spark, name)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        remove_dir(spark, old)
    else:
        _take_name(spark, f"{name}{tag}", name)
    return spark.table(name)


def replace_partitions(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Put the rows of ``df`` into table ``name`` in place of those with the same ``keys``.

    The table, one of this module, is partitioned by ``keys`` and made on the first call. Only partitions that ``df``
    has rows for are replaced, all in one commit, so a repeated call leaves one set of rows.
    Columns go by name; the first call decides which there are.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        save_table(df.limit(0), name, partition_by=keys)
    wanted = spark.table(name).columns
    if set(wanted) != set(df.columns):
        raise ValueError(f"table {name} has columns {wanted}, not {df.columns}")
    writer = df.select(*wanted).write.mode("overwrite").partitionBy(*keys)
    writer.option("partitionOverwriteMode", "dynamic").parquet(_location(spark, name))
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def ensure_namespace(
    spark: SparkSession, db: str, location: str | None = None, use: bool = True
) -> None:
    """Create database ``db`` if absent (at ``location`` if given) and switch to it."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{at}")
    if use:
        spark.catalog.setCurrentDatabase(db)


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create the folder ``path`` if absent, on whatever file system it names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove the folder ``path``, if it is there, with all it holds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether the folder ``path`` exists and holds more than what a lost job left behind."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(folder))


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """A DataFrame from a few driver-side rows with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Any ``n`` rows, for a person to look at."""
    return df.limit(n)


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[-1].data_type if rows else ""


def _own(location: str) -> bool:
    """Whether ``save_table`` chose this folder, and not a user who registered files in place."""
    return _NEW in location.rstrip("/").rsplit("/", 1)[-1]


def _moves(spark: SparkSession, name: str, schema: StructType) -> bool:
    """Whether new rows of ``schema`` can take the table's place by its location alone."""
    if not spark.catalog.tableExists(name):
        return False
    columns = [(f.name, f.dataType) for f in schema]
    same = [(f.name, f.dataType) for f in spark.table(name).schema] == columns
    partitioned = any(c.isPartition for c in spark.catalog.listColumns(name))
    return same and not partitioned and _own(_location(spark, name))


def _take_name(spark: SparkSession, beside: str, name: str) -> None:
    old = f"{name}{_OLD}{uuid.uuid4().hex[:12]}"
    exists = spark.catalog.tableExists(name)
    if exists:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    if exists:
        drop_table(spark, old)


def _put_back(spark: SparkSession, name: str) -> None:
    """Undo a replacement that a lost driver left between its two renames."""
    if spark.catalog.tableExists(name):
        return
    *db, table = name.replace("`", "").split(".")
    database = ".".join(db) or spark.catalog.currentDatabase()
    if not spark.catalog.databaseExists(database):
        return
    left = [t.name for t in spark.catalog.listTables(database, f"{table}{_OLD}*")]
    if left:
        prefix = f"{database}." if db else ""
        spark.sql(f"ALTER TABLE {prefix}{max(left)} RENAME TO {name}")

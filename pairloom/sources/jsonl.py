"""JSON Lines: a directory of part files, or exactly one named file."""

from __future__ import annotations

import os
import uuid

from py4j.java_gateway import JavaObject
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from pairloom.operators.rows import head_k
from pairloom.sources.tables import load_table

PAIR_SCHEMA = StructType(
    [StructField("prompt", StringType()), StructField("response", StringType())]
)

#: Bytes that one task copies at a time into a file that many tasks fill.
PIECE_BYTES = 64 << 20


def write_jsonl(df: DataFrame, directory: str) -> None:
    """Write one JSON object per line, in parallel, replacing ``directory``.

    Null fields are left out of their line; :func:`read_jsonl` restores them.
    """
    df.write.mode("overwrite").json(directory)


def read_jsonl(spark: SparkSession, path: str, schema: StructType = PAIR_SCHEMA) -> DataFrame:
    """Read JSON Lines with a fixed schema, so no pass over the data to infer one.

    Broken lines read as nulls; :func:`read_jsonl_checked` tells them apart.
    """
    return spark.read.schema(schema).json(path)


def read_jsonl_checked(
    spark: SparkSession, path: str, schema: StructType = PAIR_SCHEMA, required: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejected)``: the rows of good lines, and ``(file, line, reason)`` of all others.

    Every line of the files is in one of the two frames. Reasons are ``blank``; ``not one object``
    for lines that are cut off, hold something else than one JSON object, or go on after it;
    ``wrong type`` where a value does not fit its field; and ``no <field>`` where one of the
    ``required`` fields is missing or null. Fields beyond the schema are left out. Both frames
    read the files when used; nothing is shuffled or held.
    """
    names = [f.name for f in schema]
    corrupt = "_corrupt"
    while corrupt in names:
        corrupt += "_"
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    # In an array of its own, a line parses as one element only if it is one whole object: the
    # parser stops after a first object, whatever follows it on the line.
    only = F.from_json(F.concat(F.lit("["), "line", F.lit("]")), ArrayType(StructType([])))
    strict = StructType([*schema.fields, StructField(corrupt, StringType())])
    row = F.from_json("line", strict, {"columnNameOfCorruptRecord": corrupt})
    object_like = F.rlike("line", F.lit(r"^\s*\{"))
    parsed = lines.select("*", row.alias("row"), (object_like & (F.coalesce(F.size(only), F.lit(0)) == 1)).alias("whole"))
    reason = (
        F.when(F.rlike("line", F.lit(r"^\s*$")), "blank")
        .when(~F.col("whole"), "not one object")
        .when(F.col("row").isNull() | F.col(f"row.`{corrupt}`").isNotNull(), "wrong type")
    )
    for name in required:
        reason = reason.when(F.col(f"row.`{name}`").isNull(), f"no {name}")
    judged = parsed.select("*", reason.alias("reason"))
    kept = judged.where("reason IS NULL").select(*[F.col(f"row.`{n}`").alias(n) for n in names])
    return kept, judged.where("reason IS NOT NULL").select("file", "line", "reason")


def export_single_jsonl(df: DataFrame, path: str) -> None:
    """Publish ``df`` as exactly one JSON Lines file at ``path``.

    All executors write part files to a scratch folder beside ``path``. Where the file
    system can join files (HDFS), the parts become one file by a metadata change and
    no row moves again. On a mounted file system (``file:``), which all executors must see, many
    tasks copy pieces of the parts to their places in one file. Elsewhere one task streams the
    finished parts, line by line and whatever their size, into one file; :func:`write_jsonl` is
    the parallel form. The file appears under its name only when complete.
    """
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    fs = target.getFileSystem(conf)
    scratch = spark._jvm.org.apache.hadoop.fs.Path(
        target.getParent(), f"_{target.getName()}-{uuid.uuid4().hex}"
    )
    try:
        write_jsonl(df, str(scratch))
        parts = _part_files(fs, scratch)
        if len(parts) > 1:
            # A raw local file system claims the capability but drops the first file.
            joins = fs.hasPathCapability(scratch, "fs.capability.paths.concat")
            if fs.getScheme() == "file":
                parts = _copy_pieces(spark, fs, scratch, parts)
            elif joins:
                parts = _join_files(spark, fs, parts)
            else:
                parts = _copy_to_one(spark, fs, scratch)
        if len(parts) != 1:
            raise RuntimeError(f"expected one part file in {scratch}, found {len(parts)}")
        _replace(spark, fs, conf, parts[0], target)
    finally:
        fs.delete(scratch, True)


def table_to_jsonl(
    spark: SparkSession,
    table: str,
    path: str,
    limit: int | None = None,
    order_by: list[str] | None = None,
) -> None:
    """Export a whole table, or its first ``limit`` rows by ``order_by``, as one file."""
    df = load_table(spark, table)
    if limit is not None:
        df = head_k(df, limit, order_by or df.columns)
    export_single_jsonl(df, path)


def _part_files(fs: JavaObject, folder: JavaObject) -> list[JavaObject]:
    """Non-empty part files by name; one empty file if nothing was written."""
    found = sorted(
        (s for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")),
        key=lambda s: s.getPath().getName(),
    )
    full = [s.getPath() for s in found if s.getLen() > 0]
    return full or [s.getPath() for s in found[:1]]


def _join_files(spark: SparkSession, fs: JavaObject, parts: list[JavaObject]) -> list[JavaObject]:
    rest = spark.sparkContext._gateway.new_array(
        spark._jvm.org.apache.hadoop.fs.Path, len(parts) - 1
    )
    for i, part in enumerate(parts[1:]):
        rest[i] = part
    size = sum(fs.getFileStatus(part).getLen() for part in parts)
    fs.concat(parts[0], rest)
    if fs.getFileStatus(parts[0]).getLen() != size:
        raise RuntimeError(f"joining {len(parts)} part files lost data")
    return parts[:1]


def _pieces(sizes: list[int]) -> list[tuple[int, int, int, int]]:
    """``(part, from, to, length)``: runs of at most ``PIECE_BYTES``, the parts one after another."""
    out, base = [], 0
    for part, size in enumerate(sizes):
        out += [(part, at, base + at, min(PIECE_BYTES, size - at)) for at in range(0, size, PIECE_BYTES)]
        base += size
    return out


def _copy_pieces(spark: SparkSession, fs: JavaObject, scratch: JavaObject, parts: list[JavaObject]) -> list[JavaObject]:
    """The parts joined in one file, whose pieces are written by a task each.

    A task that is run again writes the same bytes to the same place. A task that does not see
    the parts fails, and so does the export if the file is not as long as all parts together.
    """
    merged = spark._jvm.org.apache.hadoop.fs.Path(scratch, "_one")
    target = merged.toUri().getPath()
    names = [part.toUri().getPath() for part in parts]
    sizes = [fs.getFileStatus(part).getLen() for part in parts]
    jobs = [(names[part], *rest) for part, *rest in _pieces(sizes)]

    def copy(job: tuple[str, int, int, int]) -> int:
        name, at, to, left = job
        written = 0
        with open(name, "rb") as source, open(os.open(target, os.O_WRONLY | os.O_CREAT, 0o644), "wb") as out:
            source.seek(at)
            out.seek(to)
            while left and (data := source.read(min(left, 1 << 20))):
                out.write(data)
                left -= len(data)
                written += len(data)
            out.flush()
            os.fsync(out.fileno())
        return written

    written = spark.sparkContext.parallelize(jobs, len(jobs)).map(copy).sum()
    if written != sum(sizes) or fs.getFileStatus(merged).getLen() != written:
        raise RuntimeError(f"joining {len(parts)} part files lost data")
    return [merged]


def _copy_to_one(spark: SparkSession, fs: JavaObject, scratch: JavaObject) -> list[JavaObject]:
    merged = f"{scratch}/_one"
    lines = spark.read.option("lineSep", "\n").text(str(scratch))
    lines.coalesce(1).write.option("lineSep", "\n").text(merged)
    return _part_files(fs, spark._jvm.org.apache.hadoop.fs.Path(merged))


def _replace(spark: SparkSession, fs: JavaObject, conf: JavaObject, source: JavaObject, target: JavaObject) -> None:
    if fs.getScheme() == "file":
        # The sums of a file that is replaced do not go with it when the new one has none.
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.crc"), False)
    rename = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    context.rename(context.makeQualified(source), context.makeQualified(target), options)

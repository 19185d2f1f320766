"""Queries that go through tables and files; what they write lies in the workspace."""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pairloom.operators import splits
from pairloom.plans import views
from pairloom.sources import jsonl, tables
from pairloom.sources.workspace import workspace


def namespace(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    db, folder = workspace(spark, sf_dir)
    tables.ensure_namespace(spark, db, f"{folder}/db", use=False)
    return db, folder


def fresh(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str]:
    """A table name and a folder that no other call has, so that no result replaces another."""
    db, folder = namespace(spark, sf_dir)
    name = f"{name}_{uuid.uuid4().hex[:12]}"
    return f"{db}.{name}", f"{folder}/{name}"


def saved(df: DataFrame, name: str, sf_dir: str) -> DataFrame:
    """``df`` written once as a workspace table and read back."""
    return tables.save_table(df, fresh(df.sparkSession, sf_dir, name)[0])


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.ift(spark, sf_dir).select("prompt", "response")


def scan_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.load_dir(spark, sf_dir, "documents.parquet").select("doc_id", "text", "lang")


def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that points at the given files; no data is copied to register it."""
    name, _ = fresh(spark, sf_dir, "documents_in_place")
    tables.register_table(spark, name, f"{sf_dir}/documents.parquet", copy=False)
    return tables.load_table(spark, name).select("doc_id", "text", "lang")


def register_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, _ = fresh(spark, sf_dir, "documents_copy")
    return tables.register_table(spark, name, f"{sf_dir}/documents.parquet")


def save_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saved(views.ift(spark, sf_dir), "ift", sf_dir)


def save_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides saved in one job, and each read back from its own files."""
    name, _ = fresh(spark, sf_dir, "ift_by_split")
    stored = splits.save_splits(views.ift(spark, sf_dir), name)
    return stored.where(F.col("split") == "eval").unionByName(stored.where(F.col("split") == "train"))


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs written as a JSON Lines directory and read back; every fifth response is null."""
    _, folder = fresh(spark, sf_dir, "pairs")
    pairs = views.ift(spark, sf_dir).select(
        "prompt", F.when(F.col("row_key") % 5 != 0, F.col("response")).alias("response")
    )
    jsonl.write_jsonl(pairs, folder)
    return jsonl.read_jsonl(spark, folder)


def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table after a write that fails, and then replaced twice from reads of itself."""
    name, _ = fresh(spark, sf_dir, "documents")
    docs = tables.save_table(views.documents(spark, sf_dir).select("doc_id", "text", "lang"), name)
    largest = docs.agg(F.max("doc_id")).first()[0]
    broken = F.when(F.col("doc_id") == largest, F.raise_error(F.lit("lost"))).otherwise(F.col("text"))
    try:
        tables.save_table(docs.withColumn("text", broken), name)
    except PySparkException:
        pass  # the rows of the first write still stand
    same = tables.save_table(tables.load_table(spark, name).where("lang <> 'fr'"), name)
    return tables.save_table(same.withColumn("n_characters", F.length("text").cast("bigint")).drop("text"), name)


def jsonl_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some are broken by rules on the row's key, read back and told apart."""
    _, folder = fresh(spark, sf_dir, "lines")
    key, start = F.col("row_key").cast("string"), F.concat(F.lit('{"row_key":'), F.col("row_key").cast("string"))
    whole = F.to_json(F.struct("row_key", "prompt", "response"))
    line = (
        F.when(F.col("row_key") % 7 == 0, F.concat(start, F.lit(',"prompt":"cut')))
        .when(F.col("row_key") % 11 == 0, F.concat(start, F.lit(',"prompt":"p"}{"prompt":"q"}')))
        .when(F.col("row_key") % 13 == 0, F.concat(F.lit('{"row_key":"n'), key, F.lit('","prompt":"p"}')))
        .when(F.col("row_key") % 17 == 0, F.concat(start, F.lit(',"prompt":null}')))
        .when(F.col("row_key") % 19 == 0, F.concat(F.lit("["), key, F.lit("]")))
        .otherwise(whole)
    )
    views.ift(spark, sf_dir).select(line.alias("value")).write.text(folder)
    schema = StructType([StructField("row_key", LongType()), *jsonl.PAIR_SCHEMA.fields])
    kept, rejected = jsonl.read_jsonl_checked(spark, folder, schema, required=["prompt"])
    none = F.lit(None).cast("string")
    return kept.select("row_key", "prompt", "response", none.alias("line"), none.alias("reason")).unionByName(
        rejected.select(F.lit(None).cast("bigint").alias("row_key"), none.alias("prompt"), none.alias("response"), "line", "reason")
    )


def export_single_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, folder = fresh(spark, sf_dir, "export")
    path = f"{folder}/train.jsonl"
    train = views.ift(spark, sf_dir).where(F.col("split") == "train").select("prompt", "response")
    jsonl.export_single_jsonl(train, path)
    return jsonl.read_jsonl(spark, path)


def table_to_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, folder = fresh(spark, sf_dir, "pairs")
    path = f"{folder}/pairs.jsonl"
    tables.save_table(_pairs(spark, sf_dir), name)
    jsonl.table_to_jsonl(spark, name, path)
    tables.drop_table(spark, name)
    return jsonl.read_jsonl(spark, path)


def from_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A planned number of epochs per split, given as rows, applied to the splits' sizes."""
    plan = tables.from_rows(spark, [("train", 3), ("eval", 1)], "split string, epochs int")
    sizes = views.ift(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    return sizes.join(F.broadcast(plan), "split").select(
        "split", "epochs", "n_rows", (F.col("n_rows") * F.col("epochs")).alias("rows_seen")
    )


def namespace_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create and enter a namespace, save a table there by its bare name, and fill a folder."""
    db, folder = workspace(spark, f"{sf_dir}#{uuid.uuid4().hex}")
    before = spark.catalog.currentDatabase()
    try:
        tables.ensure_namespace(spark, db, f"{folder}/db")
        entered = spark.catalog.currentDatabase() == db
        ids = tables.save_table(views.documents(spark, sf_dir).select("doc_id"), "doc_ids")
    finally:
        spark.catalog.setCurrentDatabase(before)
    tables.ensure_dir(spark, f"{folder}/volume")
    jsonl.write_jsonl(ids, f"{folder}/volume/doc_ids")
    stored = jsonl.read_jsonl(spark, f"{folder}/volume/doc_ids", ids.schema)
    return stored.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(spark.catalog.databaseExists(db)).alias("exists"),
        F.lit(entered).alias("entered"),
        "n_rows",
    )


def drop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's rows while it stands, and whether it exists before and after its drop."""
    name, _ = fresh(spark, sf_dir, "dropped")
    docs = views.documents(spark, sf_dir).select("doc_id")
    n_rows = tables.save_table(docs, name).count()
    existed = spark.catalog.tableExists(name)
    tables.drop_table(spark, name)
    return docs.agg(F.count(F.lit(1)).alias("n_source")).select(
        "n_source",
        F.lit(n_rows).cast("bigint").alias("n_saved"),
        F.lit(existed).alias("exists_before"),
        F.lit(spark.catalog.tableExists(name)).alias("exists_after"),
    )


QUERIES = {
    "scan_dir": scan_dir,
    "scan_table": scan_table,
    "register_table": register_table,
    "save_table": save_table,
    "save_splits": save_splits,
    "replace_table": replace_table,
    "jsonl_roundtrip": jsonl_roundtrip,
    "jsonl_checked": jsonl_checked,
    "export_single_jsonl": export_single_jsonl,
    "table_to_jsonl": table_to_jsonl,
    "from_rows": from_rows,
    "namespace_ddl": namespace_ddl,
    "drop_table": drop_table,
}

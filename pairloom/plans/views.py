"""Input views of the registered queries, derived from the given tables.

The tables hold no nulls, so fixed rules on the row id put nulls and empty strings in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.hashing import digest
from pairloom.functions.payload import GenParams
from pairloom.functions.readability import token_count
from pairloom.functions.text import TITLE_TEMPLATE, add_prompt
from pairloom.operators.infer import batch_infer, lead_scorer
from pairloom.operators.rows import dedup, filter_null_or_empty
from pairloom.operators.splits import hash_split
from pairloom.sources.tables import load_dir

SEED = 42
WEIGHTS = {"train": 0.9, "eval": 0.1}
PARAMS = GenParams(max_tokens=100, temperature=1.0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_dir(spark, sf_dir, "documents.parquet")


def blogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text, title)`` with null and empty values in both texts."""
    i, text = F.col("doc_id"), F.col("text")
    return documents(spark, sf_dir).select(
        "doc_id",
        F.when(i % 17 == 0, "").when(i % 19 == 0, None).otherwise(text).alias("text"),
        F.when(i % 11 == 0, None)
        .when(i % 13 == 0, "")
        .otherwise(F.substring_index(text, "\n", 1))
        .alias("title"),
    )


def code_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, element_type, args, doc_string, source)``: Python elements in table form."""
    i = F.col("doc_id")
    args = (
        F.when(i % 5 == 0, None)
        .when(i % 5 == 1, "")
        .otherwise(F.concat(F.lit("a"), (i % 5).cast("string")))
    )
    body = F.concat(
        "text",
        F.when(i % 2 == 0, "\nParameters\n----------\n").otherwise("\n"),
    )
    source = F.format_string(
        'def f%d(%s):\n    """%s"""\n    return 1\n', i, F.coalesce(args, F.lit("")), body
    )
    kind = F.when(i % 3 == 0, "function").when(i % 3 == 1, "class").otherwise("method")
    return documents(spark, sf_dir).select(
        "doc_id",
        kind.alias("element_type"),
        args.alias("args"),
        F.when(i % 7 == 0, None).otherwise(body).alias("doc_string"),
        source.alias("source"),
    )


def filtered_blogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_null_or_empty(blogs(spark, sf_dir), ["text", "title"])


def deduped_blogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(filtered_blogs(spark, sf_dir), ["text", "title"], order_by="doc_id")


def split_blogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ift`` with the source text still on it."""
    pairs = add_prompt(deduped_blogs(spark, sf_dir), TITLE_TEMPLATE, "text").select(
        F.col("doc_id").alias("row_key"), "text", "prompt", F.col("title").alias("response")
    )
    return hash_split(pairs, WEIGHTS, SEED, ["prompt", "response"])


def blog_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_key, split, n_tokens)`` of ``ift``: what counts need, without a text in a shuffle.

    Sides and tokens are computed from each text where it lies; copies combine by digest.
    """
    pairs = add_prompt(filtered_blogs(spark, sf_dir), TITLE_TEMPLATE, "text").select(
        "doc_id", "text", "title", "prompt", F.col("title").alias("response")
    )
    sides = hash_split(pairs, WEIGHTS, SEED, ["prompt", "response"])
    rows = sides.select(
        F.col("doc_id").alias("row_key"),
        digest(F.col("text")).alias("_t"),
        digest(F.col("title")).alias("_r"),
        (F.col("split") == "train").cast("int").alias("_train"),
        (token_count(F.col("prompt")) + token_count(F.col("response"))).alias("_n"),
    )
    # Copies agree in side and tokens; numbers keep the aggregation hash-based.
    one = rows.groupBy("_t", "_r").agg(F.min("row_key").alias("row_key"), F.max("_train").alias("_train"), F.max("_n").alias("n_tokens"))
    return one.select("row_key", F.when(F.col("_train") == 1, "train").otherwise("eval").alias("split"), "n_tokens")


def ift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_key, prompt, response, split)``: distinct pairs, each on its side."""
    return split_blogs(spark, sf_dir).select("row_key", "prompt", "response", "split")


def llm_out(spark: SparkSession, sf_dir: str, max_tokens: int = PARAMS.max_tokens) -> DataFrame:
    """``(row_key, prompt, response, llm_response)``: the evaluation side with generations."""
    eval_side = split_blogs(spark, sf_dir).where(F.col("split") == "eval")
    params = GenParams(max_tokens, PARAMS.temperature)
    return batch_infer(eval_side, "text", lead_scorer(), params).select(
        "row_key", "prompt", "response", "llm_response"
    )

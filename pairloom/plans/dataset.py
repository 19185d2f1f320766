"""Queries that build, count and split instruction pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.html import extract_article
from pairloom.functions.text import (
    DOCSTRING_TEMPLATE,
    TITLE_TEMPLATE,
    add_prompt,
    between_delimiters,
    clean_text,
)
from pairloom.operators import counts, handoff, rows, splits
from pairloom.operators.exact_split import exact_split as exact
from pairloom.plans import views
from pairloom.sources.tables import load_dir

EPOCHS = 3


def filter_null_or_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.filtered_blogs(spark, sf_dir)


def filter_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.filter_report(views.blogs(spark, sf_dir), ["text", "title"])


def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.deduped_blogs(spark, sf_dir)


def dedup_whole_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which no two have the same text, with all their columns."""
    return rows.dedup_rows(views.documents(spark, sf_dir), ["text"], "doc_id")


def ift_pairs_blog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title pairs: filter, deduplicate, fill the template."""
    pairs = add_prompt(views.deduped_blogs(spark, sf_dir), TITLE_TEMPLATE, "text")
    return pairs.select("prompt", F.col("title").alias("response"))


def documented_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.select_documented_functions(views.code_elements(spark, sf_dir))


def ift_pairs_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Docstring pairs: select functions, cut the signature, fill the template."""
    pairs = add_prompt(documented_functions(spark, sf_dir), DOCSTRING_TEMPLATE, "fn_def")
    return pairs.select("prompt", F.col("doc_string").alias("response"))


def extract_docstring(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = views.code_elements(spark, sf_dir)
    # Every fourth source loses its quotes, to show the case without a docstring.
    bare = F.replace("source", F.lit('"""'), F.lit(""))
    source = F.when(F.col("doc_id") % 4 == 0, bare).otherwise(F.col("source"))
    return code.select("doc_id", between_delimiters(source).alias("docstring"))


def sample_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.sample_row(views.ift(spark, sf_dir), "row_key").select("row_key", "prompt")


def head_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    eval_side = views.ift(spark, sf_dir).where(F.col("split") == "eval")
    return rows.head_k(eval_side.select("row_key", "prompt"), 2, "row_key")


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.row_count(views.blog_keys(spark, sf_dir))


def column_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.column_counts(views.blogs(spark, sf_dir))


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.split_counts(views.blog_keys(spark, sf_dir))


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both parts together again: every row is in exactly one."""
    pairs = views.ift(spark, sf_dir).drop("split")
    train, evaluation = splits.random_split(pairs, [0.9, 0.1], views.SEED)
    return train.unionByName(evaluation)


def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly nine tenths and one tenth of the rows, by the hash of their keys."""
    keys = views.blog_keys(spark, sf_dir).select("row_key")
    return exact(keys, views.WEIGHTS, views.SEED, ["row_key"])


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.blog_keys(spark, sf_dir).select("row_key", "split")


def clean_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with space put before punctuation and quotes escaped, cleaned again."""
    rough = F.replace(F.replace("text", F.lit(","), F.lit(" ,")), F.lit("."), F.lit(" ."))
    rough = F.concat(rough, F.lit(" it\\'s"))
    return views.documents(spark, sf_dir).select("doc_id", clean_text(rough).alias("cleaned"))


def html_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load_dir(spark, sf_dir, "pages.parquet")
    return extract_article(pages, "html", parse=False).drop("html")


def html_article_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose headings are put into containers of their own, inside the page's container."""
    inner = F.replace("html", F.lit("<h1>"), F.lit('<article class="head"><h1>'))
    pages = load_dir(spark, sf_dir, "pages.parquet").withColumn("html", F.replace(inner, F.lit("</h1>"), F.lit("</h1></article>")))
    return extract_article(pages, "html", parse=False, nested=True).drop("html")


def html_article_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load_dir(spark, sf_dir, "pages.parquet")
    return extract_article(pages, "html").drop("html")


def validate_ift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return handoff.validate_split(views.ift(spark, sf_dir))


def training_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return handoff.training_profile(views.blog_keys(spark, sf_dir), EPOCHS, tokens_col="n_tokens")


def run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known of a run over this dataset before it starts, as key/value rows."""
    profile = training_profile(spark, sf_dir)
    facts = {
        f"{side}_{name}": F.max(F.when(F.col("split") == side, F.col(name)))
        for side in ("train", "eval")
        for name in ("n_rows", "n_tokens")
    }
    facts |= {"epochs": F.max(F.lit(EPOCHS)), "total_tokens": F.max(F.when(F.col("split") == "train", F.col("total_tokens")))}
    return handoff.unpivot_record(profile.agg(*[c.alias(k) for k, c in facts.items()]), list(facts))


QUERIES = {
    "filter_null_or_empty": filter_null_or_empty,
    "filter_report": filter_report,
    "dedup_exact": dedup_exact,
    "dedup_whole_rows": dedup_whole_rows,
    "ift_pairs_blog": ift_pairs_blog,
    "documented_functions": documented_functions,
    "ift_pairs_code": ift_pairs_code,
    "extract_docstring": extract_docstring,
    "sample_prompt": sample_prompt,
    "head_k": head_k,
    "row_count": row_count,
    "column_counts": column_counts,
    "split_counts": split_counts,
    "random_split": random_split,
    "exact_split": exact_split,
    "hash_split": hash_split,
    "clean_text": clean_text_query,
    "html_article": html_article,
    "html_article_nested": html_article_nested,
    "html_article_parsed": html_article_parsed,
    "validate_ift": validate_ift,
    "training_profile": training_profile,
    "run_record": run_record,
}

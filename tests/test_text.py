"""String expressions, HTML text and the plans they make."""

import pytest
from pyspark.sql import functions as F

from pairloom.functions import html, readability, text
from pairloom.plans import dataset, scoring
from pairloom.sources.tables import from_rows

PAGES = {
    "none": ("<html><p>x</p></html>", ""),
    "plain": ("<article><h1>A</h1><p>b , c .</p></article>", "A b, c."),
    "entities": ("<article>R&amp;D &lt;b&gt; &amp;lt;&nbsp;</article>", "R&D <b> &lt;"),
    "no_semicolon": ("<article>a &amp b&amp;amp</article>", "a & b&amp"),
    "hidden": ("<article>a<script>x='</p>'</script><!-- > n -->b<style>p{}</style></article>", "a b"),
    "spaces": ("<article><p>\n  a  b \t</p><p> </p>c</article>", "a  b c"),
    "first": ("<article>a</article><article>b</article>", "a"),
    "attributes": ('<article id="1" class="x">a<br/>b</article>', "a b"),
    "other_tag": ("<articles>n</articles><article>y</article>", "y"),
    "escaped": ("<article>it\\'s</article>", "it's"),
}


def value(spark, column, *texts):
    """The column's value for one row of texts named a, b, ..."""
    names = [chr(ord("a") + i) for i in range(len(texts))]
    schema = ", ".join(f"{n} string" for n in names)
    return from_rows(spark, [texts], schema).select(column.alias("v")).first().v


def test_prompt_layout(spark):
    template = text.PromptTemplate("Do it.", "### In", "### Out")
    assert value(spark, template.prompt(F.col("a")), "x\ny") == "Do it.\n### In\nx\ny\n### Out\n"
    assert value(spark, template.prompt(F.col("a")), None) is None


@pytest.mark.parametrize(
    "source, before, between",
    [
        ('def f(a):\n    """Doc."""\n', "def f(a):\n    ", "Doc."),
        ("def f(a):", "def f(a):", None),
        ('x """open', "x ", "open"),
        ("plain", "plain", None),
        ("", "", None),
        (None, None, None),
    ],
)
def test_delimiters(spark, source, before, between):
    assert value(spark, text.before_delimiter(F.col("a")), source) == before
    assert value(spark, text.between_delimiters(F.col("a")), source) == between


def test_delimiter_is_taken_literally(spark):
    assert value(spark, text.between_delimiters(F.col("a"), "$.|"), "a$.|b$.|c") == "b"


def test_clean_text(spark):
    assert value(spark, text.clean_text(F.col("a")), "a , b . it\\'s") == "a, b. it's"


@pytest.mark.parametrize("name", list(PAGES))
@pytest.mark.parametrize("form", [html.pattern_text, html.nested_text, html.parsed_text])
def test_article_text(spark, form, name):
    page, wanted = PAGES[name]
    assert value(spark, form(F.col("a")), page) == wanted


@pytest.mark.parametrize("form", [html.pattern_text, html.nested_text, html.parsed_text])
def test_container_by_class(spark, form):
    page = '<div class="menu">n</div><div id="d" class="x rich-text y">a<p>b</p></div>'
    assert value(spark, form(F.col("a"), "div", "rich-text"), page) == "a b"
    assert value(spark, form(F.col("a"), "div", "rich"), page) == ""


def test_nested_containers_and_broken_markup_are_parsed(spark):
    page = '<div class="t">a<div>b</div><p>c &hellip; 1 < 2</div>d'
    assert value(spark, html.parsed_text(F.col("a"), "div", "t"), page) == "a b c … 1 < 2"
    assert value(spark, html.parsed_text(F.col("a"), "div", "t"), '<div class="t">a') == "a"
    assert value(spark, html.parsed_text(F.col("a")), None) is None


NESTED = {
    "inside": ('<div class="t">a<div>b</div><p>c</p></div>d', "a b c"),
    "deep": ('x<div class="n">n</div><div id=1 class="s t">a<div><div class="t">b</div>c</div>d</div>e<div class="t">f</div>', "a b c d"),
    "left open": ('<div class="t">a<div>b</div><p>c', "a b c"),
    "closed too often": ("</div></div><div class='t'>a</div></div>b", "a"),
    "hidden tags": ('<div class="t">a<!-- </div> --><script>"</div>"</script><style></div></style>b</div>c', "a b"),
    "empty": ('<div class="t"></div>a', ""),
    "none": ("<div>a</div>", ""),
    "self-closed": ('<div class="t">a<div/>b</div>c', "a b"),
    "bare class": ("<div class=t>a<div>b</div></div>c", "a b"),
}


@pytest.mark.parametrize("name", list(NESTED))
@pytest.mark.parametrize("form", [html.nested_text, html.parsed_text])
def test_containers_inside_containers(spark, form, name):
    page, wanted = NESTED[name]
    assert value(spark, form(F.col("a"), "div", "t"), page) == wanted


def test_nested_text_of_null(spark):
    assert value(spark, html.nested_text(F.col("a")), None) is None


def test_counts(spark):
    sample = " One two.\n\tThree!? Yé aeiou "
    a = F.col("a")
    assert value(spark, readability.token_count(a), sample) == 5
    assert value(spark, readability.sentence_count(a), sample) == 2
    assert value(spark, readability.syllable_count(a), sample) == 6
    assert value(spark, readability.token_count(a), "") == 0
    assert value(spark, readability.token_count(a), None) is None


def test_grades_of_empty_text(spark):
    zero, grades = F.lit(0).cast("bigint"), {}
    row = spark.range(1).select(
        readability.fk_grade(zero, zero, zero).alias("fk"), readability.ari_grade(zero, zero, zero).alias("ari")
    ).first()
    assert row.fk == pytest.approx(0.39 + 11.8 - 15.59)
    assert row.ari == pytest.approx(0.5 - 21.43)


@pytest.mark.parametrize(
    "query",
    [
        dataset.ift_pairs_blog,
        dataset.ift_pairs_code,
        dataset.documented_functions,
        dataset.extract_docstring,
        dataset.clean_text_query,
        dataset.html_article,
        dataset.html_article_nested,
        scoring.text_metrics,
    ],
)
def test_native_plans_have_no_python(spark, query):
    plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_scan_reads_only_the_columns_used(spark):
    plan = dataset.ift_pairs_blog(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan

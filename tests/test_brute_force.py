"""Native expressions against plain Python on random texts, and UDFs outside this package."""

import random
import re
import subprocess
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pairloom.functions import html, readability, text
from pairloom.functions.hashing import stable_hash
from pairloom.operators import infer
from pairloom.functions.payload import GenParams
from pairloom.sources.tables import from_rows

ALPHABET = ['"""', '"', "\n", "\t", "\r", " ", " ", ".", "!", "?", ",", "\\'", "a", "E", "y", "b", "é", "日", " "]


@pytest.fixture(scope="module")
def strings():
    rng = random.Random(5)
    return ["".join(rng.choices(ALPHABET, k=rng.randrange(40))) for _ in range(3000)]


def test_text_functions(spark, strings):
    a = F.col("a")
    df = from_rows(spark, [(s,) for s in strings], "a string").select(
        a,
        readability.token_count(a).alias("tokens"),
        readability.sentence_count(a).alias("sentences"),
        readability.syllable_count(a).alias("syllables"),
        F.length(F.array_join(readability.tokens(a), "")).alias("characters"),
        text.before_delimiter(a).alias("before"),
        text.between_delimiters(a).alias("between"),
        text.clean_text(a).alias("clean"),
    )
    for r in df.collect():
        words = re.findall(r"[^ \n\t\r]+", r.a)
        assert r.tokens == len(words)
        assert r.characters == sum(map(len, words))
        assert r.sentences == len(re.findall(r"[.!?]+", r.a))
        assert r.syllables == len(re.findall(r"[aeiouy]+", r.a, re.I | re.A))
        assert r.before == r.a.split('"""')[0]
        assert r.between == (r.a.split('"""') + [None])[1]
        assert r.clean == r.a.replace("\\'", "'").replace(" ,", ",").replace(" .", ".")


def test_stable_hash(spark, strings):
    import hashlib

    df = from_rows(spark, list(enumerate(strings)), "i int, a string")
    df = df.select("i", "a", stable_hash(7, [F.col("i"), F.col("a")], digits=15).alias("h"))
    for r in df.collect():
        assert r.h == int(hashlib.md5(f"7|{r.i}|{r.a}".encode()).hexdigest()[:15], 16)


def test_page_readers_agree(spark):
    """Random flat pages of tags, comments, scripts, entities and text."""
    rng = random.Random(8)
    bits = [
        "<p>", "</p>", "<br/>", '<a href="/x">', "</a>", "<!-- no > -->", "<script>n('<p>')</script>",
        "<style>n{}</style>", "&amp;", "&lt;", "&copy; ", "&quot;", "&nbsp;", " ", "\n", "word", " , ", " . ", "é",
    ]
    pages = [
        "<body>out<article>" + "".join(rng.choices(bits, k=rng.randrange(30))) + "</article>out</body>"
        for _ in range(2000)
    ]
    df = from_rows(spark, [(p,) for p in pages], "a string")
    df = df.select("a", html.pattern_text(F.col("a")).alias("n"), html.parsed_text(F.col("a")).alias("p"))
    for r in df.collect():
        assert r.n == r.p, r.a


def test_nested_page_readers_agree(spark):
    """Random pages whose containers lie in each other, balanced or not."""
    rng = random.Random(9)
    bits = ["<article>", "</article>", '<article class="x">', "</article >", "<p>", "</p>", "<!-- </article> -->", "word", " , ", "é", "&amp;"]
    pages = ["<body>out" + "".join(rng.choices(bits, k=rng.randrange(30))) + "</body>" for _ in range(2000)]
    df = from_rows(spark, [(p,) for p in pages], "a string")
    df = df.select("a", html.nested_text(F.col("a")).alias("n"), html.parsed_text(F.col("a")).alias("p"))
    for r in df.collect():
        assert r.n == r.p, r.a


def test_udfs_need_no_package_on_the_workers(tmp_path):
    """What a UDF refers to travels with it: it loads and runs where pairloom is not installed."""
    score = infer.make_batch_udf(infer.lead_scorer(), GenParams(max_tokens=2)).func
    (tmp_path / "udf.pickle").write_bytes(cloudpickle.dumps(score))
    program = (
        "import pickle, sys, pandas as pd\n"
        "score = pickle.load(open('udf.pickle', 'rb'))\n"
        "print(next(score(iter([pd.Series(['a b c'])]))).text[0])\n"
        "assert not any(m.startswith('pairloom') for m in sys.modules)\n"
    )
    done = subprocess.run(
        [sys.executable, "-I", "-c", program], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    assert done.stdout.strip() == "a b"
    assert next(score(iter([pd.Series(["a b c", None])]))).text.tolist() == ["a b", None]

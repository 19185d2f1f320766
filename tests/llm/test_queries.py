"""The registered queries and the pipeline on the given tables."""

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_operators import brute_components, brute_hits, brute_licenses
from tokenizers import Tokenizer

import corpus_pipeline
from pairloom.llm import license_scan, pu_quality, secret_scan
from pairloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def items(spark):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]


def test_every_operator_is_registered():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))


def test_packing(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = defaultdict(dict)
    filled = defaultdict(int)
    for r in QUERIES["op2_packing"](spark, SF_DIR).collect():
        found[r.doc_id][r.start] = r
        filled[r.sequence_id] += r.length
    assert set(found) == set(texts)
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for start in sorted(found[i]):
            r = found[i][start]
            assert start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids) == r.doc_tokens
    assert all(n <= 2048 and n & (n - 1) == 0 for n in filled.values())


def test_licenses(spark, texts):
    wanted = defaultdict(list)
    for i, text in texts.items():
        for name, start, end, held in brute_licenses(text, license_scan.TEMPLATES):
            wanted[i, name].append((start, held))
    found = QUERIES["op4_license_scan"](spark, SF_DIR).collect()
    got = {(r.doc_id, r.license): (r.n_matches, r.first_word, r.containment) for r in found}
    assert got == {k: (len(v), min(s for s, _ in v), max(h for _, h in v)) for k, v in wanted.items()} != {}


BASE = [
    ("assign", re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def test_secrets(spark, texts):
    import hashlib

    kinds = [k for k, _, _ in BASE]
    for r in QUERIES["op6_secret_scan"](spark, SF_DIR).collect():
        spans = [(m.start(), kinds.index(k), m.end()) for k, p, ok in BASE for m in p.finditer(texts[r.doc_id]) if ok(m)]
        joined = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in spans) for i in range(3))
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_token_ids(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    for r in sorted(QUERIES["op9_token_id_output"](spark, SF_DIR).collect(), key=lambda r: r.doc_id):
        ids = np.array([*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 1], dtype="<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_quality_columns(spark, texts):
    rows = QUERIES["op10_quality_classifier"](spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.7)


def test_pipeline_equals_brute_force(spark, texts, items):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    good = pu_quality.score_quality(docs, labels).where(F.col("score") >= 0.7).select("row.doc_id").collect()
    rows = [(r.doc_id, texts[r.doc_id]) for r in good]
    rows = _representatives(rows)
    hits = brute_hits(rows, items)
    rows = [(i, t) for i, t in rows if not (hits[i][1] and 20 * hits[i][1] >= hits[i][0])]
    left = spark.createDataFrame(rows, "doc_id long, text string")
    shares = secret_scan.corpus_shares(left)
    least = secret_scan.threshold(left, shares)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = {}
    for i, text in rows:
        parts, at = [], 0
        for s in secret_scan.spans_of(text, shares, least):
            if s["end"] > at:
                parts += [text[at : s["start"]], "[secret]"] if s["start"] >= at else []
                at = s["end"]
        ids = tokenizer.encode("".join([*parts, text[at:]]), add_special_tokens=False).ids
        wanted[i] = np.array([*ids, 1], dtype="<u4")
    found = defaultdict(dict)
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        found[r.doc_id][r.start] = r
    assert set(found) == set(wanted) and 0 < len(found) < len(texts)
    for i, ids in wanted.items():
        at = 0
        for start in sorted(found[i]):
            r = found[i][start]
            assert start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def _representatives(rows):
    found = brute_components(rows, 5, 80)  # as the stage, not as op7
    return [(i, t) for i, t in rows if found[i][1] == i]


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40).withColumn("score", F.lit("x")).withColumn("row", F.lit(1))
    docs = docs.union(docs.limit(1).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string")}))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert out.where("row = 1 AND score = 'x'").count() == out.count() > 0
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0

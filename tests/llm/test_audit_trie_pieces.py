"""Filter audit, prefix trie and sentencepiece codec against brute force and the library."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from pairloom.llm import filter_audit, prefix_trie, sentencepiece_codec, tree_totals
from pairloom.llm.piece_model import PieceModel
from pairloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Filter audit


def brute_masks(rows):
    first = {}
    for doc_id, _, text in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    out = []
    for doc_id, part, text in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = [
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text)),
            doc_id is not None and first[text] < doc_id,
        ]
        out.append((doc_id, part or "", {f for f, b in zip("ABCDE", fails) if b}))
    return out


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    masks = brute_masks(rows)
    out = {}
    for part in {p for _, p, _ in masks}:
        own = [(i, m) for i, p, m in masks if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [(i, m) for i, m in left if f in m]
                left = [(i, m) for i, m in left if f not in m]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in m for _, m in own) - len(gone), sum(m == {f} for _, m in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


@pytest.fixture(scope="module")
def odd_docs():
    rnd = random.Random(3)
    words = ["alpha", "Beta", "GAMMA", "é", "été", "x|y", "50%", "ﬁn", "z"]
    long = " ".join(f"w{k}" for k in range(250))
    rows = [(None, "en", long), (None, None, "lone"), (7, "en", None), (8, "en", ""), (8, "en", ""), (3, "", long), (9, None, long), (9, "de", long)]
    rows += [(100 + k, "hot", long + "!") for k in range(60)]
    rows += [(k + 200, rnd.choice(["en", "de", None]), rnd.choice([" ", " ", "\n", "\x1f "]).join(rnd.choices(words, k=rnd.choice([0, 1, 5, 199, 200, 230, 400])))) for k in range(60)]
    return rows


def frame(spark, rows, schema, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


DOCS = "doc_id long, lang string, text string"
LABELS = "doc_id long, quality int, toxic int"


def test_audit_equals_brute_force(spark, odd_docs):
    labels = [(3, 1, 0), (9, 1, 1), (9, 0, None), (7, None, 1), (101, 1, 0), (205, 1, 1), (None, 1, 1), (99999, 1, 1)]
    docs = frame(spark, odd_docs, DOCS).withColumns({c: F.lit(1) for c in ("mask", "code", "part", "n", "row")})
    found = {
        (r.part, r.filter_order, r.step): list(r)[3:]
        for r in filter_audit.audit(docs, frame(spark, labels, LABELS).withColumn("mask", F.lit(2))).collect()
    }
    assert found == brute_audit(odd_docs, labels) and len(found) == 600 * 4


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_texts_of_one_code_are_told_apart(spark, odd_docs, bits):
    flags = filter_audit.failed_filters(frame(spark, odd_docs, DOCS), bits=bits).collect()
    wanted = [(i, p, sum(1 << "ABCDE".index(f) for f in m)) for i, p, m in brute_masks(odd_docs)]
    assert sorted(map(tuple, flags), key=repr) == sorted(wanted, key=repr)


def test_empty_tables(spark, odd_docs):
    docs, labels = frame(spark, odd_docs, DOCS), frame(spark, [(3, 1, 0)], LABELS)
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    plain = filter_audit.audit(docs, labels.limit(0))
    assert plain.count() == 2400 and plain.agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def test_the_sketch_clears_unique_texts_only(spark):
    # Blocks are many here, and one code stands in a third of all rows.
    rnd = np.random.default_rng(1)
    codes = rnd.integers(-(2**63), 2**63 - 1, 200_000)
    rows = np.concatenate([codes, codes[:500], np.full(100_000, codes[700])])
    rnd.shuffle(rows)
    df = spark.createDataFrame([(int(c),) for c in rows], "code long").repartition(7)
    found = {r.code for r in filter_audit.possible_repeats(df, len(rows)).collect()}
    repeated = {*map(int, codes[:500]), int(codes[700])}
    assert repeated <= found <= set(map(int, codes))
    assert len(found - repeated) < 0.01 * len(codes)


# Prefix trie


def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))

    def digest(t):
        return hashlib.md5(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest()

    own = {c: [t[2:] for t in sorted(v, key=lambda t: (*t[:2], digest(t)))] for c, v in turns.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - int(np.fmod(c, 20)), [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        words = len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * words
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p)).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def trie_rows(spark, rows):
    df = frame(spark, rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("depth", "node", "place", "digest")})
    found = prefix_trie.prefix_trie(df).collect()
    return sorted(tuple(-1 if v is None and k == "parent_conv_id" else v for k, v in r.asDict().items()) for r in found)


def test_trie_equals_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for conv in [*range(-25, 70), 1000, 10**12 + 7]:
        if conv in (20, 40):
            continue  # conversations that others take turns from are absent
        kind = rnd.random()
        for turn in range(rnd.randint(1, 6)):
            text = rnd.choice(["a b", "c", "", None, "d e f"]) if kind < 0.7 else f"own {conv} {turn}"
            rows.append((conv, rnd.choice([turn, turn, turn, None]), rnd.choice(["user", "user", None, ""]), text))
    rows += [(0, 1, "user", "a b")] * 3 + [(None, 1, "user", "a"), (None, None, None, None)]
    found, wanted = trie_rows(spark, rows), brute_trie(rows)
    assert found == wanted and any(r[4] > 2 and r[5] > 3 for r in wanted)


def test_long_conversations(spark):
    # Two that part late, one that stops early and a third of all turns at one turn number.
    rows = [(c, t, "u", f"t{t}" if t < 500 else f"{c} {t}") for c in (20, 40, 60) for t in range({20: 700, 40: 610, 60: 300}[c])]
    rows += [(80, None, "u", f"n {k % 7}") for k in range(800)]
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_no_conversations(spark):
    assert trie_rows(spark, [(1, 1, "u", "x")][:0] + [(None, 1, "u", "x")]) == []


@pytest.mark.parametrize("shape", ["path", "star", "caterpillar", "random", "forest", "binary"])
def test_subtree_totals(spark, shape):
    rnd, n = random.Random(2), 120
    above = {
        "path": lambda k: k - 1, "star": lambda k: 0, "caterpillar": lambda k: k - 1 if k % 2 else max(0, k - 2),
        "random": lambda k: rnd.randrange(k), "forest": lambda k: None if k % 17 == 0 else k - rnd.randint(1, k % 17), "binary": lambda k: (k - 1) // 2,
    }[shape]
    parent = {0: None, **{k: above(k) for k in range(1, n)}}
    value = {k: rnd.choice([None, rnd.randint(-5, 50)]) for k in range(n)}
    wanted = defaultdict(lambda: [0, 0])
    for k in range(n):
        at = k
        while at is not None:
            wanted[at][0] += value[k] or 0
            wanted[at][1] += 1
            at = parent[at]
    df = frame(spark, [(k, parent[k], value[k], 1) for k in range(n)], "node long, parent long, v long, one long")
    found = {r.node: [r.v, r.one] for r in tree_totals.subtree_totals(df, ["v", "one"]).collect()}
    assert found == dict(wanted)


# SentencePiece


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def model():
    return PieceModel(MODEL)


def ids_of(model, texts):
    return [np.frombuffer(m, "<i4").tolist() for m in model.encode(texts)]


ATOMS = [*" \n\t\rab0_▁é中文{},;\"'.²½५", "  ", "   ", "é", "\U0001f600", "￿", "\x00", "ﬁ", "\r\n", "the", "ing", "é²", "ि", "<s>", "<0x41>"]


def test_ids_equal_the_library(model, library):
    rnd = random.Random(9)
    pieces = list(model.id_of)
    texts = ["", " ", "▁", "\n"]
    for _ in range(3000):
        texts.append("".join(rnd.choices(ATOMS, k=rnd.randint(0, 30))))
        texts.append("".join(rnd.choices(pieces, k=rnd.randint(1, 12))))
        texts.append("".join(rnd.choices("aaaabeirst  nozlh", k=rnd.randint(0, 60))))
        texts.append("".join(chr(rnd.choice([rnd.randrange(128), rnd.randrange(0xD800), rnd.randrange(0xE000, 0x110000)])) for _ in range(12)))
    assert ids_of(model, texts) == library.encode(texts)


def test_runs_and_very_long_units(model, library):
    texts = [a + " " * n + b for n in (*range(1, 50), 999, 5000) for a in ("", "a") for b in ("", "b", "\n", "\U0001f600")]
    texts += [unit * 40_000 for unit in ("a", "ab", "=", "-_", "中", "é", "0", "aB3x")]
    assert ids_of(model, texts) == library.encode(texts)


def test_a_full_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr("pairloom.llm.piece_model.UNITS", 20)
    monkeypatch.setattr("pairloom.llm.piece_model.PAIRS", 10)
    monkeypatch.setattr("pairloom.llm.piece_model.RUN_CHARS", 50)
    monkeypatch.setattr("pairloom.llm.piece_model.UNIT_CHARS", 6)
    small, rnd = PieceModel(MODEL), random.Random(4)
    texts = ["".join(rnd.choices(ATOMS, k=40)) for _ in range(300)]
    assert ids_of(small, texts) == library.encode(texts)


def test_decoding_equals_the_library(model, library):
    rnd = random.Random(8)
    draws = [lambda: rnd.randrange(3), lambda: rnd.randint(3, 258), lambda: rnd.randrange(32000), lambda: 28705, lambda: 259]
    for _ in range(5000):
        ids = [rnd.choice(draws)() for _ in range(rnd.randint(0, 9))]
        assert model.decode(ids) == library.decode(ids), ids


def test_codec_rows(spark, documents, library):
    texts = [(1, "Hello  world"), (1, "Hello  world"), (None, "x"), (2, None), (3, ""), (4, "é\n" * 3000)]
    found = sentencepiece_codec.round_trip(documents(texts), MODEL).collect()
    assert sorted(((r.row.doc_id, r.row.text, r.ids, r.decoded) for r in found), key=repr) == sorted(
        ((i, t, library.encode(t or ""), t or "") for i, t in texts), key=repr
    )
    coded = sentencepiece_codec.encode(documents(texts), MODEL, ["doc_id"])
    back = sentencepiece_codec.decode(coded, MODEL).collect()
    assert sorted(((r.row.row.doc_id, r.decoded) for r in back), key=repr) == sorted(((i, t or "") for i, t in texts), key=repr)
    assert sentencepiece_codec.round_trip(documents(texts).limit(0), MODEL).count() == 0
    odd = spark.createDataFrame([(None,), ([],), ([264, None, 287],)], "ids array<int>")
    assert sorted(r.decoded for r in sentencepiece_codec.decode(odd, MODEL).collect()) == ["", "", "a b"]


def test_registered_codec(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    wanted = set()
    for r in docs.collect():
        ids = library.encode(r.text)
        wanted.add((r.doc_id, len(ids), *(hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), library.decode(ids)))))
    assert {tuple(r) for r in QUERIES["op13_sentencepiece"](spark, SF_DIR).collect()} == wanted

"""Words, tokens and small numeric cores against plain Python."""

import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pairloom.llm import fm_index, grammar_store, packing, text_words, token_ids

PATTERNS = [
    (text_words.SPACED, re.compile("[^\x20\x09-\x0d]+"), False),
    (text_words.SPACED_LOWER, re.compile("[^\x20\x09-\x0d]+"), True),
    (text_words.LETTERS_LOWER, re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"), True),
]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALPHABET = list("aAzZ09 \t\n\x0b\x0c\r\x00\x1c\x1f.,'-_é  日ſİß\U0001f600") + ["don't", "<|endoftext|>", " '", "é", "²"]


def texts(n, size, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randrange(size))) for _ in range(n)]


@pytest.mark.parametrize("alphabet, pattern, lower", PATTERNS)
@pytest.mark.parametrize("chunk", [7, 1 << 20])
def test_words_equal_those_of_the_pattern(alphabet, pattern, lower, chunk, monkeypatch):
    monkeypatch.setattr(text_words, "CHUNK", chunk)
    held = [*texts(200, 60, 1), "", "x" * 100, None]
    words = text_words.words_of([t if t is None else t.encode() for t in held], alphabet)
    wanted = [pattern.findall((t or "").translate(LOWER) if lower else t or "") for t in held]
    found = [[] for _ in held]
    for d, s, e in zip(words.doc, words.start, words.end):
        found[d].append(words.data[s:e].decode())
    assert found == wanted
    assert words.first.tolist() == np.cumsum([0, *map(len, wanted)]).tolist()
    codes = {}
    for word, code in zip((w for own in wanted for w in own), words.hash.tolist()):
        assert codes.setdefault(word, code) == code
    assert len(set(codes.values())) == len(codes)


def test_ngrams_stay_inside_documents():
    words = text_words.words_of([b"a b c", b"", b"a b", b"b c"], text_words.SPACED)
    at, code = text_words.ngrams(words, 2)
    assert at.tolist() == [0, 1, 3, 5]
    assert code[0] == code[2] and code[1] == code[3] and code[0] != code[1]
    assert len(text_words.ngrams(words, 9)[0]) == 0


@pytest.mark.parametrize("name, make", [("byte_bpe_50k.json", token_ids.byte_bpe), ("word_bpe_49k.json", token_ids.word_bpe)])
def test_pieces_give_the_ids_of_whole_texts(name, make):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    held = [*texts(3000, 40, 2), "", "Ünï cödé ΑΣ. ΣΑΣ, Å Å İ.", "x  y\n\n z ", "a$$$ b,c!d (e) f_g 12.5 x²."]
    end = np.array([1], dtype="<u4").tobytes()
    for text, ids in zip([*held, None], make(path).encode([*held, None], end)):
        wanted = plain.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == [*wanted, 1], text


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_ids, "CACHE", 3)
    monkeypatch.setattr(token_ids, "RUN_CHARS", 10)
    path = public_tokenizers.path("word_bpe_49k.json")
    small = token_ids.WordEncoder(path)
    held = ["one two three four", "five six", "one two", "seven eight nine"] * 3
    assert list(small.encode(held, b"")) == list(token_ids.word_bpe(path).encode(held, b""))


@pytest.mark.parametrize("name, make", [("byte_bpe_50k.json", token_ids.byte_bpe), ("word_bpe_49k.json", token_ids.word_bpe)])
def test_ids_of_every_code_point_and_token(name, make):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    ranges = [(0, 0x3400), (0xA000, 0xAC00), (0xF900, 0x13000), (0x1D000, 0x1FB00)]
    points = [chr(c) for low, high in ranges for c in range(low, high)]
    held = ["".join(f"a{c}b 1{c}2 {c}.{c}, {c} {c}{c}x  {c} \n" for c in points[k : k + 64]) for k in range(0, len(points), 64)]
    held += [plain.decode([i]) for i in range(plain.get_vocab_size())]
    held += [f"x {t} {t}{t} 's{t}" for t in held[-plain.get_vocab_size() :]]
    wanted = [e.ids for e in plain.encode_batch(held, add_special_tokens=False)]
    assert make(path).merges is not None
    for text, ids, own in zip(held, make(path).encode(held, b""), wanted):
        assert np.frombuffer(ids, dtype="<u4").tolist() == own, text


@pytest.mark.parametrize("make, name", [(token_ids.byte_bpe, "byte_bpe_50k.json"), (token_ids.word_bpe, "word_bpe_49k.json")])
def test_ids_of_very_long_runs(make, name):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    letters = "".join(random.Random(3).choices("abcdefghij", k=300_000))
    held = [" " * 1_000_000 + "x", "a" + "\n" * 1_000_000, letters, "!" * 300_000, "\t " * 60_000 + "end"]
    for text, ids in zip(held, make(path).encode(held, b"")):
        assert np.frombuffer(ids, dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_files_whose_ids_do_not_order_the_merges_go_to_the_library(tmp_path):
    """Two ids exchanged: ranks cannot be read from the file, the ids still are its own."""
    import json

    made = json.load(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))
    vocab = made["model"]["vocab"]
    (a, i), (b, j) = [(t, k) for t, k in vocab.items() if k in (400, 900)]
    vocab[a], vocab[b] = j, i
    path = str(tmp_path / "exchanged.json")
    json.dump(made, open(path, "w", encoding="utf-8"))
    encode = token_ids.ByteEncoder(path)
    assert encode.merges is None
    plain = Tokenizer.from_file(path)
    for text, ids in zip(PROSE, encode.encode(PROSE, b"")):
        assert np.frombuffer(ids, dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


PROSE = ["the quick brown fox said: don't, 12.5 times!", "", "Ünï cödé  and   spaces\n\n"]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(1, 4), max_size=30), min_size=1, max_size=8), st.lists(st.lists(st.integers(1, 5), min_size=1, max_size=4), min_size=1, max_size=20))
def test_fm_index_finds_every_occurrence(docs, phrases):
    symbols = np.array([s for d in docs for s in [*d, 0]], dtype=np.int64)
    order = fm_index.suffix_array(symbols)
    assert sorted(order.tolist()) == list(range(len(symbols)))
    index = fm_index.FMIndex(symbols, sample=3)
    matrix = np.zeros((len(phrases), 4), dtype=np.int64)
    for k, p in enumerate(phrases):
        matrix[k, : len(p)] = [s if s <= symbols.max() else -1 for s in p]
    low, high = index.search(matrix, np.array([len(p) for p in phrases]))
    text = symbols.tolist()
    for p, a, b in zip(phrases, low, high):
        found = sorted(index.locate(np.arange(a, b)).tolist())
        assert found == [i for i in range(len(text)) if text[i : i + len(p)] == p]


def test_suffix_array_of_many_copies():
    """Copies of one long document tie to their ends."""
    one = [*np.random.default_rng(1).integers(1, 50, 500).tolist(), 0]
    symbols = np.array(one * 40, dtype=np.int64)
    order = fm_index.suffix_array(symbols)
    assert (symbols[order] == np.sort(symbols)).all()
    # Ties end at the separators, which are ordered by place.
    assert [i // 501 for i in order.tolist() if i % 501 == 17] == list(range(40))


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(0, 5), min_size=1, max_size=80), max_size=6))
def test_grammar_round_trip_and_random_access(docs):
    ids = np.array([i for d in docs for i in d], dtype="<u4")
    ends = np.zeros(len(ids), dtype=bool)
    ends[np.cumsum([len(d) for d in docs], dtype=np.int64) - 1] = True
    if not len(ids):
        return
    terminals, rounds, rules, lengths, sequence = grammar_store.compress(ids, ends)
    assert grammar_store.expand(terminals, rounds, rules, sequence).tolist() == ids.tolist()
    assert grammar_store.expand_all(terminals, rounds, rules, lengths, sequence).tolist() == ids.tolist()
    shard = {
        "terminals": terminals, "n_ids": len(ids), "rounds": rounds.astype("<i8").tobytes(),
        "rules": rules.astype("<i4").tobytes(), "lengths": lengths.astype("<i4").tobytes(),
        "sequence": sequence.astype("<i4").tobytes(),
    }
    for start in range(0, len(ids), 7):
        assert grammar_store.read_range(shard, start, 11).tolist() == ids[start : start + 11].tolist()
    assert grammar_store.read_range(shard, len(ids), 5).tolist() == []


def test_grammar_shrinks_repetition_and_keeps_documents_apart():
    ids = np.array([7, 8, 9, 1] * 1000, dtype="<u4")
    ends = ids == 1
    terminals, rounds, rules, lengths, sequence = grammar_store.compress(ids, ends)
    assert len(sequence) == 1000 and len(set(sequence.tolist())) == 1
    assert lengths[sequence[0] - terminals] == 4


def test_grammar_goes_on_until_no_pair_pays():
    """Copies shrink to a symbol each, however long they are; what is left holds no frequent pair."""
    rng = np.random.default_rng(2)
    ids = np.append(np.tile(rng.integers(2, 40_000, 1000), 200), rng.integers(2, 300, 20_000)).astype("<u4")
    ends = np.arange(1, len(ids) + 1) % 1000 == 0
    terminals, rounds, rules, lengths, sequence = grammar_store.compress(ids, ends)
    assert len(set(sequence[:200].tolist())) == 1 and lengths.max() == 1000
    last = np.flatnonzero(np.cumsum(np.append(1, lengths)[np.maximum(sequence - terminals + 1, 0)]) % 1000 == 0)
    inside = np.setdiff1d(np.arange(len(sequence) - 1), last)
    pairs = np.unique(np.stack([sequence[inside], sequence[inside + 1]]), axis=1, return_counts=True)[1]
    # A pair of one symbol may overlap itself and count more often than it can be replaced.
    assert pairs.max() < grammar_store.LEAST
    assert grammar_store.expand_all(terminals, rounds, rules, lengths, sequence).tolist() == ids.tolist()


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3)])
def test_hilbert_keys_visit_neighbours(dimensions, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), axis=-1).reshape(-1, dimensions)
    keys = packing.hilbert_keys(grid, bits)
    assert sorted(keys.tolist()) == list(range(len(grid)))
    steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)
    assert steps.max() == 1


def test_tails_are_sums_of_powers_of_two():
    for n in range(2048):
        sizes = packing.tail_lengths(n)
        assert sum(sizes) == n and all(math.log2(s).is_integer() for s in sizes)

"""Token ids of whole texts from public tokenizer files.

The ids are those of the tokenizers library. Its byte-pair merges run here in tiktoken, from
ranks read out of the same file, wherever both must agree; other texts and files go to the
library itself. Ids come as little-endian unsigned 32-bit bytes.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np

#: Runs and characters held per worker; as many again may wait in the older half of the cache.
CACHE, CACHE_CHARS = 600_000, 1 << 24
#: Characters of text cut at a time.
RUN_CHARS = 1 << 20

#: Texts with these are left to the library: marks of special tokens, a letter whose lower case
#: ends in a combining mark, control characters that are white space to Python only, and (for
#: words) letters that the library composes or takes apart, as a mark may then end a word.
_MARK = "<|"
_WHOLE = re.compile(r"[\x1c-\x1fİ]")
#: White space beyond what tiktoken's search for its end can step back over.
LONG_SPACE = 100_000
_LONG_SPACE = re.compile(rf"\s{{{LONG_SPACE}}}")
#: Beyond these letters a text is left as it is, and the tokenizer lower-cases it.
_LATIN = re.compile(r"[\x00-ɏ]*")

# The pieces that the byte-level format merges by themselves, and its word end.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_END = "</w>"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ɏ]+|[0-9]|[^a-zÀ-ÖØ-öø-ɏ0-9\n]+"

#: The pattern above is that of the file for runs without these; one run per line.
_ODD = re.compile(r"[^!-@\[-~À-ÖØ-öø-ɏ\n]")
_WORDS = re.compile(WORD_LEVEL + r"|\n")


def _bytes_shown() -> dict[str, int]:
    """The byte for each character of a byte-level vocabulary: its own, or one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(0x100)) - set(shown))
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def ranks_of(made: dict) -> dict[bytes, int] | None:
    """Bytes of each token of a tokenizer file with its id, a word end being a space.

    None unless the ids also give the order of the merges, single symbols first, and no two
    tokens have the same bytes.
    """
    model, added = made["model"], {t["content"] for t in made["added_tokens"]}
    vocab = {t: i for t, i in model["vocab"].items() if t not in added}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = [vocab[a + b] for a, b in pairs]
    single = set(vocab.values()).difference(merged)
    in_order = all(a < b for a, b in zip([max(single, default=-1), *merged], merged))
    shown = _bytes_shown()
    suffix = model["end_of_word_suffix"]
    ranks = {}
    for token, i in vocab.items():
        ends = bool(suffix) and token.endswith(suffix)
        symbols = token[: -len(suffix)] if ends else token
        if not all(s in shown for s in symbols):
            return None
        ranks[bytes(shown[s] for s in symbols) + b" " * ends] = i
    return ranks if in_order and len(ranks) == len(vocab) else None


class _Library:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.made = json.load(file)

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _merges(self, pattern: str):
        """tiktoken's merges over the file's ranks, or None where these cannot be read so."""
        import tiktoken

        ranks = ranks_of(self.made)
        return ranks and tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class ByteEncoder(_Library):
    """Byte-level merges of whole texts; nothing is held between texts."""

    def __init__(self, path: str):
        super().__init__(path)
        cut = self.made["pre_tokenizer"] or {}
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        plain = plain and not self.made["normalizer"] and not self.made["model"]["end_of_word_suffix"]
        self.merges = self._merges(BYTE_LEVEL) if plain else None

    def encode(self, texts: list[str | None], end: bytes) -> Iterator[bytes]:
        """The ids of each text (null: none), with ``end`` after them."""
        for text in texts:
            text = text or ""
            long_space = len(text) >= LONG_SPACE and _LONG_SPACE.search(text)
            if self.merges is None or _MARK in text or long_space:
                yield self._ids([text])[0] + end
            else:
                yield self.merges.encode_to_numpy(text).astype("<u4").tobytes() + end


class WordEncoder(_Library):
    """Lower-cased words with word ends, and a cache over runs without white space.

    White space is dropped and each run is encoded by itself, so a run seen before costs one
    look-up. New runs of plain letters, digits and marks are cut into words and merged in one
    go; each word's ids stop at its word end.
    """

    def __init__(self, path: str):
        super().__init__(path)
        plain = self.made["model"]["end_of_word_suffix"] == WORD_END
        self.merges = self._merges("[^ ]+ ") if plain else None
        #: A line's end between runs is merged with its word end, as no other word is.
        self.line = self.merges and self.merges.encode_single_token(b"\n ")
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.chars = 0

    def _plain(self, runs: list[str]) -> list[bytes]:
        words = " ".join(_WORDS.findall("\n".join(runs)))
        ids = self.merges.encode_to_numpy(words + " \n ").astype("<u4")
        breaks = 4 * np.flatnonzero(ids == self.line)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *(breaks + 4).tolist()], breaks.tolist())]

    def _learn(self, runs: set[str]) -> None:
        runs = runs.difference(self.new)
        if self.old:
            known = {run: self.old[run] for run in runs.intersection(self.old)}
            self.new.update(known)
            runs = runs.difference(known)
        plain, others = list(runs), []
        lines = "\n".join(plain)
        self.chars += len(lines)
        if self.merges is None:
            plain, others = [], plain
        elif _ODD.search(lines) or lines != lines.lower():
            others = [run for run in plain if _ODD.search(run) or run != run.lower()]
            plain = list(runs.difference(others))
        if plain:
            self.new.update(zip(plain, self._plain(plain), strict=True))
        self.new.update(zip(others, self._ids(others)))

    def encode(self, texts: list[str | None], end: bytes) -> Iterator[bytes]:
        """The ids of each text (null: none), with ``end`` after them."""
        at = 0
        while at < len(texts):
            size, to = 0, at
            while to < len(texts) and size < RUN_CHARS:
                size += len(texts[to] or "")
                to += 1
            cut: list[list[str] | None] = []
            for text in texts[at:to]:
                text = text or ""
                if _MARK in text or _WHOLE.search(text) or not is_normalized("NFC", text):
                    cut.append(None)
                else:
                    # Lower-casing Latin texts here saves look-ups.
                    cut.append((text.lower() if _LATIN.fullmatch(text) else text).split())
            if len(self.new) > CACHE or self.chars > CACHE_CHARS:
                self.old, self.new, self.chars = self.new, {}, 0
            self._learn(set().union(*filter(None, cut)))
            known = self.new.__getitem__
            for text, runs in zip(texts[at:to], cut):
                ids = self._ids([text])[0] if runs is None else b"".join(map(known, runs))
                yield ids + end
            at = to


@lru_cache(maxsize=None)
def byte_bpe(path: str) -> ByteEncoder:
    """One encoder per worker process and file."""
    return ByteEncoder(path)


@lru_cache(maxsize=None)
def word_bpe(path: str) -> WordEncoder:
    return WordEncoder(path)

"""Byte-pair pieces of a sentencepiece model file, by a table of each prefix's last token.

The encoding of a text ends in one token only, and without that token the rest is the encoding
of a shorter prefix. So a table of the last token of every prefix holds the whole encoding: of
the pieces that end at a character (found by an automaton) just one may follow the last token
of the prefix before it, and the ids are read from the end back.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter

import ahocorasick
import numpy as np

#: Stands for a space inside pieces (fixed value of the format).
SPACE = "▁"
#: What the decoder gives for the unknown piece (fixed value of the format).
UNKNOWN_SURFACE = " ⁇ "
#: Letters, without digits and other numerals of Latin text.
LETTER = r"[^\W\d_²³¹¼-¾]"
#: Kinds of pieces (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

#: Characters of text looked up at a time; units held per worker, as many again in the older half
#: of the cache; longer units are not held; compared pairs of tokens held.
RUN_CHARS = 1 << 20
UNITS = 500_000
UNIT_CHARS = 64
PAIRS = 1_000_000
#: Marks a character that no piece holds.
_OUTSIDE = -1


class PieceModel:
    """Encoder and decoder of one model file: byte-pair merges, byte fallback, no normalisation.

    Raises ValueError for other kinds of models: unigram ones, those with a normalisation rule,
    user-defined or unused pieces, and equal scores other than those of runs of spaces.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if (
            model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback
            or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix
            or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}
        ):
            raise ValueError(f"{path}: only byte-pair models with byte fallback and no normalisation are encoded")
        self.byte_ids = np.zeros(256, dtype=np.int32)
        self.piece_bytes: list[bytes] = []
        scores: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                code = int(p.piece[3:5], 16)
                self.byte_ids[code] = i
                self.piece_bytes.append(bytes([code]))
            elif p.type == NORMAL:
                self.id_of[p.piece] = i
                scores[p.piece] = p.score
                self.piece_bytes.append(p.piece.replace(SPACE, " ").encode())
            else:
                self.piece_bytes.append(UNKNOWN_SURFACE.encode() if p.type == UNKNOWN else b"")
        self._is_byte = np.zeros(len(model.pieces), dtype=bool)
        self._is_byte[self.byte_ids] = True
        self._starts_with_space = {i for t, i in self.id_of.items() if t.startswith(SPACE)}
        self._control = {i for i, p in enumerate(model.pieces) if p.type == CONTROL}
        self._prepare(scores)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self._runs: dict[int, bytes] = {}

    # Tables of the model.

    def _prepare(self, scores: dict[str, float]) -> None:
        merged = {t: s for t, s in scores.items() if len(t) > 1}
        self._space_scores = {t: s for t, s in merged.items() if set(t) == {SPACE}}
        words = {t: s for t, s in merged.items() if t not in self._space_scores}
        least = max(self._space_scores.values(), default=-np.inf)
        if (
            max(Counter(words.values()).values(), default=1) > 1
            or any(SPACE in t[1:] for t in words) or any(s <= least for s in words.values())
        ):
            raise ValueError("merges with equal scores, or pieces that go on after a space, are not encoded")
        #: Merges come in the order of ranks.
        self._rank = {t: n for n, t in enumerate(sorted(words, key=words.get, reverse=True))}
        held = set("".join(scores))
        self._text: list[str] = []
        self._left: list[int] = []
        self._right: list[int] = []
        self._order: list[int] = []
        token: dict[str, int] = {}
        for c in sorted(held):
            self._add(token, c, -1, -1, -1)
        for t, n in self._rank.items():
            parts, last = self._merge(list(t), self._rank)
            if len(parts) == 1:  # else no text ever gives this piece
                self._add(token, t, token[last[0]], token[last[1]], n)
        self._automaton = ahocorasick.Automaton()
        for t, k in token.items():
            self._automaton.add_word(t, (k, len(t)))
        self._automaton.make_automaton()
        self._ids = [
            np.array([self.id_of[t]] if t in self.id_of else self.byte_ids[list(t.encode())], dtype="<i4").tobytes()
            for t in self._text
        ]
        self._pairs: dict[int, bool] = {}
        self._cut = re.compile(self._cut_pattern(merged))

    @staticmethod
    def _cut_pattern(merged) -> str:
        """Units of a text that no merge joins: characters in no longer piece, and spaces with a word.

        Where no piece holds a letter beside another character than a space, words end with their
        letters.
        """
        inside = set("".join(merged))
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in inside and chr(c) != " ")
        one = f"[{alone}]|" if alone else ""
        other = f"(?!{LETTER})[^{SPACE}]"
        if any(map(re.compile(f"{LETTER}{other}|{other}{LETTER}").search, merged)):
            return f"{one}{SPACE}*[^{SPACE}{alone}]+|{SPACE}+"
        return f"{SPACE}*{LETTER}+|{one}{SPACE}*(?:(?!{LETTER})[^{SPACE}{alone}])+|{SPACE}+"

    def _add(self, token: dict[str, int], text: str, left: int, right: int, order: int) -> None:
        token[text] = len(self._text)
        self._text.append(text)
        self._left.append(left)
        self._right.append(right)
        self._order.append(order)

    @staticmethod
    def _merge(parts: list[str], rank: dict) -> tuple[list[str], tuple[str, str] | None]:
        """Plain merging of a few parts, the best pair first and of equal ones the leftmost."""
        last = None
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: (rank.get(parts[k] + parts[k + 1], np.inf), k))
            if parts[best] + parts[best + 1] not in rank:
                break
            last = parts[best], parts[best + 1]
            parts[best : best + 2] = ["".join(last)]
        return parts, last

    # Encoding.

    def _fits(self, one: int, two: int) -> bool:
        """Whether merging the text of both tokens gives just these two.

        Merges that made the tokens are undone from the latest on. If the parts that meet at the
        border could merge before the merge undone last, they would have; of equal merges the
        left one comes first.
        """
        text, order, rank = self._text, self._order, self._rank
        limit = len(rank)
        a, b, fits = one, two, True
        while True:
            joined = rank.get(text[a] + text[b])
            if joined is not None and joined < limit:
                fits = False
                break
            if order[a] > order[b]:
                limit, a = order[a], self._right[a]
            elif order[b] >= 0:
                limit, b = order[b] + 1, self._left[b]
            else:
                break
        if len(self._pairs) >= PAIRS:
            self._pairs.clear()
        self._pairs[one << 32 | two] = fits
        return fits

    def _word(self, word: str) -> bytes:
        """Ids of a word with one space before it at most."""
        last = [_OUTSIDE] * len(word)
        known, fits = self._pairs.get, self._fits
        for end, (token, n) in self._automaton.iter(word):
            if last[end] >= 0:
                continue
            if end >= n and (before := last[end - n]) >= 0:
                fit = known(before << 32 | token)
                if not (fits(before, token) if fit is None else fit):
                    continue
            last[end] = token
        out, at = [], len(word) - 1
        while at >= 0:
            token = last[at]
            if token >= 0:
                out.append(self._ids[token])
                at -= len(self._text[token])
            else:
                out.append(self.byte_ids[list(word[at].encode("utf-8", "replace"))].astype("<i4").tobytes())
                at -= 1
        return b"".join(reversed(out))

    def _spaces(self, n: int) -> bytes:
        """Ids of a run of spaces alone, whose merges have equal scores: the best, leftmost first."""
        if n not in self._runs:
            score, size = self._space_scores, [1] * n
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            heap = [(-score[SPACE * 2], k, 2) for k in range(n - 1)] if SPACE * 2 in score else []
            while heap:
                _, k, total = heapq.heappop(heap)
                to = after[k]
                if not size[k] or to >= n or size[k] + size[to] != total:
                    continue
                size[k], size[to], after[k] = total, 0, after[to]
                if after[k] < n:
                    before[after[k]] = k
                for left in (before[k], k):
                    if left >= 0 and after[left] < n:
                        both = SPACE * (size[left] + size[after[left]])
                        if both in score:
                            heapq.heappush(heap, (-score[both], left, len(both)))
            found = np.array([self.id_of[SPACE * s] for s in size if s], dtype="<i4").tobytes()
            if n > 1024:
                return found
            self._runs[n] = found
        return self._runs[n]

    def _unit(self, unit: str) -> bytes:
        word = unit.lstrip(SPACE)
        run = len(unit) - len(word)
        if not word:
            return self._spaces(run)
        if run < 2:
            return self._word(unit)
        # Merges of words come before those of runs, so only a space that stays alone joins the run.
        ids, alone = self._word(SPACE + word), self._ids_of_space()
        if ids.startswith(alone):
            return self._spaces(run) + ids[len(alone) :]
        return self._spaces(run - 1) + ids

    def _ids_of_space(self) -> bytes:
        return np.array([self.id_of[SPACE]], dtype="<i4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        made: list[bytes] = []
        at = 0
        while at < len(texts):
            size, cut = 0, []
            while at < len(texts) and size < RUN_CHARS:
                size += len(texts[at])
                cut.append(self._cut.findall((SPACE + texts[at]).replace(" ", SPACE)) if texts[at] else [])
                at += 1
            if len(self.new) > UNITS:
                self.old, self.new = self.new, {}
            long: dict[str, bytes] = {}
            for unit in set().union(*cut).difference(self.new):
                ids = self.old.get(unit) or self._unit(unit)
                (self.new if len(unit) <= UNIT_CHARS else long)[unit] = ids
            if long:
                made += [b"".join([self.new.get(u) or long[u] for u in units]) for units in cut]
            else:
                known = self.new.__getitem__
                made += [b"".join(map(known, units)) for units in cut]
        return made

    # Decoding.

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; the space that encoding puts first goes, bytes out of order become U+FFFD."""
        parts = [self.piece_bytes[i] for i in ids]
        for k, i in enumerate(ids):
            if i in self._starts_with_space:
                parts[k] = parts[k][1:]
            if i not in self._control:
                break
        if self._control.isdisjoint(ids):  # these part runs of bytes
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        return self._decode_runs(ids, parts)

    def _decode_runs(self, ids: list[int], parts: list[bytes]) -> str:
        out, at = [], 0
        while at < len(ids):
            to = at
            while to < len(ids) and self._is_byte[ids[to]]:
                to += 1
            if to == at:
                out.append(parts[at].decode())
                at += 1
                continue
            raw, k = b"".join(parts[at:to]), 0
            while k < len(raw):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(raw[k : k + n].decode())
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    n = 1
                    out.append("�")
                k += n
            at = to
        return "".join(out)


_loaded: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One model per worker process and file."""
    if path not in _loaded:
        _loaded[path] = PieceModel(path)
    return _loaded[path]

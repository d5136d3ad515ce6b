"""Cutting texts into pieces that a byte-level BPE treats independently.

The byte-level splitter attaches one leading space to the word that follows, so
nothing ever joins across the point before a space that precedes a
non-space character.  Texts are cut at those points with ``str.split``; only
pieces not seen before by the worker reach the (slow) splitter and the merges.

``PieceCache`` maps a piece to what the operator needs of it.  Its memory is bounded
whatever the text (see ``Generations``).
"""

from __future__ import annotations

import re
from collections.abc import Callable

_JOINED = re.compile(r" (?:\s|\Z)")
# The splitter's pattern for pieces of Latin letters, where it needs no Unicode tables.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_LATIN = re.compile(rf" ?[{_LETTER}]+| ?[0-9]+| ?[!-&(-/:-@\[-`{{-~]+|(?<!\n)\n(?!\n)")


def byte_alphabet() -> dict[int, str]:
    """Byte -> printable symbol of the public byte-level alphabet: printable Latin-1
    bytes stand for themselves, the others for code points from 256 on, in order."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in keep)
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


_SYMBOLS = byte_alphabet()


def check_byte_level(spec: dict) -> None:
    """Raise unless ``spec`` is a byte-level BPE that this module handles exactly."""
    m, pre = spec["model"], spec["pre_tokenizer"] or {}
    if (m["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
            or not pre.get("use_regex", True) or spec.get("normalizer") or m.get("dropout")
            or m.get("end_of_word_suffix") or m.get("continuing_subword_prefix") or m.get("ignore_merges")):
        raise ValueError("needs a byte-level BPE tokenizer without normalizer, prefix space, dropout or affixes")


def special_tokens(spec: dict) -> dict[str, int]:
    """Added tokens matched literally inside texts -> id."""
    out = {}
    for t in spec.get("added_tokens") or []:
        if t["single_word"] or t["lstrip"] or t["rstrip"]:
            raise ValueError(f"unsupported added token {t['content']!r}")
        out[t["content"]] = t["id"]
    return out


def split_pieces(text: str) -> list[str]:
    """Pieces whose concatenation is ``text``; every one but the first starts with a space."""
    if not text:
        return []
    parts = text.split(" ")
    if _JOINED.search(text) is None:
        return [parts[0], *[" " + p for p in parts[1:]]] if parts[0] else [" " + p for p in parts[1:]]
    out = [parts[0]]
    for p in parts[1:]:
        if p and not p[0].isspace():
            out.append(" " + p)
        else:
            out[-1] += " " + p
    return out if out[0] else out[1:]


class Generations:
    """A map of bounded size: a young generation takes new entries, and when it holds
    ``limit`` it becomes the old one, which is dropped in turn.  Long keys are not held."""

    def __init__(self, limit: int, longest: int):
        self.young: dict = {}
        self.old: dict = {}
        self._limit, self._longest = limit, longest

    def get(self, key: str):
        v = self.young.get(key)
        if v is None:
            v = self.old.get(key)
            if v is not None:
                self.put(key, v)
        return v

    def put(self, key: str, value) -> None:
        if len(key) <= self._longest:
            if len(self.young) >= self._limit:
                self.old, self.young = self.young, {}
            self.young[key] = value


class PieceCache:
    """piece -> ``join(word(u) for its units)``, where a unit is one word of the byte-level splitter."""

    def __init__(self, tokenizer_json: bytes, spec: dict, word: Callable, join: Callable, special: Callable,
                 limit: int = 300_000, longest: int = 64):
        from tokenizers import Tokenizer

        check_byte_level(spec)
        self._split = Tokenizer.from_buffer(tokenizer_json).pre_tokenizer.pre_tokenize_str
        self._special = special_tokens(spec)
        self._cut = re.compile("(" + "|".join(
            re.escape(s) for s in sorted(self._special, key=len, reverse=True)) + ")") if self._special else None
        self._word, self._join, self._special_value = word, join, special
        self._pieces = Generations(limit, longest)
        self._words = Generations(limit // 2, longest)

    def _units(self, piece: str) -> list[str]:
        """The splitter's units of ``piece`` in byte symbols."""
        found = _LATIN.findall(piece)
        if sum(map(len, found)) == len(piece):
            return [w.encode().decode("latin-1").translate(_SYMBOLS) for w in found]
        return [w for w, _ in self._split(piece)]

    def _of_word(self, w: str):
        v = self._words.get(w)
        if v is None:
            v = self._word(w)
            self._words.put(w, v)
        return v

    def _of_piece(self, p: str):
        v = self._pieces.get(p)
        if v is None:
            v = self._join([self._of_word(w) for w in self._units(p)])
            self._pieces.put(p, v)
        return v

    def values(self, text: str) -> list:
        """Values of the pieces of ``text`` in order; special strings count as pieces of their own."""
        if self._cut is None or self._cut.search(text) is None:
            return [self._of_piece(p) for p in split_pieces(text)]
        out: list = []
        for part in self._cut.split(text):
            if part in self._special:
                out.append(self._special_value(self._special[part]))
            elif part:
                out += [self._of_piece(p) for p in split_pieces(part)]
        return out

    def many(self, texts: list[str], join_coded: Callable) -> list:
        """One value per text: ``join`` over its pieces.

        Plain texts (single spaces, no special strings) are cut and coded together by
        Arrow, so each distinct piece is looked up once: ``join_coded(values, index, ends)``
        joins ``values[index[ends[i]:ends[i + 1]]]`` for every i."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        out: list = [None] * len(texts)
        plain, tails = [], []
        for i, t in enumerate(texts):
            if _JOINED.search(t) is None and (self._cut is None or self._cut.search(t) is None):
                head, space, tail = t.partition(" ")
                out[i] = self._of_piece(head) if head else self._join([])
                if space:
                    plain.append(i)
                    tails.append(tail)
            else:
                out[i] = self._join(self.values(t))
        if plain:
            parts = pc.split_pattern(pa.array(tails, pa.large_string()), " ")
            coded = parts.flatten().dictionary_encode()
            values = [self._of_piece(" " + p) for p in coded.dictionary.to_numpy(zero_copy_only=False)]
            rest = join_coded(values, coded.indices.to_numpy(), parts.offsets.to_numpy().astype(np.int64))
            for i, v in zip(plain, rest, strict=True):
                out[i] = self._join([out[i], v])
        return out

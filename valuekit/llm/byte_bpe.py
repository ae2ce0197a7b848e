"""Byte-level BPE ids for texts, exact to the tokenizers library, with work shared between equal words.

A text is cut where a space follows a non-space. The vocabulary's splitting pattern has a boundary at
every such place and never looks back, so the parts encode independently. Distinct parts are encoded
together by the library and kept in a bounded cache. A stretch longer than `LEAF` without such a cut is
taken apart by the pattern, and a single match longer than `LEAF` by tree concatenation: its halves are
encoded on their own, then a window around each join is encoded again and doubled until its first and
last ids agree with what both sides hold. Neighbouring ids of a BPE encoding determine that it is right,
so agreement at both ends makes the joined ids those of the whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
from itertools import repeat

import numpy as np
import regex

#: The splitting pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longest stretch, in characters, that is encoded in one go.
LEAF = 4096
#: Ids on each side of a join in the first window.
WINDOW = 8
#: Entries of the cache of encoded words, in two generations: at half of it the younger one becomes the older, whose words
#: come back when they are met (memory only, never results).
CACHED = 200_000
_CUT = re.compile(r"(?<=\S)(?= )")
_UNSAFE = re.compile(r" (?:(?<=\s )|(?=\n))")
#: Without one of these a line feed begins a part, as a space does.
_BLANK = re.compile(r"\n(?<=\s\n)")
#: Words of these letters and marks at the end of words: the pattern keeps such a word and the space before it together and
#: always parts a line feed before it and the run of marks after it, so words go without the pattern and their ids serve
#: for all. Special strings hold one of <, > and |, which are no marks here.
_LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]+")
_MARKS = "!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class ByteBpe:
    """Encoder and decoder for one vocabulary file of the tokenizers library."""

    def __init__(self, path: str, cached: int = CACHED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kind = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or kind["type"] != "ByteLevel" or kind["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE vocabulary without prefix space or normaliser is needed")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.symbols = byte_symbols()
        self.shown, self.space = dict(enumerate(self.symbols)), self.symbols[32]
        back = {ord(s): b for b, s in enumerate(self.symbols)}
        added = {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.pieces = [b""] * self.library.get_vocab_size(with_added_tokens=True)
        for piece, number in self.library.get_vocab(with_added_tokens=True).items():
            self.pieces[number] = added[number].encode() if number in added else bytes(back[ord(c)] for c in piece)
        self.packed = [k.to_bytes(4, "little") for k in range(len(self.pieces))]
        self.lengths = np.array([len(p) for p in self.pieces], dtype=np.int64)
        self.special = re.compile("(" + "|".join(map(re.escape, added.values())) + ")") if added else None
        self.by_text = {text: number for number, text in added.items()}
        self.pattern = regex.compile(PATTERN)
        self.cached = cached
        self.spaced: dict[str, bytes] = {}
        self.whole: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # -- encoding

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.spaced) + len(self.whole) > self.cached // 2:
            self.older, self.spaced, self.whole = self.spaced, {}, {}
        split = [_CUT.split(t) if _UNSAFE.search(t) else None for t in texts]
        # A line feed is a cut as well: the word after it keeps it in place of a space.
        plain = [(t if _BLANK.search(t) else t.replace("\n", " \n")).split(" ") if s is None else [""] for t, s in zip(texts, split)]
        first = {u for s, p in zip(split, plain) for u in (p[:1] if s is None else s)}.difference(self.whole)
        near = self.spaced.get
        found = [list(map(near, p[1:])) for p in plain]
        fresh: set[str] = set()
        for p, ids in zip(plain, found):
            if not all(ids):
                fresh.update([u for u, i in zip(p[1:], ids) if i is None])
        self._learn(fresh, first)
        near, far = self.spaced.__getitem__, self.whole.__getitem__
        out = []
        for s, p, ids in zip(split, plain, found):
            if s is not None:
                out.append(b"".join(map(far, s)))
                continue
            rest = ids if all(ids) else [near(u) if i is None else i for u, i in zip(p[1:], ids)]
            out.append(far(p[0]) + b"".join(rest))
        return out

    def _learn(self, fresh: set[str], first: set[str]) -> None:
        """Encode distinct parts: those after a space joined into long texts, the others one by one."""
        spaced, older = self.spaced, self.older
        known = fresh.intersection(older)
        spaced.update(zip(known, map(older.__getitem__, known)))
        latin, opening, together, lines, alone, marked = set(), set(), [], [], [], []
        for u in fresh.difference(known):
            word = u.rstrip(_MARKS).removeprefix("\n")
            if word.isalpha() and len(u) < LEAF and (word.isascii() or _LATIN.fullmatch(word)):
                at = len(word) + (u[0] == "\n")
                if at < len(u):
                    marked.append((u, u[:at], u[at:]))
                if u[:at] in older:
                    spaced[u[:at]] = older[u[:at]]
                elif u[:at] not in spaced:
                    (opening if at > len(word) else latin).add(word)
            elif u and len(u) < LEAF and not u[-1].isspace():
                (lines if u[0] == "\n" else together).append(u)
            else:
                alone.append(u)
        spaced.update(zip(latin, map(self._word, latin, repeat(" "))))
        if opening:
            feed = self._piece("\n")
            spaced.update(("\n" + u, feed + self._word(u, "")) for u in opening)
        self._learn_joined(together, " ")
        self._learn_joined(lines, "")
        ends = {m: self._piece(m) for m in {m for _, _, m in marked}}
        spaced.update([(u, spaced[word] + ends[m]) for u, word, m in marked])
        spaced.update({u: self.encode_stretch(u if u[:1] == "\n" else " " + u) for u in alone})
        self.whole.update({u: self.encode_stretch(u) for u in first})

    def _word(self, word: str, before: str) -> bytes:
        """Ids of a word that is one match of the pattern together with the space before it, if any."""
        text = before + word
        symbols = f"{self.space}{word}" if before and word.isascii() else text.encode().decode("latin-1").translate(self.shown)
        return b"".join([self.packed[t.id] for t in self.library.model.tokenize(symbols)])

    def _piece(self, text: str) -> bytes:
        return np.array(self._library(text), dtype="<u4").tobytes()

    def _learn_joined(self, words: list[str], before: str) -> None:
        """Encode words, each with what is before it, many in one text, and part their ids by their bytes."""
        step = 2000
        for i in range(0, len(words), step):
            part = words[i : i + step]
            ids = np.array(self.library.encode_batch_fast(["".join([before + u for u in part])], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.cumsum([len(u.encode()) + len(before) for u in part])
            cuts = (4 * (np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1)).tolist()
            data = ids.tobytes()
            self.spaced.update((u, data[a:b]) for u, a, b in zip(part, [0, *cuts], cuts))

    def _library(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode_stretch(self, text: str) -> bytes:
        """Ids of a stretch that may be long and hold no cut."""
        if len(text) <= LEAF:
            return np.array(self._library(text), dtype="<u4").tobytes()
        made = [self.tree(p) if long else np.array(self._library(p), dtype="<u4") for p, long in self.stretch_parts(text)]
        return np.concatenate(made).tobytes()

    def stretch_parts(self, text: str) -> list[tuple[str, bool]]:
        """A stretch as parts that encode independently; True marks a single match longer than LEAF."""
        parts: list[tuple[str, bool]] = []
        held: list[str] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                parts.append(("".join(held), False))
            held.clear()
            size = 0

        for piece in self.special.split(text) if self.special else [text]:
            if piece in self.by_text:
                flush()
                parts.append((piece, False))
                continue
            for match in self.pattern.finditer(piece):
                word = match.group()
                if len(word) > LEAF:
                    flush()
                    parts.append((word, True))
                    continue
                if size + len(word) > LEAF:
                    flush()
                held.append(word)
                size += len(word)
            flush()
        return parts

    def raw(self, data: bytes) -> np.ndarray:
        """Ids of bytes that belong to one match of the pattern."""
        return np.array([t.id for t in self.library.model.tokenize("".join([self.symbols[b] for b in data]))], dtype="<u4")

    def tree(self, word: str) -> np.ndarray:
        """Ids of one long match by tree concatenation."""
        return self.join_all([self.raw(leaf.encode()) for leaf in halves(word)])

    def join_all(self, parts: list[np.ndarray]) -> np.ndarray:
        """Join neighbours, level by level, until one is left."""
        while len(parts) > 1:
            parts = [self.join(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the concatenation of two encoded byte strings of one match."""
        width = WINDOW
        while True:
            a, b = left[-width:], right[:width]
            made = self.raw(self.bytes_of(a) + self.bytes_of(b))
            if (len(a) == len(left) or made[0] == a[0]) and (len(b) == len(right) or made[-1] == b[-1]):
                return np.concatenate([left[: len(left) - len(a)], made, right[len(b) :]])
            width *= 2

    # -- decoding

    def bytes_of(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are not UTF-8 become replacement characters."""
        return self.bytes_of(np.frombuffer(ids, dtype="<u4")).decode("utf-8", "replace")


def halves(word: str) -> list[str]:
    """The leaves, in order, of cutting a word in half until no part is longer than LEAF."""
    if len(word) <= LEAF:
        return [word]
    middle = len(word) // 2
    return halves(word[:middle]) + halves(word[middle:])


@functools.lru_cache(maxsize=4)
def byte_bpe(path: str, cached: int = CACHED) -> ByteBpe:
    """The encoder of a vocabulary file, once per Python worker."""
    return ByteBpe(path, cached)

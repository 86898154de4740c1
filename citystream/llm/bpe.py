"""Exact word-wise BPE with the tokenizers library.

A text is cut at single blanks.  For both kinds of vocabulary the ids of the
whole text are the ids of its pieces in order (``SPACED`` pieces carry the
blank before them), so each distinct piece is encoded once and ids are joined
back by position.  Pieces for which that could fail -- empty ones, ones that
begin or end in white space, ones that hold the start of a special token --
mark their document, which is then encoded as one text.

Texts are cut and their pieces counted in Arrow; Python sees each distinct piece
of a slice of texts once.  Texts of a ``SPACED`` vocabulary are cut as well where
the byte-level pattern always ends a word (``CUTS``), so that "word", "word." and
"word.\\nNext" hold one piece "word"; pieces behind such a cut begin with ``MARK``
and have no blank before them.  Texts that hold ``MARK`` are encoded as one text.
"""

from __future__ import annotations

import os
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces kept by one worker before its table is cut back to the frequent ones
#: (memory bound; the ids do not depend on it).
MAX_PIECES = 400_000
#: New pieces that are encoded as one text.
JOINED = 100

#: Stands before a piece without a blank (no character of Unicode).
MARK = "\uffff"
FEED = f"{MARK}\n"
#: Places where the byte-level pattern ends a word whatever is around: on both sides
#: of a single line feed between visible characters, and between a letter and a mark
#: that is no apostrophe (Latin-1 only, whose classes are settled).
_SEEN = "[!-~À-ÖØ-öø-ÿ]"
CUTS = [(rf"({_SEEN})\n({_SEEN})", f"\\1 {FEED} {MARK}\\2"),
        (r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~])", rf"\1 {MARK}\2")]


def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_padding()
    tok.no_truncation()
    return tok


def is_spaced(tok) -> bool:
    """Whether a word's ids depend on the blank before it (byte-level BPE)."""
    one = tok.encode("a", add_special_tokens=False).ids
    return tok.encode(" a", add_special_tokens=False).ids != one


class PieceTable:
    """Growing table of distinct pieces: piece -> slice of one flat id array."""

    def __init__(self, path: str):
        self.path, self.tok = path, load(path)
        self.spaced = is_spaced(self.tok)
        self.id_bytes = np.zeros(self.tok.get_vocab_size(), np.int64)
        for piece, i in self.tok.get_vocab().items():
            self.id_bytes[i] = len(piece)  # byte-level: one character a byte
        self.clear()

    def clear(self) -> None:
        self.first: dict[str, int] = {}
        self.rest: dict[str, int] = {} if self.spaced else self.first
        self.n = self.used = 0
        self.start = np.zeros(1024, np.int32)
        self.count = np.zeros(1024, np.int32)
        self.odd = np.zeros(1024, bool)
        self.hits = np.zeros(1024, np.int32)
        self.flat = np.zeros(4096, np.int32)

    def seed(self, words: list[str], counts: np.ndarray, flat: np.ndarray) -> None:
        """Begin with a ready table of distinct words (unspaced vocabularies)."""
        self.clear()
        n = len(words)
        self._room(n, len(flat))
        self.start[:n] = np.cumsum(counts) - counts
        self.count[:n] = counts
        self.flat[:len(flat)] = flat
        self.hits[:n] = 2
        self.rest.update(zip(words, range(n)))
        self.n, self.used = n, len(flat)

    def _room(self, n: int, m: int) -> None:
        for name, need in (("start", self.n + n), ("count", self.n + n),
                           ("odd", self.n + n),
                           ("hits", self.n + n), ("flat", self.used + m)):
            a = getattr(self, name)
            if need > len(a):
                grown = np.zeros(max(need, 2 * len(a)), a.dtype)
                grown[:len(a)] = a
                setattr(self, name, grown)

    def _add(self, pieces: list[str], into: dict[str, int], blank: str) -> None:
        odd = np.zeros(len(pieces), bool)
        mixed = [i for i, p in enumerate(pieces) if not p.isalpha()]
        odd[mixed] = [self._is_odd(pieces[i]) for i in mixed]
        lens, flat = self._encode_new(["" if o else p for p, o in zip(pieces, odd)],
                                      bool(blank))
        n, total = len(pieces), len(flat)
        self._room(n, total)
        lo = self.n
        self.start[lo:lo + n] = self.used + np.cumsum(lens) - lens
        self.count[lo:lo + n] = lens
        self.odd[lo:lo + n] = odd
        self.hits[lo:lo + n] = 0
        self.flat[self.used:self.used + total] = flat
        into.update(zip(pieces, range(lo, lo + n)))
        self.n += n
        self.used += total

    def _is_odd(self, p: str) -> bool:
        if not self.spaced or p == FEED:
            return "<|" in p
        p = p.removeprefix(MARK)
        return not p or p.strip() != p or "<|" in p or MARK in p

    def _ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids per piece, flat ids) of the pieces at ``at``."""
        lens = self.count[at].astype(np.int64)
        offs = np.cumsum(lens) - lens
        return lens, self.flat[np.repeat(self.start[at] - offs, lens) + np.arange(lens.sum())]

    def _encode_new(self, pieces: list[str], joined: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids per piece, flat ids).  ``joined`` pieces go in as texts of ``JOINED``
        pieces, all with their blank: the ids are cut by the number of bytes that each id
        stands for.  For a blank a piece behind a cut has a line feed, a word of its own,
        which is taken out again."""
        if joined:
            behind = np.fromiter((p[:1] == MARK and p != FEED for p in pieces), bool, len(pieces))
            full = [p and ("\n" if p == FEED else f"\n{p[1:]}" if b else f" {p}")
                    for p, b in zip(pieces, behind)]
            sizes = pc.binary_length(pa.array(full, pa.large_string())).to_numpy()
            ids = np.concatenate([np.array(e.ids, np.int32) for e in self.tok.encode_batch_fast(
                ["".join(full[i:i + JOINED]) for i in range(0, len(full), JOINED)],
                add_special_tokens=False)])
            at = np.searchsorted(np.cumsum(self.id_bytes[ids]), np.cumsum(sizes), "right")
            lens = np.diff(at, prepend=0)
            return lens - behind, np.delete(ids, (at - lens)[behind])
        got = [e.ids for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]
        lens = np.fromiter(map(len, got), np.int64, len(got))
        return lens, np.fromiter(chain.from_iterable(got), np.int32, int(lens.sum()))

    def _at(self, pieces: list[str], into: dict[str, int], blank: str) -> np.ndarray:
        """Places of ``pieces`` in the table, which learns those it lacks."""
        at = np.fromiter(map(into.get, pieces, repeat(-1)), np.int64, len(pieces))
        miss = np.flatnonzero(at < 0)
        if len(miss):
            lacking = [pieces[i] for i in miss.tolist()]
            new = list(dict.fromkeys(lacking))
            for lo in range(0, len(new), 50_000):
                self._add(new[lo:lo + 50_000], into, blank)
            at[miss] = np.fromiter(map(into.__getitem__, lacking), np.int64, len(miss))
        return at

    def _find(self, pieces: pa.Array, into: dict[str, int], blank: str) -> np.ndarray:
        coded = pieces.dictionary_encode()
        codes = coded.indices.to_numpy()
        at = self._at(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), into, blank)
        self.hits[at] += np.bincount(codes, minlength=len(at)).astype(np.int32)
        return at[codes]

    def _shrink(self) -> None:
        """Begin anew with the pieces seen most often, at most half the table."""
        hits = self.hits[:self.n]
        least = 2
        while (hits >= least).sum() > MAX_PIECES // 2:
            least *= 2
        keep = (hits >= least) & ~self.odd[:self.n]
        at = np.flatnonzero(keep)
        lens, flat = self._ids(at)
        new = np.cumsum(keep) - 1
        first = {p: int(new[i]) for p, i in self.first.items() if keep[i]}
        rest = ({p: int(new[i]) for p, i in self.rest.items() if keep[i]}
                if self.spaced else first)
        old = hits[at] // 2
        self.clear()
        self.first, self.rest = first, rest
        self._room(len(at), len(flat))
        self.start[:len(at)] = np.cumsum(lens) - lens
        self.count[:len(at)] = lens
        self.hits[:len(at)] = old
        self.flat[:len(flat)] = flat
        self.n, self.used = len(at), len(flat)

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per text) of whole texts without nulls."""
        if self.n > MAX_PIECES:
            self._shrink()
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        cut = texts
        for pattern, into in CUTS if self.spaced else []:
            cut = pc.replace_substring_regex(cut, pattern, into)
        own = pc.split_pattern(cut, " ")
        per = pc.list_value_length(own).to_numpy().astype(np.int64)
        pieces = own.flatten()
        begins = np.cumsum(per) - per
        if self.spaced:  # heads have no blank before them
            inner = np.ones(len(pieces), bool)
            inner[begins] = False
            at = np.empty(len(pieces), np.int64)
            at[inner] = self._find(pieces.filter(pa.array(inner)), self.rest, " ")
            at[begins] = self._find(pieces.take(pa.array(begins)), self.first, "")
        else:
            at = self._find(pieces, self.rest, "")
        lens, ids = self._ids(at)
        sizes = np.add.reduceat(lens, begins)
        odd = np.logical_or.reduceat(self.odd[at], begins)
        if self.spaced:
            odd |= pc.match_substring(texts, MARK).to_numpy(zero_copy_only=False)
        odd = np.flatnonzero(odd)
        empty = pc.binary_length(texts).to_numpy() == 0
        odd = odd[~empty[odd]]
        if self.spaced:
            sizes[empty] = 0
        if len(odd):  # whole-text encoding of the few documents that need it
            parts = np.split(ids, np.cumsum(sizes)[:-1])
            for i in odd:
                parts[i] = np.array(self.tok.encode(texts[i].as_py(), add_special_tokens=False).ids,
                                    np.int32)
                sizes[i] = len(parts[i])
            ids = np.concatenate(parts) if parts else ids
        return ids, sizes


_TABLES: dict[str, PieceTable] = {}


def table(path: str) -> PieceTable:
    """This worker's table for one vocabulary file."""
    if path not in _TABLES:
        _TABLES[path] = PieceTable(path)
    return _TABLES[path]


def slices(texts: list[str] | pa.Array, limit: int = 2_000_000):
    """(from, to) index ranges of about ``limit`` characters (Arrow: bytes) each."""
    lo = size = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist() if isinstance(texts, pa.Array)
                          else map(len, texts)):
        size += n + 1
        if size >= limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)

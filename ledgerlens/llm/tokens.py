"""Token ids of whole texts under a byte-level BPE tokenizer, stretch by stretch.

Such a tokenizer splits a text by a pattern whose parts are runs of letters, of
digits, of other visible characters, or of white space; a run of visible
characters may take one space in front. So no part reaches from a visible
character into white space after it, nor from a letter into an ASCII character
that is none, and every part is encoded on its own. A text can be cut at both
places, but not at a character of the tokenizer's added tokens, which it looks
for in the whole text first (they have no white space). A stretch is what lies
between two cuts. Each Python worker encodes a distinct stretch once and looks
its ids up by a 64-bit hash after that.

Texts are worked on in steps of about STEP bytes, long ones in several, so
memory does not grow with a text (but for a single stretch longer than STEP).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pandas as pd

from . import words as W

#: Bytes of text worked on at a time.
STEP = 1 << 20
#: Distinct stretches that a worker remembers.
REMEMBERED = 1 << 20
#: Stretches that are encoded in one call.
_TOGETHER = 4096
_SPACE = ~W.SPACED
#: Last two bytes of white-space characters beyond ASCII (of some other characters too; these
#: only make a stretch longer).
_WIDE = np.zeros(1 << 16, bool)
_WIDE[[0xC285, 0xC2A0, 0x9A80, 0x80A8, 0x80A9, 0x80AF, 0x819F, *range(0x8080, 0x808B)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
#: Visible ASCII characters that are neither letters nor digits.
_MARK = np.zeros(256, bool)
_MARK[0x21:0x7F] = ~_LETTER[0x21:0x7F]
_MARK[0x30:0x3A] = False
#: Second bytes of the two-byte letters after 0xC3: all but the signs for times and divided by.
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


def cuts(raw: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Places in a text's bytes where a stretch begins, other than 0; `marks` says which bytes do after a letter."""
    if len(raw) < 2:
        return np.empty(0, np.int64)
    space = _SPACE[raw]
    at = np.flatnonzero((space[1:] & ~space[:-1]) | (marks[raw[1:]] & (_LETTER[raw[:-1]] | _LATIN[raw[:-1]]))) + 1
    last, before = raw[at - 1], raw[np.maximum(at - 2, 0)]
    wide = _WIDE[before.astype(np.int64) << 8 | last]
    letter = _LETTER[last] | (_LATIN[last] & (before == 0xC3))
    return at[np.where(space[at], ~wide, letter)]


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which keeps it from task to task."""
    shared = sys.modules.setdefault("ledgerlens_llm_worker", ModuleType("ledgerlens_llm_worker"))
    held = shared.__dict__.setdefault("encoders", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


class Encoder:
    """Ids of stretches, by hash, for the stretches seen so far."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.marks = _MARK.copy()
        for token in self.tokenizer.get_added_tokens_decoder().values():
            self.marks[list(token.content.encode())] = False
        # a line feed before every stretch is a part of its own, and no stretch with at most one space has one
        self.line_feed, = self._of("\n")
        self._forget()

    def _of(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _forget(self):
        self.hash, self.slot = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0

    def _encoded(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the stretches one after another, how many each has, and the order in which they come."""
        plain = [i for i, r in enumerate(runs) if len(r.split()) == 1 and not r[-1].isspace() and not r[0 if r[0] != " " else 1].isspace()]
        odd = sorted(set(range(len(runs))) - set(plain))
        ids, sizes = [], []
        for i in range(0, len(plain), _TOGETHER):
            got = self._of("\n" + "\n".join([runs[j] for j in plain[i:i + _TOGETHER]]))
            first = np.flatnonzero(got == self.line_feed)
            sizes.append(np.diff(first, append=len(got)) - 1)
            ids.append(got[got != self.line_feed])
        for j in odd:
            ids.append(self._of(runs[j]))
            sizes.append([len(ids[-1])])
        return np.concatenate(ids), np.concatenate(sizes).astype(np.int64), np.array(plain + odd)

    def ids_of(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the stretches raw[start:end] in order, and how many each has."""
        if len(self.start) > REMEMBERED:
            self._forget()
        code, seen = pd.factorize(W._hashes(raw, start, end))
        at = np.searchsorted(self.hash, seen)
        known = at < len(self.hash)
        known[known] = self.hash[at[known]] == seen[known]
        if not known.all():
            new = np.flatnonzero(~known)
            one = np.empty(len(seen), np.int64)
            one[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            text = raw.tobytes()
            runs = [text[a:b].decode() for a, b in zip(start[one[new]].tolist(), end[one[new]].tolist(), strict=True)]
            ids, size, order = self._encoded(runs)
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            self.ids[self.used:self.used + len(ids)] = ids
            slots = np.empty(len(new), np.int64)
            slots[order] = len(self.start) + np.arange(len(new))
            self.start = np.concatenate([self.start, self.used + np.cumsum(size) - size])
            self.size, self.used = np.concatenate([self.size, size]), self.used + len(ids)
            by_hash = np.argsort(seen[new])
            into = at[new][by_hash]
            self.hash, self.slot = np.insert(self.hash, into, seen[new][by_hash]), np.insert(self.slot, into, slots[by_hash])
            at = np.searchsorted(self.hash, seen)
        slot = self.slot[at][code]
        first, size = self.start[slot], self.size[slot]
        place = np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)
        return self.ids[place], size


def _parts(texts: list[bytes | None], marks: np.ndarray) -> Iterator[tuple[int, bytes, bool]]:
    """(text, bytes, whether the text ends here): long texts in several parts, cut where a stretch begins."""
    for i, t in enumerate(texts):
        t = t or b""
        lo = 0
        while len(t) - lo > STEP:
            # the last cut within a step, or the next one after it
            window, near = STEP, np.empty(0, np.int64)
            while not len(near) and lo + window // 2 < len(t):
                near = cuts(np.frombuffer(t, np.uint8)[lo:lo + window], marks)
                window *= 2
            if not len(near):
                break
            hi = lo + int(near[-1])
            yield i, t[lo:hi], False
            lo = hi
        yield i, t[lo:], True


def token_ids(texts: list[bytes | None], encoder: Encoder) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(text, ids, whether the text ends here) in order; null texts are empty."""
    held, size = [], 0
    for part in _parts(texts, encoder.marks):
        if held and size + len(part[1]) > STEP:
            yield from _together(held, encoder)
            held, size = [], 0
        held.append(part)
        size += len(part[1])
    yield from _together(held, encoder)


def _together(parts: list[tuple[int, bytes, bool]], encoder: Encoder) -> Iterator[tuple[int, np.ndarray, bool]]:
    raw = np.frombuffer(b"".join(t for _, t, _ in parts), np.uint8)
    edge = np.cumsum([0, *(len(t) for _, t, _ in parts)])
    begins = np.zeros(len(raw), bool)
    begins[cuts(raw, encoder.marks)] = True
    begins[edge[:-1][np.diff(edge) > 0]] = True
    start = np.flatnonzero(begins)
    ids, size = encoder.ids_of(raw, start, np.append(start[1:], len(raw))[:len(start)]) if len(start) else (np.empty(0, np.uint32), np.empty(0, np.int64))
    at = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(start, edge)]
    for (i, _, last), lo, hi in zip(parts, at[:-1], at[1:], strict=True):
        yield i, ids[lo:hi], last

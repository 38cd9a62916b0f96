"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker.

The vocabulary's pre-tokenizer never joins characters across white space, and within plain Latin text it yields runs of
letters, single digits, runs of other signs, and the English contractions. So such text is split by numpy, every new
word is encoded by the library's own model, and known words are looked up by a 64-bit hash; their bytes are then compared,
and a text with a word that only shares the hash goes to the library. Any text with other characters goes there whole.
"""

from __future__ import annotations

import numpy as np

#: Words remembered per worker; beyond it the memory starts anew (only speed depends on it).
REMEMBERED = 1_500_000
#: Bytes handled at a time; a longer text is cut at white space, where no token can span.
SLICE = 1 << 18

_SPACE, _LETTER, _DIGIT, _OTHER, _BAD = 0, 1, 2, 3, 4
_CLASS = np.full(256, _BAD, np.uint8)
_CLASS[33:127] = _OTHER
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
_CLASS[ord("A"):ord("Z") + 1] = _LETTER
_CLASS[ord("a"):ord("z") + 1] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_TABLE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0x9E3779B97F4A7C15
_POW, _INV = powers(_BASE, SLICE + 1), powers(pow(_BASE, -1, 1 << 64), SLICE + 1)


def _byte_chars() -> dict[int, str]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1 bytes are themselves, the rest follow 255."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokenizer:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.stand_ins = _byte_chars()
        self.reset()

    def reset(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.at = np.empty(0, np.int64)
        self.count = np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)
        self.word_at = np.empty(0, np.int64)
        self.word_size = np.empty(0, np.int64)
        self.spelt = np.empty(0, np.uint8)

    def ids(self, data: np.ndarray) -> np.ndarray:
        """uint32 ids of one text given as UTF-8 bytes."""
        parts, at = [], 0
        while at < len(data):
            end = min(len(data), at + SLICE)
            if end < len(data):
                blank = np.flatnonzero(_CLASS[data[at:end]] == _SPACE)
                if not len(blank):
                    rest = np.flatnonzero(_CLASS[data[end:]] == _SPACE)
                    end = end + int(rest[0]) if len(rest) else len(data)
                else:
                    end = at + int(blank[-1]) + 1
            parts.append(self.batch(data[at:end], np.array([0, end - at]))[0])
            at = end
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def batch(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of several texts in one buffer, cut at ends (0 first), and the cuts of the ids."""
        kind = _CLASS[data]
        two = np.flatnonzero(data == 0xC3)
        two = two[two + 1 < len(data)]
        two = two[(data[two + 1] >= 0x80) & (data[two + 1] <= 0xBF) & (data[two + 1] != 0x97) & (data[two + 1] != 0xB7)]
        kind[two] = _LETTER
        kind[two + 1] = _LETTER
        bad = np.add.reduceat(kind == _BAD, np.minimum(ends[:-1], len(data) - 1), dtype=np.int64) if len(data) else np.zeros(len(ends) - 1, np.int64)
        bad[ends[:-1] == ends[1:]] = 0
        if len(data) > SLICE:
            bad[:] = 1
        else:
            for p in np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|"))) if len(data) > 1 else ():
                bad[np.searchsorted(ends, p, "right") - 1] = 1  # may begin a special token
        if bad.any():
            return self._mixed(data, ends, bad)
        return self._plain(data, kind, two, ends)

    def _mixed(self, data, ends, bad):
        raw, out = data.tobytes(), []
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            if bad[i]:
                out.append(np.array(self.whole.encode(raw[a:b].decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32))
            else:
                out.append(self.batch(data[a:b], np.array([0, b - a]))[0])
        return np.concatenate([np.empty(0, np.uint32), *out]), np.cumsum([0, *map(len, out)])

    def _plain(self, data, kind, two, ends):
        low = _LOWER[data]
        big = two[low[two + 1] <= 0x9E] + 1
        low[big] += 0x20
        n = len(low)
        if not n:
            return np.empty(0, np.uint32), np.zeros(len(ends), np.int64)
        start = np.empty(n + 1, bool)
        start[0], start[n] = True, True
        start[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        start[ends[ends < n]] = True
        self._contractions(low, kind, start, ends)
        start[:n] &= kind != _SPACE
        first = np.flatnonzero(start[:n])
        after = start.copy()
        after[:n] |= kind == _SPACE
        after[ends] = True
        stops = np.flatnonzero(after)
        last = stops[np.searchsorted(stops, first, "right")]
        if not len(first):
            return np.empty(0, np.uint32), np.zeros(len(ends), np.int64)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[low] * _POW[:n], out=total[1:])
        keys = (total[last] - total[first]) * _INV[first]
        keys ^= keys >> np.uint64(29)
        keys, some, back = np.unique(keys, return_index=True, return_inverse=True)
        where = self._known(keys, low, first[some], last[some])
        slot = where[back]
        wrong = self._differ(slot, low, first, last)
        if len(wrong):
            bad = np.zeros(len(ends) - 1, np.int64)
            bad[np.searchsorted(ends, first[wrong], "right") - 1] = 1
            return self._mixed(data, ends, bad)
        count = self.count[slot]
        cut = np.zeros(len(slot) + 1, np.int64)
        np.cumsum(count, out=cut[1:])
        ids = self.flat[np.repeat(self.at[slot] - cut[:-1], count) + np.arange(cut[-1])]
        return ids, cut[np.searchsorted(first, ends)]

    def _differ(self, slot, low, first, last):
        """Words whose bytes are not those remembered under their hash."""
        size = last - first
        other = self.word_size[slot] != size
        same = np.flatnonzero(~other)
        n = size[same]
        cut = np.cumsum(n) - n
        step = np.arange(n.sum())
        apart = low[np.repeat(first[same] - cut, n) + step] != self.spelt[np.repeat(self.word_at[slot[same]] - cut, n) + step]
        if apart.any():
            other[same[np.searchsorted(cut, np.flatnonzero(apart), "right") - 1]] = True
        return np.flatnonzero(other)

    @staticmethod
    def _contractions(low, kind, start, ends):
        n = len(low)
        for p in np.flatnonzero((low == ord("'")) & start[:n]):
            limit = int(ends[np.searchsorted(ends, p, "right")])
            tail = low[p + 1:min(p + 3, limit)].tobytes()
            size = 1 if tail[:1] in (b"s", b"t", b"m", b"d") else 2 if tail in (b"re", b"ve", b"ll") else 0
            if size:
                start[p + 1:p + 1 + size] = False
                if p + 1 + size < limit:
                    start[p + 1 + size] = True

    def _known(self, keys, low, first, last):
        """Places of the words in the worker's memory, new ones encoded on the way."""
        if len(self.keys) > REMEMBERED:
            self.reset()
        at = np.searchsorted(self.keys, keys)
        hit = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        hit[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~hit)
        if len(new):
            raw, made, sizes, spelt = low.tobytes(), [], [], []
            for i in new:
                spelt.append(raw[first[i]:last[i]])
                word = spelt[-1].decode("latin-1").translate(self.stand_ins)
                got = [t.id for t in self.model.tokenize(word)]
                made += got
                sizes.append(len(got))
            sizes = np.array(sizes, np.int64)
            begin = len(self.flat) + np.cumsum(sizes) - sizes
            self.flat = np.concatenate([self.flat, np.array(made, np.uint32)])
            self.count = np.insert(self.count, at[new], sizes)
            long = np.array([len(w) for w in spelt], np.int64)
            self.word_at = np.insert(self.word_at, at[new], len(self.spelt) + np.cumsum(long) - long)
            self.word_size = np.insert(self.word_size, at[new], long)
            self.spelt = np.concatenate([self.spelt, np.frombuffer(b"".join(spelt), np.uint8)])
            self.at = np.insert(self.at, at[new], begin)
            self.keys = np.insert(self.keys, at[new], keys[new])
            at = np.searchsorted(self.keys, keys)
        return at


_made: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """This worker's tokenizer of a file."""
    if path not in _made:
        _made.clear()
        _made[path] = WordTokenizer(path)
    return _made[path]

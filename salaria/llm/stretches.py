"""Stretches of texts and their ids, remembered by the stretches' bytes.

Texts are cut where a byte-level tokenizer (GPT-2's pattern) begins a word whatever stands around:

* before white space that follows another character: no word reaches over that place;
* between an ASCII letter or digit and an ASCII character that is neither: only white space and marks may follow;
* behind a line feed that stands alone between two other characters: such a run of white space is a word.

The pattern looks back nowhere and ahead only from white space, so the ids of a text are those of its stretches.
The bytes of a short stretch are a few integers, and all stretches of a batch are looked up together.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa

from salaria.llm.words import Entries

#: White space of any kind but the space itself; also what only Python counts as such.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Bytes of the longest stretch that is remembered, and of one that two integers hold with a byte to spare.
LONGEST, NARROW = 32, 15
_WHITE, _SIGN, _ALNUM, _HIGH, _FEED = 1, 2, 4, 8, 16
_KINDS = bytes(_HIGH if c > 127 else _WHITE if chr(c) in " " + SPACES else _ALNUM if chr(c).isalnum() else _SIGN for c in range(256))
_KINDS = _KINDS[:10] + bytes([_WHITE | _FEED]) + _KINDS[11:]
_WIDE_SPACES = np.array([int.from_bytes(c.encode()) for c in SPACES if not c.isascii()])
_LEADS = np.unique([c.encode()[0] for c in SPACES if not c.isascii()]).astype(np.uint8)
#: 0xFF in all but the first bytes of an integer: that byte is in no text.
_FILL = np.array([(1 << 64) - (1 << 8 * k) & (1 << 64) - 1 for k in range(9)], np.uint64)
#: Bytes behind the texts, so that every byte has integers that begin with it.
PADDING = LONGEST


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of ``texts`` one after the other, with padding behind; where each begins, and the end); nulls are empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return np.zeros(PADDING, np.uint8), np.zeros(1, np.int64)
    _, upto, data = texts.buffers()
    begin = np.frombuffer(upto, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.zeros(int(begin[-1] - begin[0]) + PADDING, np.uint8)
    if len(raw) > PADDING:
        raw[:-PADDING] = np.frombuffer(data, np.uint8)[begin[0]:begin[-1]]
    if raw.max() == 255:
        raw.tobytes().decode()  # no text: fails
    return raw, begin - begin[0]


def cut(raw: np.ndarray, begin: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where stretches begin, and the end; the number of the first stretch of each text, and of all). ``whole`` texts are not cut."""
    end = len(raw) - PADDING
    kind = np.frombuffer(raw[:end].tobytes().translate(_KINDS), np.uint8)
    here, before = kind[1:], kind[:-1]
    cuts = np.zeros(end + 1, bool)
    cuts[1:end] = ((before & _ALNUM) != 0) & ((here & (_WHITE | _SIGN)) != 0)
    cuts[1:end] |= ((before & _SIGN) != 0) & ((here & _WHITE) != 0)
    # A character of several bytes may be white space itself.
    at = np.flatnonzero(((before & _HIGH) != 0) & ((here & _WHITE) != 0)) + 1
    if len(at):
        two = raw[at - 2].astype(np.int64) << 8 | raw[at - 1]  # such a character has two bytes at least
        three = np.where(at > 2, raw[at - 3].astype(np.int64), 0) << 16 | two
        cuts[at[~(np.isin(two, _WIDE_SPACES) | np.isin(three, _WIDE_SPACES))]] = True
    at = np.flatnonzero(kind[1:-1] & _FEED) + 2
    at = at[((kind[at - 2] & (_ALNUM | _SIGN)) != 0) & ((kind[at] & _WHITE) == 0)]
    cuts[at[~np.isin(raw[at], _LEADS)]] = True
    for k in np.flatnonzero(whole).tolist():
        cuts[begin[k]:begin[k + 1]] = False
    cuts[begin] = True
    cuts[end] = True
    places = np.flatnonzero(cuts)
    return places, np.searchsorted(places, begin)


def _integers(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(the bytes of stretches as four integers, the last two 0 in narrow ones; hashes). ``size`` is ``LONGEST`` at most."""
    spread = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    key = [spread[start] | _FILL[np.minimum(size, 8)], spread[start + 8] | _FILL[np.clip(size - 8, 0, 8)]]
    mixed = key[0] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed += key[1]
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    wide = np.flatnonzero(size > NARROW)
    for k in (2, 3):
        some = np.zeros(len(size), np.uint64)
        some[wide] = spread[start[wide] + 8 * k] | _FILL[np.clip(size[wide] - 8 * k, 0, 8)]
        mixed[wide] = (mixed[wide] ^ mixed[wide] >> np.uint64(29)) + some[wide]
        mixed[wide] *= np.uint64(0x94D049BB133111EB)
        key.append(some)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return key, mixed


def _firsts(which: np.ndarray) -> np.ndarray:
    """Where each number of ``which`` comes first; they are numbered in that order."""
    most = np.maximum.accumulate(which)
    return np.flatnonzero(np.append(True, most[1:] > most[:-1])[:len(which)])


class _Generation(Entries):
    """Entries found by their keys in a table of pairs of places; a third key at one pair takes the place of the second."""

    def __init__(self, most: int):
        super().__init__()
        bits = max(4, (6 * most).bit_length())
        self.shift, self.places = np.uint64(64 - bits), np.zeros(1 << bits, np.int32)
        self.key = [np.full(1 << 10, _FILL[0]) for _ in range(4)]  # entry 0 has no stretch
        self.add(np.empty(0, np.uint32), np.zeros(1, np.int64))

    def find(self, key: list[np.ndarray], mixed: np.ndarray, wide: np.ndarray) -> np.ndarray:
        """Entries of keys; 0: unknown."""
        home = (mixed >> self.shift).astype(np.int64)
        out = self._same(self.places[home], key, wide)
        holes = np.flatnonzero(out == 0)
        if len(holes):
            out[holes] = self._same(self.places[home[holes] ^ 1], [k[holes] for k in key], wide[holes])
        return out

    def _same(self, entry: np.ndarray, key: list[np.ndarray], wide: np.ndarray) -> np.ndarray:
        entry = entry.astype(np.int64)
        same = (self.key[0][entry] == key[0]) & (self.key[1][entry] == key[1])
        more = np.flatnonzero(same & wide)
        same[more] = (self.key[2][entry[more]] == key[2][more]) & (self.key[3][entry[more]] == key[3][more])
        entry[~same] = 0
        return entry

    def put(self, key: list[np.ndarray], mixed: np.ndarray, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Entries of new keys."""
        numbers = np.array(self.add(ids, size), np.int64)
        while self.count > len(self.key[0]):
            self.key = [np.concatenate([k, np.empty_like(k)]) for k in self.key]
        for mine, k in zip(self.key, key):
            mine[numbers] = k
        home = (mixed >> self.shift).astype(np.int64)
        self.places[np.where(self.places[home] == 0, home, home ^ 1)] = numbers
        return numbers


class StretchMemory:
    """Entries of stretches, of which about ``most`` are kept, and as many of the generation before: what is asked for
    again is taken over from it, the rest is forgotten. Stretches of more than ``LONGEST`` bytes serve one batch."""

    def __init__(self, most: int):
        self.most, self.now, self.earlier = most, _Generation(most), _Generation(1)

    def entries(self, raw: np.ndarray, places: np.ndarray, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Entries of the stretches of ``raw`` between ``places``; ``forget`` must be called when their ids are taken."""
        if self.now.count > self.most:
            self.now, self.earlier = _Generation(self.most), self.now
        start, size = places[:-1], np.diff(places)
        out = np.zeros(len(start), np.int64)
        short = np.flatnonzero(size <= LONGEST)
        key, mixed = _integers(raw, start[short], size[short])
        wide = size[short] > NARROW
        found = self.now.find(key, mixed, wide)
        holes = np.flatnonzero(found == 0)
        key, mixed = [k[holes] for k in key], mixed[holes]
        before = self.earlier.find(key, mixed, wide[holes])
        old = np.flatnonzero(before)
        if len(old):
            which, entry = pd.factorize(before[old])
            some = old[_firsts(which)]
            found[holes[old]] = self.now.put([k[some] for k in key], mixed[some], self.earlier.gather(entry), self.earlier.size[entry])[which]
        new = np.flatnonzero(before == 0)
        if len(new):
            which, _ = pd.factorize(mixed[new])
            some = new[_firsts(which)]
            if all((k[new] == k[some][which]).all() for k in key):
                data, at = memoryview(raw), short[holes[some]]
                words = [str(data[a:b], "utf-8") for a, b in zip(start[at].tolist(), (start[at] + size[at]).tolist())]
            else:  # two stretches of one hash
                words, which = self._distinct(raw, start, size, short[holes[new]])
                some = new[_firsts(which)]
            found[holes[new]] = self.now.put([k[some] for k in key], mixed[some], *learn(words))[which]
        out[short] = found
        self.mark = self.now.count, self.now.used
        long = np.flatnonzero(size > LONGEST)
        if len(long):
            words, which = self._distinct(raw, start, size, long)
            out[long] = np.array(self.now.add(*learn(words)), np.int64)[which]
        return out

    @staticmethod
    def _distinct(raw: np.ndarray, start: np.ndarray, size: np.ndarray, some: np.ndarray) -> tuple[list[str], np.ndarray]:
        """(distinct stretches in order of their first place among ``some``, which one each of them is)."""
        data, begin = raw.tobytes(), start[some]
        number: dict[bytes, int] = {}
        which = [number.setdefault(data[a:b], len(number)) for a, b in zip(begin.tolist(), (begin + size[some]).tolist())]
        return [w.decode() for w in number], np.array(which, np.int64)

    def add(self, ids: np.ndarray) -> int:
        """An entry until ``forget``."""
        return self.now.add(ids, np.array([len(ids)], np.int64))[0]

    def forget(self) -> None:
        self.now.count, self.now.used = self.mark

    def gather_lists(self, entries: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all lists of ``entries`` one after the other, ids of each list)."""
        upto = np.concatenate([[0], np.cumsum(self.now.size[entries])])
        return self.now.gather(entries), np.diff(upto[offsets])

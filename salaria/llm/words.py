"""Ids of words, remembered in arrays, so that texts are put together from the words of a whole batch at once.

The words of a batch are found and numbered by Arrow; each distinct one is looked up once, and
the ids of all texts are gathered by offsets, without a Python object for each word of the text.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Encodes words: their ids one after the other, and how many each has.
Learn = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def gather(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` that begin at ``start`` and have ``size``, one after the other; ``start`` is overwritten."""
    start[1:] -= np.cumsum(size)[:-1]
    at = np.repeat(start, size)
    at += np.arange(len(at))
    return ids[at]


class Entries:
    """Runs of ids, one after the other in an array that grows."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.ids, self.start, self.size = np.empty(1 << 16, np.uint32), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.count, self.used = 0, 0

    def add(self, ids: np.ndarray, size: np.ndarray) -> range:
        """Numbers of new entries, whose ``ids`` follow each other in pieces of ``size``."""
        first, self.count = self.count, self.count + len(size)
        begin, self.used = self.used, self.used + len(ids)
        while self.count > len(self.start):
            self.start, self.size = (np.concatenate([x, np.empty_like(x)]) for x in (self.start, self.size))
        while self.used > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.size[first:self.count] = size
        self.start[first:self.count] = begin + np.cumsum(size) - size
        self.ids[begin:self.used] = ids
        return range(first, self.count)

    def gather(self, entries: np.ndarray) -> np.ndarray:
        """The ids of ``entries``, one after the other."""
        return gather(self.ids, self.start[entries], self.size[entries])


class WordMemory:
    """Entries of words, of which about ``most`` are kept, and as many of the generation before: what is asked for
    again is taken over from it, the rest is forgotten."""

    def __init__(self, most: int):
        self.most, self.now, self.earlier = most, Entries(), Entries()

    def words(self, texts: pa.Array, learn: Learn) -> tuple[np.ndarray, np.ndarray]:
        """(entries of the words of all ``texts`` between single spaces, where each text's words begin, and the end); nulls are empty."""
        if len(self.now.number) > self.most:
            self.now, self.earlier = Entries(), self.now
        words = pc.split_pattern(pc.fill_null(texts, ""), " ")
        offsets = words.offsets.to_numpy().astype(np.int64)
        found = words.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        return self._entries(found.dictionary.to_pylist(), learn)[found.indices.to_numpy()], offsets - offsets[0]

    def _entries(self, words: list[str], learn: Learn) -> np.ndarray:
        """The entries of distinct words; unknown ones are learned."""
        now, earlier = self.now, self.earlier
        found = np.fromiter(map(now.number.get, words, repeat(-1)), np.int64, len(words))
        holes = np.flatnonzero(found < 0)
        if not len(holes):
            return found
        missing = [words[k] for k in holes.tolist()]
        before = np.fromiter(map(earlier.number.get, missing, repeat(-1)), np.int64, len(missing))
        old, new = np.flatnonzero(before >= 0), np.flatnonzero(before < 0)
        for places, make in ((old, lambda _: (earlier.gather(before[old]), earlier.size[before[old]])), (new, learn)):
            if len(places):
                some = [missing[k] for k in places.tolist()]
                numbers = now.add(*make(some))
                now.number.update(zip(some, numbers))
                found[holes[places]] = numbers
        return found

    def add(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Entries without a word, until ``forget_since``."""
        return np.array(self.now.add(ids, size), np.int64)

    def mark(self) -> tuple[int, int]:
        return self.now.count, self.now.used

    def forget_since(self, mark: tuple[int, int]) -> None:
        """Drop the entries added after ``mark``, none of which may have a word."""
        self.now.count, self.now.used = mark

    def gather_lists(self, entries: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all lists of ``entries`` one after the other, ids of each list)."""
        upto = np.concatenate([[0], np.cumsum(self.now.size[entries])])
        return self.now.gather(entries), np.diff(upto[offsets])


def insert_behind(entries: np.ndarray, offsets: np.ndarray, entry: int) -> tuple[np.ndarray, np.ndarray]:
    """``entries`` and ``offsets`` with one more ``entry`` at the end of each list."""
    return np.insert(entries, offsets[1:], entry), offsets + np.arange(len(offsets))

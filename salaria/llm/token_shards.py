"""Token ids in shard files, compressed by Re-Pair grammars.

Documents are put in ascending order of their ids (range partitions, sorted), encoded
with a byte-level tokenizer, and packed into shards of consecutive documents. In
each shard the most frequent pairs of neighbouring ids are replaced by new symbols
(nonterminals), over and over until no pair is frequent (Larsson and Moffat 1999);
every turn replaces the frequent pairs of that turn together. A pair never reaches over a document's end, so
a document is a run of symbols of its own. The shard stores the rules, the length
each symbol expands to, the symbols, and where documents begin: any run of ids is
read by walking expansion lengths and expanding only the symbols it touches.

File format: Parquet rows (part, shard, n_ids, blob) in the checkpoint folder or a
folder given; ``blob`` is described at ``pack_shard``. One shuffle, of the texts.

Encoding by words: the ids of stretches between borders where the tokenizer cuts
words whatever stands around (``stretches``) are joined, and remembered.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salaria.llm.rows import documents, release_memory, reuse_memory, small_batches
from salaria.llm.stretches import StretchMemory, cut, text_bytes
from salaria.llm.words import gather, insert_behind
from salaria.plans.scratch import session_scratch

END = 2
#: Ids of a shard (about), least count of a pair, stretches remembered (twice as many at most).
SHARD_IDS, LEAST, MEMORY = 2_000_000, 32, 300_000
_CELL_BITS = 20
#: Words that are learned in one text.
_RUN_WORDS = 100
_MAGIC = b"RPS1"


def tokenizer_json(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


class Encoder:
    """ids of whole texts.

    ``literal``: the text of an added token marked special (an end-of-text mark) is
    spelled out in pieces; False: it is that token, as in the library's plain call.
    """

    def __init__(self, spec: str, literal: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = literal
        added = self.tokenizer.get_added_tokens_decoder().values()
        #: Found before the text is cut into words: texts with one of them are encoded whole.
        self.added = [t.content for t in added if not (literal and t.special)]
        #: Tokens that take up or ask for what stands beside them, or are sought in normalised text: no text is cut.
        self.uncut = any(t.lstrip or t.rstrip or t.single_word or t.normalized or any(map(str.isspace, t.content)) for t in added)
        way = json.loads(spec)
        pattern = way["pre_tokenizer"] or {}
        #: Only texts of this way to find words are cut.
        self.uncut |= way["normalizer"] is not None or pattern.get("type") != "ByteLevel" or pattern["add_prefix_space"] or not pattern.get("use_regex", True)
        self.memory = StretchMemory(MEMORY)
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, k in self.tokenizer.get_vocab().items():
            self.spaced[k] = token.startswith("\u0120")  # the tokenizer's sign for a space
        self.feed = self.whole(["\n"])[0]

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _spaced(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encode words that begin with a space and have no other, many in one text: an id that begins with a space begins a word."""
        ids = np.concatenate(self.whole(["".join(words[k:k + _RUN_WORDS]) for k in range(0, len(words), _RUN_WORDS)]))
        at = np.flatnonzero(self.spaced[ids])
        return (ids, np.diff(np.append(at, len(ids)))) if len(at) == len(words) else self._each(words)  # else: a tokenizer that joins otherwise

    def _lines(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encode words of ASCII letters and digits, many in one text: each on a line of its own."""
        ids = np.concatenate(self.whole(["\n".join(words[k:k + _RUN_WORDS]) + "\n" for k in range(0, len(words), _RUN_WORDS)]))
        if len(self.feed) != 1 or np.count_nonzero(feeds := ids == self.feed[0]) != len(words):
            return self._each(words)
        return ids[~feeds], np.diff(np.append(-1, np.flatnonzero(feeds))) - 1

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = self.whole(words)
        return np.concatenate(each), np.array([len(e) for e in each])

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``words`` one after the other, and how many each has."""
        ways: tuple[list[int], ...] = [], [], []
        spaced = [k for k, w in enumerate(words) if w[0] == " "]
        if self.uncut:
            ways[2].extend(range(len(words)))
        elif "".join([words[k] for k in spaced]).split() == [words[k][1:] for k in spaced]:
            ways[0].extend(spaced)
        else:
            for k in spaced:
                ways[0 if words[k].split() == [words[k][1:]] else 2].append(k)
        if not self.uncut:
            for k, w in enumerate(words):
                if w[0] != " ":
                    ways[1 if w.isascii() and w.isalnum() else 2].append(k)
        parts = [way([words[k] for k in some]) for way, some in zip((self._spaced, self._lines, self._each), ways) if some]
        size = np.concatenate([p[1] for p in parts])
        place = np.empty(len(words), np.int64)
        place[ways[0] + ways[1] + ways[2]] = np.arange(len(words))
        return gather(np.concatenate([p[0] for p in parts]), (np.cumsum(size) - size)[place], size[place]), size[place]

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, ids of each text); nulls are empty, ``end`` is put behind each."""
        whole = np.full(len(texts), self.uncut)
        for added in self.added:
            whole |= pc.match_substring(texts, added).fill_null(False).to_numpy(zero_copy_only=False)
        raw, begin = text_bytes(texts)
        places, offsets = cut(raw, begin, whole)
        entries = self.memory.entries(raw, places, self._learn)
        if end is not None:
            entries, offsets = insert_behind(entries, offsets, self.memory.add(np.array([end], "<u4")))
        out = self.memory.gather_lists(entries, offsets)
        self.memory.forget()
        return out

    def batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        ids, sizes = self.encode(pa.array(texts, pa.string()))
        upto = np.cumsum(sizes)
        return [ids[b - n:b].astype("<u4").tobytes() for b, n in zip(upto.tolist(), sizes.tolist())]


def _every_other(same: np.ndarray) -> np.ndarray:
    """False for every second place of a run; ``same``: the place goes on with the run of the one before."""
    out = np.ones(len(same), bool)
    at = np.flatnonzero(same)
    if len(at):
        step = np.arange(len(at))
        first = np.append(True, at[1:] != at[:-1] + 1)  # of the places that go on with one run
        out[at] = (step - np.maximum.accumulate(np.where(first, step, 0))) % 2 == 1
    return out


def _apart(places: np.ndarray, after: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which pairs to replace, the heaviest first, so that none overlap and none could be added.

    ``places`` are in order, ``after``: the places of the pairs' second symbols.
    Weights are equal for equal pairs only; in a run of one pair every other one counts.
    """
    chosen = np.zeros(len(places), bool)
    left = None  # numbers of the pairs to decide on; None: all
    while left is None or len(left):
        near = after[:-1] == places[1:]
        same = weight[1:] == weight[:-1]
        win = _every_other(np.append(False, near & same)[:len(places)])
        less = weight[1:] < weight[:-1]
        win[1:] &= ~(near & less)
        win[:-1] &= ~(near & ~(less | same))
        chosen[win if left is None else left[win]] = True
        keep = ~win
        keep[:-1] &= ~(near & win[1:])
        keep[1:] &= ~(near & win[:-1])
        rest = np.flatnonzero(keep)
        left = rest if left is None else left[rest]
        places, after, weight = places[rest], after[rest], weight[rest]
    return chosen


def _ordered(places: np.ndarray, n: int) -> np.ndarray:
    """``places`` below ``n`` in order, each once."""
    if len(places) > n >> 6:
        among = np.zeros(n, bool)
        among[places] = True
        return np.flatnonzero(among)
    places = np.sort(places)
    return places[np.append(True, places[1:] != places[:-1])[:len(places)]]


def repair(seq: np.ndarray, ends: np.ndarray, first: int, turns: int | None = None, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules, symbols, ends) of ``seq``; rule k is the pair that symbol ``first + k`` stands for.

    ``ends`` marks the last symbol of each document. Turns go on until no pair occurs
    ``least`` times (``turns``: at most so many), counted exactly and without overlaps:
    of a run of one symbol every other pair counts. In a turn all frequent pairs are
    replaced together, at an overlap the more frequent one. Symbols stay in a linked
    list; a pair of known symbols never gets more frequent, so after the first turn
    only pairs of new symbols are counted anew.
    """
    n = len(seq)
    symbols = np.append(seq, 0).astype(np.uint32)
    after, before = np.arange(1, n + 1), np.arange(-1, n)
    after[:-1][ends[:-1]] = n  # place n: none
    after[-1:] = n
    before[:1] = n
    before[1:n][ends[:-1]] = n
    kind = np.full(n + 1, -1, np.int32)  # number of the pair that begins at a place; -1: rare, or none
    known, rules, size = np.empty(0, np.uint64), [], 0
    fresh, active, turn = np.flatnonzero(after < n), np.empty(0, np.int64), 0
    while turns is None or turn < turns:
        turn += 1
        left, right = (symbols[:-1], symbols[1:]) if turn == 1 else (symbols[fresh], symbols[after[fresh]])
        if len(fresh) > 1 << _CELL_BITS - 4:  # a pair is at most as frequent as its hashed cell
            cell = ((left * np.uint32(0x9E3779B1) ^ right) * np.uint32(0x85EBCA6B) >> np.uint32(32 - _CELL_BITS)).astype(np.int64)
            full = (np.bincount(cell, minlength=1 << _CELL_BITS) >= least)[cell]
        else:
            full = np.ones(len(left), bool)
        if turn == 1:
            full &= after[:n] < n
        full = np.flatnonzero(full)
        fresh = full if turn == 1 else fresh[full]
        pair = left[full].astype(np.uint64) << np.uint64(32)
        pair |= right[full]
        code, distinct = pd.factorize(pair)
        often = np.flatnonzero(np.bincount(code, minlength=len(distinct)) >= least)
        often = often[np.argsort(distinct[often])]
        number = np.full(len(distinct), -1, np.int32)
        number[often] = np.arange(len(known), len(known) + len(often))
        number = number[code]
        kind[fresh] = number
        known = np.concatenate([known, distinct[often]])
        new = fresh[np.flatnonzero(number >= 0)]
        active = _ordered(np.concatenate([active, new]), n) if len(active) else new
        k = kind[active]
        then = after[active]
        same = np.append(False, (then[:-1] == active[1:]) & (k[1:] == k[:-1]))[:len(active)]
        count = np.bincount(k[_every_other(same)], minlength=len(known))
        live = (count >= least)[k]
        if not live.all():
            kind[active[~live]] = -1
            live = np.flatnonzero(live)
            active, then, k = active[live], then[live], k[live]
        if not len(active):
            break
        # Equal counts: by the number, scrambled, so that a repeated passage is paired all over at once.
        weight = np.empty(len(known), np.int32)
        weight[np.argsort((count << 32) | (np.arange(len(known)) * 0x9E3779B1 & 0xFFFFFFFF))] = np.arange(len(known))
        weight = weight[k]
        chosen = _apart(active, then, weight)
        often = np.bincount(k[chosen], minlength=len(known)) >= least
        seldom = np.flatnonzero(chosen & ~often[k])
        if len(seldom):
            # Places that pairs chosen too seldom held: every place of the others is replaced, or overlaps one that is.
            chosen[seldom] = False
            beside = np.concatenate([seldom[seldom > 0] - 1, seldom[seldom < len(active) - 1] + 1])
            beside = _ordered(beside[often[k[beside]] & ~chosen[beside]], len(active))
            held = chosen[np.maximum(beside - 1, 0)] & (then[beside - 1] == active[beside])
            held |= chosen[np.minimum(beside + 1, len(active) - 1)] & (then[beside] == active[np.minimum(beside + 1, len(active) - 1)])
            beside = beside[~held]
            chosen[beside[_apart(active[beside], then[beside], weight[beside])]] = True
        chosen = np.flatnonzero(chosen)
        place, inside = active[chosen], k[chosen]
        uses = np.bincount(inside, minlength=len(known))
        kept = np.flatnonzero(uses)
        kept = kept[np.argsort(-uses[kept], kind="stable")]
        symbol = np.zeros(len(known), np.uint32)
        symbol[kept] = np.arange(first + size, first + size + len(kept), dtype=np.uint32)
        new = symbol[inside]
        rules.append(np.stack([known[kept] >> np.uint64(32), known[kept] & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32))
        size += len(kept)
        gone = after[place]
        symbols[place] = new
        after[place] = after[gone]
        before[after[place]] = place
        before[gone], after[gone], kind[gone], kind[place] = -1, -1, -1, -1
        back = before[place]
        fresh = _ordered(np.concatenate([place[after[place] < n], back[back < n]]), n)
        kind[fresh] = -1
        active = active[np.flatnonzero(kind[active] >= 0)]
    held = after[:n] >= 0
    return np.concatenate(rules or [np.empty((0, 2), np.uint32)]), symbols[:n][held], after[:n][held] == n


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """Ids that each rule's symbol expands to. Rules use earlier symbols only."""
    out = np.ones(len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        out[k] = (out[a - first] if a >= first else 1) + (out[b - first] if b >= first else 1)
    return out


def needed_rules(symbols: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """Numbers of the rules that ``symbols`` expand through, ascending: found by walking down from them."""
    asked = np.zeros(len(rules), bool)
    front = symbols[symbols >= first].astype(np.int64) - first
    while len(front):
        asked[front] = True
        front = rules[np.unique(front)].ravel().astype(np.int64) - first
        front = front[front >= 0]
        front = front[~asked[front]]
    return np.flatnonzero(asked)


def expand(symbols: np.ndarray, rules: np.ndarray, sizes: np.ndarray, first: int) -> np.ndarray:
    """The ids of ``symbols``; ``sizes``: expansion lengths of the rules. Only rules that occur below ``symbols`` are expanded."""
    asked = needed_rules(symbols, rules, first)
    begin = np.zeros(len(rules), np.int64)  # of the asked rules' expansions, one after the other
    upto = np.cumsum(sizes[asked], dtype=np.int64)
    begin[asked] = upto - sizes[asked]
    words = np.empty(int(upto[-1]) if len(asked) else 0, np.uint32)
    for (a, b), at, end in zip(rules[asked].tolist(), begin[asked].tolist(), upto.tolist()):
        mid = at + (int(sizes[a - first]) if a >= first else 1)
        words[at:mid] = words[begin[a - first]:begin[a - first] + mid - at] if a >= first else a
        words[mid:end] = words[begin[b - first]:begin[b - first] + end - mid] if b >= first else b
    inner = symbols >= first
    rule = symbols[inner].astype(np.int64) - first
    size = np.ones(len(symbols), np.int64)
    size[inner] = sizes[rule]
    at = np.empty(len(symbols), np.int64)  # of each symbol's ids among the words and, behind them, the symbols that are ids
    at[inner] = begin[rule]
    plain = symbols[~inner]
    at[~inner] = np.arange(len(words), len(words) + len(plain))
    return gather(np.concatenate([words, plain]), at, size)


def pack_shard(doc_ids: list[int | None], codes: list[bytes], vocabulary: int) -> bytes:
    """``pack_ids`` of documents whose ids come as little-endian unsigned 32-bit integers."""
    return pack_ids(doc_ids, np.frombuffer(b"".join(codes), "<u4"), np.array([len(c) // 4 for c in codes], np.int64), vocabulary)


def pack_ids(doc_ids: list[int | None], seq: np.ndarray, lengths: np.ndarray, vocabulary: int) -> bytes:
    """The blob of a shard of the ids ``seq``, ``lengths`` of them for each document. Little-endian: magic RPS1; counts of documents,
    rules, symbols and the first nonterminal (4 x u32); then doc_ids (i64) and whether they are null (u8), first symbol of each document
    (u32), ids of each document (u32), rules (2 x u32), their expansion lengths (u32), symbols (u16 where all fit, else u32)."""
    ends = np.zeros(len(seq), bool)
    ends[np.cumsum(lengths) - 1] = True
    rules, symbols, ends = repair(seq, ends, vocabulary)
    begin = np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1])
    wide = "<u2" if vocabulary + len(rules) <= 1 << 16 else "<u4"
    head = _MAGIC + struct.pack("<4I", len(doc_ids), len(rules), len(symbols), vocabulary)
    return b"".join([head, np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], "u1").tobytes(),
                     begin.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), rules.astype("<u4").tobytes(),
                     expansion_lengths(rules, vocabulary).astype("<u4").tobytes(), symbols.astype(wide).tobytes()])


class Shard:
    """A shard read back, with random access."""

    def __init__(self, blob: bytes):
        if blob[:4] != _MAGIC:
            raise ValueError("not a shard")
        n, r, s, self.first = struct.unpack_from("<4I", blob, 4)
        at = 20

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, count, at)
            at += out.nbytes
            return out

        ids, none = take("<i8", n), take("u1", n)
        self.doc_ids = [None if x else int(d) for d, x in zip(ids, none)]
        self.begin, self.lengths = take("<u4", n), take("<u4", n)
        self.upto = np.cumsum(self.lengths, dtype=np.int64)
        self.rules, self.sizes = take("<u4", 2 * r).reshape(-1, 2), take("<u4", r)
        self.symbols = take("<u2" if self.first + r <= 1 << 16 else "<u4", s)

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``end`` of the shard; only the symbols that hold them are expanded."""
        if end is None:
            end = int(self.upto[-1]) if len(self.upto) else 0
        if start >= end:
            return np.empty(0, np.uint32)
        if start <= 0 and end >= self.upto[-1]:
            return expand(self.symbols.astype(np.uint32), self.rules, self.sizes, self.first)
        # The documents, then the symbols in them, by expansion lengths.
        low, high = int(np.searchsorted(self.upto, start, "right")), int(np.searchsorted(self.upto, end, "left"))
        symbols = self._symbols(low, high)
        size = np.ones(len(symbols), np.int64)
        inner = symbols >= self.first
        size[inner] = self.sizes[symbols[inner].astype(np.int64) - self.first]
        upto = np.cumsum(size)
        skip = start - (int(self.upto[low - 1]) if low else 0)
        end += skip - start
        a, b = np.searchsorted(upto, skip, "right"), np.searchsorted(upto, end, "left") + 1
        before = int(upto[a - 1]) if a else 0
        return expand(symbols[a:b], self.rules, self.sizes, self.first)[skip - before:end - before]

    def _symbols(self, low: int, high: int) -> np.ndarray:
        """Symbols of the documents ``low`` to ``high``."""
        stop = self.begin[high + 1] if high + 1 < len(self.begin) else len(self.symbols)
        return self.symbols[self.begin[low]:stop].astype(np.uint32)

    def document(self, k: int) -> np.ndarray:
        """The ids of document number ``k`` of the shard."""
        return expand(self._symbols(k, k), self.rules, self.sizes, self.first)


_ENCODERS: dict[int, Encoder] = {}


def _encoder(spec: str) -> Encoder:
    """One per worker: what it remembers serves the worker's later tasks."""
    key = zlib.crc32(spec.encode())
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(spec, literal=False)
    return _ENCODERS[key]


def _shards(spec: str, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reuse_memory()
        encoder = _encoder(spec)
        vocabulary = encoder.tokenizer.get_vocab_size()
        part, number = TaskContext.get().partitionId(), 0
        ids, codes, sizes, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            blob = pack_ids(ids, np.concatenate(codes), np.concatenate(sizes), vocabulary)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([held], pa.int64()),
                                               pa.array([blob], pa.binary())], names=["part", "shard", "n_ids", "blob"])

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                code, size = encoder.encode(some.column(1), END)
                doc_ids, upto, done = some.column(0).to_pylist(), np.cumsum(size), 0
                while done < len(size):  # a shard ends with the document that fills it
                    begun = int(upto[done - 1]) if done else 0
                    stop = min(int(np.searchsorted(upto, begun + shard_ids - held)) + 1, len(size))
                    ids += doc_ids[done:stop]
                    codes.append(code[begun:upto[stop - 1]])
                    sizes.append(size[done:stop])
                    held += len(codes[-1])
                    done = stop
                    if held >= shard_ids:
                        yield flush()
                        ids, codes, sizes, held, number = [], [], [], 0, number + 1
        if ids:
            yield flush()
        ids, codes, sizes = [], [], []
        release_memory()
    return run


def write_token_shards(docs: DataFrame, path: str, tokenizer_path: str | None = None, shard_ids: int = SHARD_IDS) -> None:
    """Encode every row of ``docs`` (doc_id, text) and write shards to ``path`` in ascending order of doc_id.

    Null texts count as empty: they hold the end id alone. Rows that repeat a doc_id
    follow each other, ordered by their text's hash; null ids come first. An empty
    table gives no shard.
    """
    small_batches(docs.sparkSession)
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    src = src.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    shards = src.mapInArrow(_shards(tokenizer_json(tokenizer_path), shard_ids), "part int, shard int, n_ids long, blob binary")
    shards.write.mode("overwrite").parquet(path)


def read_token_shards(spark, path: str) -> DataFrame:
    """One row per document from the shards: doc_id, part, shard, nth, at (ids before it in the shard), n_tokens, ids_crc32."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reuse_memory()
        for b in batches:
            for part, number, blob in zip(b.part, b.shard, b.blob):
                shard = Shard(blob)
                n = shard.lengths.astype(np.int64)
                at = np.concatenate([[0], np.cumsum(n)[:-1]])
                ids = memoryview(shard.ids().astype("<u4").tobytes())
                crc = [zlib.crc32(ids[4 * a:4 * (a + x)]) for a, x in zip(at.tolist(), n.tolist())]
                yield pd.DataFrame({"doc_id": pd.array(shard.doc_ids, dtype="Int64"), "part": part, "shard": number,
                                    "nth": np.arange(len(n)), "at": at, "n_tokens": n, "ids_crc32": crc})
        release_memory()

    return spark.read.parquet(path).select("part", "shard", "blob").mapInPandas(
        run, "doc_id long, part int, shard int, nth long, at long, n_tokens long, ids_crc32 long")


def token_index(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the shards at ``path``.

    Offsets: sums per part, then per shard in its part.
    """
    sizes = spark.read.parquet(path).select("part", "shard", "n_ids")
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    parts = parts.select("part", before(Window.orderBy("part")).alias("part_at"))
    shards = sizes.select("part", "shard", before(Window.partitionBy("part").orderBy("shard")).alias("shard_at")).join(parts, "part")
    out = read_token_shards(spark, path).join(shards, ["part", "shard"])
    return out.select("doc_id", (F.col("part_at") + F.col("shard_at") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "part", "shard", "nth")


def op8_repair_token_shards(spark, sf_dir):
    """All documents as token shards, read back."""
    path = session_scratch(spark, "token-shards")
    write_token_shards(documents(spark, sf_dir), path)
    return token_index(spark, path)

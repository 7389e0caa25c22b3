"""SentencePiece encoding and decoding by a streaming Viterbi pass.

For a model of merges, the encoding of a prefix ends in exactly one piece: the piece
whose predecessor, the last piece of the shorter prefix, may stand before it (the
two, joined and merged by the model's rules, stay the same two pieces). So the
lattice has one surviving backpointer per position, allowed transitions take the
place of summed scores, and the result is the model's own encoding. (A plain sum of
the scores, which are ranks of merges here, gives other ids than the library.)

The pass keeps a window of positions, bounded by the longest piece. Whenever the
backpointers of all positions in it lead through one boundary, the ids before it are
committed and forgotten, so texts of any length run in bounded memory. Encodings of
words are remembered: no piece reaches over the space before a word.

Runs of spaces, whose pieces share one score, are merged directly. One pass over the
texts, no shuffle; the model is read on the driver and sent along with the function.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salaria.llm.rows import documents, release_memory, small_batches
from salaria.llm.words import WordMemory

SPACE = "▁"
#: Words remembered (twice as many at most), their greatest length, and pairs of pieces remembered, per worker.
MEMORY, SHORT, PAIRS = 800_000, 40, 300_000
#: The same in the pipeline, whose executors hold more besides.
STAGE_MEMORY = 200_000
#: Characters of texts that are encoded together, and come out as one batch.
CHUNK = 2_000_000


def model_bytes(path: str | None = None) -> bytes:
    """The model file; by default the public 32k one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


class Pieces:
    """A merge model: encode to ids and back. ``window``: positions kept, at least the longest piece."""

    def __init__(self, raw: bytes, window: int | None = None, memory: int = MEMORY):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto.FromString(raw)
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or model.normalizer_spec.precompiled_charsmap:
            raise ValueError("a merge model without character normalisation is needed")
        kinds = proto.ModelProto.SentencePiece
        self.prefix = model.normalizer_spec.add_dummy_prefix
        self.ids = {p.piece: k for k, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.bytes = {int(p.piece[3:5], 16): k for k, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.unknown = next(k for k, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        self.longest = max(map(len, self.ids))
        self.window = max(self.longest, window or 0)
        self.reach: dict[str, int] = {}
        for p in self.ids:
            self.reach[p[-3:]] = max(len(p), self.reach.get(p[-3:], 2))
        crossing = [p for p in self.ids if SPACE in p.lstrip(SPACE)]
        if crossing or any("\n" in p for p in self.ids):
            raise ValueError("pieces over word ends are not supported")
        self.stretches = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        self.surface = {k: p.replace(SPACE, " ") for p, k in self.ids.items()}
        self.surface |= {k: chr(b) if b < 0x80 else chr(0xDC00 + b) for b, k in self.bytes.items()}
        # Long runs of spaces: the leftmost are joined to the longest such piece first, over and over.
        self.run = max((len(p) for p in self.ids if not p.strip(SPACE)), default=1)
        self.runs_repeat = self.merged(SPACE * 3 * self.run) == [SPACE * self.run] * 3
        self.codes = {p: k.to_bytes(4, "little") for p, k in self.ids.items()}
        self.memory = WordMemory(memory)
        self.parts: dict[str, bytes] = {}
        self.edges: dict[str, tuple] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """The model's rule itself: join the best-scored pair, the leftmost first, until none is a piece."""
        return [t[0] for t in self._trees(text)]

    def _trees(self, text: str) -> list[tuple]:
        """``merged`` as trees: (piece, left part or None, right part or None)."""
        parts, score = [(c, None, None) for c in text], self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k][0] + parts[k + 1][0])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            x, y = parts[at:at + 2]
            parts[at:at + 2] = [(x[0] + y[0], x, y)]
        return parts

    def _edge_parts(self, piece: str) -> tuple[list, list] | None:
        """Parts of ``piece`` at its left and right end, each with the score at which it is joined away; None
        if the rule does not make the piece from its characters."""
        if piece not in self.edges:
            trees = self._trees(piece)
            if len(trees) > 1:
                self.edges[piece] = None
            else:
                sides = []
                for side in (1, 2):
                    node, joined, parts = trees[0], float("-inf"), []
                    while node is not None:
                        parts.append((node[0], joined))
                        joined, node = self.score.get(node[0], 0.0), node[side]
                    sides.append(parts)
                self.edges[piece] = tuple(sides)
        return self.edges[piece]

    def _may_follow(self, a: str, b: str) -> bool:
        """Whether piece ``b`` may stand after ``a`` ('' at the start): no join over their border comes first.

        A part at the right end of ``a`` and one at the left end of ``b`` are joined
        if their score beats those at which either is joined away within its own
        piece; of equal scores the leftmost join wins.
        """
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            own = self._edge_parts(b)
            found = own is not None
            if found and a:
                score = self.score.get
                found = not any((s := score(x + y)) is not None and s > gone_x and s >= gone_y
                                for x, gone_x in self._edge_parts(a)[1] for y, gone_y in own[0])
            self.pairs[a, b] = found
        return found

    def _code(self, piece: str) -> bytes:
        code = self.codes.get(piece)
        if code is not None:
            return code
        if not self.bytes:
            return self.unknown.to_bytes(4, "little")
        return b"".join(self.bytes[b].to_bytes(4, "little") for b in piece.encode())

    def viterbi(self, text: str) -> Iterator[str]:
        """The pieces of ``text``, committed as soon as all surviving paths agree on them."""
        last = {0: ""}  # position -> the piece that ends there
        start, ids, follows = 0, self.ids, self._may_follow
        for end in range(1, len(text) + 1):
            for size in range(min(self.longest, end - start), 0, -1):
                piece = text[end - size:end]
                if (size == 1 or piece in ids) and end - size in last and follows(last[end - size], piece):
                    last[end] = piece
                    break
            if end - start >= 2 * self.window:
                common = self._agreed(last, end)
                if common > start:
                    yield from self._trace(last, start, common)
                    start = common
                    last = {p: t for p, t in last.items() if p >= start}
        yield from self._trace(last, start, len(text))

    def _short(self, text: str, last: list[str] | None = None) -> list[str]:
        """``viterbi`` for a text no longer than the window: nothing is committed before its end.

        ``last``: the backpointers of a prefix of ``text``, which are extended.
        """
        last = [""] if last is None else last
        ids, pairs, reach = self.ids, self.pairs, self.reach
        for end in range(len(last), len(text) + 1):
            # No longer piece ends in these three characters.
            for start in range(max(0, end - reach.get(text[end - 3:end], 2)) if end > 2 else 0, end):
                piece = text[start:end]
                if piece in ids or start == end - 1:
                    pair = (last[start], piece)
                    if pairs[pair] if pair in pairs else self._may_follow(*pair):
                        last.append(piece)
                        break
        out, end = [], len(text)
        while end:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def _agreed(self, last: dict[int, str], end: int) -> int:
        """The latest boundary through which the paths of all positions a piece can still start from lead."""
        live = {p for p in range(end - self.longest + 1, end + 1) if p in last}
        while len(live) > 1:
            p = max(live)
            live.remove(p)
            if p - len(last[p]) < min(last):
                return min(last)
            live.add(p - len(last[p]))
        return live.pop()

    @staticmethod
    def _trace(last: dict[int, str], start: int, end: int) -> list[str]:
        out = []
        while end > start:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def _stretch(self, text: str) -> bytes:
        if text.startswith(SPACE * 2):
            pieces = self._spaced(text)
        else:
            pieces = self._short(text) if len(text) <= SHORT else self.viterbi(text)
        return b"".join(map(self._code, pieces))

    def _spaced(self, text: str) -> list[str]:
        """A stretch that begins with several spaces; only the last of them can join the word behind."""
        spaces = len(text) - len(text.lstrip(SPACE))
        full = max(0, spaces // self.run - 2) if self.runs_repeat else 0
        rest = text[full * self.run:]
        head = len(rest) - len(rest.lstrip(SPACE))
        word = list(self.viterbi(rest[head - 1:])) if head < len(rest) else []
        if word and word[0] == SPACE or not word:
            return [SPACE * self.run] * full + self.merged(rest[:head]) + word[1:]
        return [SPACE * self.run] * full + self.merged(rest[:head - 1]) + word

    def encode(self, text: str) -> np.ndarray:
        """ids as unsigned 32-bit integers; none for an empty text."""
        return np.frombuffer(self.encode_bytes(text), "<u4")

    def encode_bytes(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """ids of each text as little-endian unsigned 32-bit integers."""
        # One space before every word: the word alone decides its stretch.
        plain = [bool(self.prefix and t and SPACE not in t and "  " not in t and t[0] != " " and t[-1] != " ") for t in texts]
        # Texts of another kind count as one empty word, and are encoded stretch by stretch.
        entries, offsets = self.memory.words(pa.array([t if p else "" for t, p in zip(texts, plain)], pa.string()), self._learn)
        passing = self.memory.mark()
        others = [k for k, p in enumerate(plain) if not p]
        if others:
            codes = [self._stretches((SPACE if self.prefix else "") + texts[k].replace(" ", SPACE)) if texts[k] else b"" for k in others]
            entries[offsets[others]] = self.memory.add(np.frombuffer(b"".join(codes), "<u4"), np.array([len(c) // 4 for c in codes]))
        ids, sizes = self.memory.gather_lists(entries, offsets)
        self.memory.forget_since(passing)
        raw, upto = memoryview(ids.astype("<u4").tobytes()), np.cumsum(4 * sizes)
        return [bytes(raw[b - 4 * n:b]) for b, n in zip(upto.tolist(), sizes.tolist())]

    def _stretches(self, text: str) -> bytes:
        return b"".join(map(self._stretch, self.stretches.findall(text)))

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encode words in sorted order: each starts from the backpointers of what it shares with the one before."""
        codes, before, last, line = [b""] * len(words), "", [""], self._code("\n")
        if len(self.parts) >= PAIRS:
            self.parts.clear()
        for k in sorted(range(len(words)), key=words.__getitem__):
            w = words[k]
            if "\n" in w:
                first, *rest = w.split("\n")
                codes[k] = b"".join([self._part(first, SPACE + first), *(self._part(SPACE + x, x, line) for x in rest)])
            elif len(w) >= SHORT:
                codes[k] = self._stretch(SPACE + w)
            elif w:
                text = SPACE + w
                same, most = 0, min(len(before), len(text))
                while same < most and before[same] == text[same]:
                    same += 1
                del last[same + 1:]
                codes[k] = b"".join(map(self._code, self._short(text, last)))
                before = text
        return np.frombuffer(b"".join(codes), "<u4"), np.array([len(c) // 4 for c in codes], np.int64)

    def _part(self, key: str, stretch: str, before: bytes = b"") -> bytes:
        """A stretch of a word that holds line ends, behind ``before``."""
        code = self.parts.get(key)
        if code is None:
            code = before + (self._stretch(stretch) if stretch else b"")
            if len(key) < SHORT:
                self.parts[key] = code
        return code

    def decode(self, ids) -> str:
        """The text of ``ids``; broken byte sequences become U+FFFD."""
        out = "".join(map(self.surface.__getitem__, ids))
        if self.prefix and out.startswith(" "):
            out = out[1:]
        try:
            out.encode()
            return out
        except UnicodeEncodeError:
            return out.encode("utf-8", "surrogateescape").decode("utf-8", "replace")


_MODELS: dict[tuple[int, int], Pieces] = {}


def _model(raw: bytes, memory: int) -> Pieces:
    """One per worker: what it remembers serves the worker's later tasks."""
    key = zlib.crc32(raw), memory
    if key not in _MODELS:
        _MODELS[key] = Pieces(raw, memory=memory)
    return _MODELS[key]


def _rows(raw: bytes, with_ids: bool, memory: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(raw, memory)

        def out(ids: list, texts: list[str]) -> pa.RecordBatch:
            codes = model.encode_batch(texts)
            numbers = [np.frombuffer(c, "<u4") for c in codes]
            columns = [pa.array(ids, pa.int64()), pa.array([len(n) for n in numbers], pa.int64()), pa.array(map(zlib.crc32, codes), pa.int64()),
                       pa.array([model.decode(n.tolist()) == t for n, t in zip(numbers, texts)], pa.bool_())]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum([len(n) for n in numbers])]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(codes), "<i4"))))
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_pieces", "ids_crc32", "round_trip", "ids"][:4 + with_ids])

        for batch in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(batch.column(0), batch.column(1)):
                ids.append(i.as_py())
                texts.append(t.as_py() or "")
                size += len(texts[-1])
                if size >= CHUNK:
                    yield out(ids, texts)
                    ids, texts, size = [], [], 0
            yield out(ids, texts)
        release_memory()
    return run


def encode_documents(docs: DataFrame, model_path: str | None = None, with_ids: bool = True, memory: int = MEMORY) -> DataFrame:
    """Every row of ``docs``: doc_id, n_pieces, ids_crc32 (of the ids as little-endian 32-bit integers), round_trip, ids.

    ``round_trip``: the ids decode to the text (false where a text holds U+2581, the
    model's sign for a space). Null and empty texts have no ids. Repeated rows come
    out alike; an empty table gives an empty result. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    kind = "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean" + (", ids array<int>" if with_ids else "")
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return src.mapInArrow(_rows(model_bytes(model_path), with_ids, memory), kind)


def op5_sentencepiece(spark, sf_dir):
    """All documents encoded and decoded, ids as digests."""
    return encode_documents(documents(spark, sf_dir), with_ids=False)


def pieces_stage(spark, docs, sf_dir):
    """Pipeline stage (the last): ids of every document."""
    return encode_documents(docs, memory=STAGE_MEMORY)

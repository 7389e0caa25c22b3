"""Toxicity scores: Levenshtein automata intersected with a lexicon trie, and context windows.

1. Lexicon: words that labelled toxic texts hold far more often than the others,
   counted on a bounded sample of labelled rows (``SAMPLE_ROWS``). A term occurs in ``LEAST_SHARE`` of the
   toxic texts at least, so there are at most 1 / ``LEAST_SHARE`` times as many as a toxic text has words.
2. Matching: the trie of the lexicon, run together with a Levenshtein automaton, is
   one automaton whose states are sets of (trie node, errors). It is determinised
   lazily while words pass; a word leaves it at the first character that no term
   allows. An error is a letter too many, missing or wrong, or two neighbours swapped: none in terms of up to four letters (short words
   are near too many others), one from ``ERRORS[0]`` letters on, two from ``ERRORS[1]`` on.
3. Context: a window of words round each hit tells abuse from quotation: quotation
   marks round the hit and words of reporting lower its weight.
4. Score: logistic regression on the weighted hits, fitted on the sample.

Scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from salaria.llm.jaccard_join import shingle_keys
from salaria.llm.rows import documents, release_memory, small_batches, table

SAMPLE_ROWS, WINDOW, CUT = 20_000, 8, 0.7
#: Letters of a term from which on it matches with one error, and with two.
ERRORS = (5, 8)
#: A hit with one error counts for so much of an exact one, until the sample teaches otherwise.
MISSPELLED = 0.5
#: A term occurs in this many toxic texts of the sample at least, and in this share of them.
LEAST_TEXTS, LEAST_SHARE, LEAST_LOG_ODDS = 3, 0.002, 3.0
TOKEN = r"\w+(?:[*@$!]+\w+)*"
QUOTES = "\"'“”„«»‘’‹›「」"
REPORTING = frozenset("word words term terms quote quoted quotes said says wrote writes called calls slur slurs insult insults "
                      "mot mots terme dit palabra palabras dijo dice wort wörter sagte sagt".split())
_FIND = re.compile(TOKEN)
#: States and words that a worker remembers.
_STATES, _WORDS = 30_000, 150_000


def _allowed(term: str) -> int:
    return sum(len(term) >= n for n in ERRORS)


class FuzzyTrie:
    """The lexicon's trie intersected with Levenshtein automata (with swaps of neighbours), determinised lazily.

    ``match(word)`` gives (term number, errors) of the nearest term, or None. Up to 3 errors. A state is a set of
    places, each with its least errors; a place is a node, or a node whose last two letters were met the other way round
    as far as the first of them.
    """

    def __init__(self, terms: list[str], errors: Callable[[str], int] = _allowed):
        self.children: list[dict[str, int]] = [{}]
        self.term, self.allowed = [None], [0]  # per node: the term that ends here, the errors that some term below allows
        self.before = [""]  # per node: the letter before its own
        self.own = {}
        for k, t in enumerate(terms):
            node, e = 0, errors(t)
            self.allowed[0] = max(self.allowed[0], e)
            for at, ch in enumerate(t):
                nxt = self.children[node].get(ch)
                if nxt is None:
                    nxt = self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.allowed.append(0)
                    self.before.append(t[at - 1] if at else "")
                node = nxt
                self.allowed[node] = max(self.allowed[node], e)
            self.term[node] = k
            self.own[node] = e
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.sets: list[bytes] = []  # 4 * place + errors of each member, packed; place: 2 * node, plus 1 within a swap
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.known: dict[str, tuple[int, int] | None] = {}
        self.start = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """The state for places with their least errors, closed under skipped term letters; -1 for none."""
        todo = [(p >> 1, e) for p, e in reached.items() if not p & 1]
        while todo:
            node, e = todo.pop()
            for child in self.children[node].values():
                if e + 1 <= self.allowed[child] and e + 1 < reached.get(2 * child, 99):
                    reached[2 * child] = e + 1
                    todo.append((child, e + 1))
        if not reached:
            return -1
        key = array("I", sorted(4 * p + e for p, e in reached.items())).tobytes()
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            ends = [(e, self.term[p >> 1]) for p, e in reached.items() if not p & 1 and self.term[p >> 1] is not None and e <= self.own[p >> 1]]
            self.accepts.append(min(ends)[::-1] if ends else None)
        return self.ids[key]

    def _move(self, state: int, ch: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, e: int, swapping: int = 0) -> None:
            if e <= self.allowed[node] and e < reached.get(2 * node + swapping, 99):
                reached[2 * node + swapping] = e

        for place, e in (divmod(x, 4) for x in array("I", self.sets[state])):
            node = place >> 1
            if place & 1:
                if ch == self.before[node]:
                    reach(node, e)
                continue
            reach(node, e + 1)
            for letter, child in self.children[node].items():
                reach(child, e if letter == ch else e + 1)
                second = self.children[child].get(ch)
                if second is not None and letter != ch:
                    reach(second, e + 1, 1)
        self.moves[state][ch] = nxt = self._state(reached)
        return nxt

    def _walk(self, word: str) -> tuple[int, int] | None:
        state = self.start
        for ch in word:
            nxt = self.moves[state].get(ch)
            if nxt is None:
                nxt = self._move(state, ch)
            if nxt < 0:
                return None
            state = nxt
        return self.accepts[state]

    def match(self, word: str) -> tuple[int, int] | None:
        try:
            return self.known[word]
        except KeyError:
            if len(self.sets) > _STATES or len(self.known) > _WORDS:
                self._reset()
            found = self.known[word] = self._walk(word)
            return found


def context_weight(text: str, start: int, end: int, words: list[str], at: int) -> float:
    """1 for plain use; less where the hit is quoted, or reported in the window round it."""
    near = text[max(0, start - 40):start], text[end:end + 40]
    opened, closed = (any(q in part for q in QUOTES if q != "'") or f" '" in f" {part}" or "' " in f"{part} " for part in near)
    weight = 0.25 if opened and closed else 1.0
    if any(w in REPORTING for w in words[max(0, at - WINDOW):at + WINDOW + 1]):
        weight *= 0.5
    return weight


def features(text: str | None, trie: FuzzyTrie, weights: list[float]) -> list[float]:
    """Of the whole text: log(1 + mass) of hits as abuse, of hits as quotation and of misspelled hits, the plainest hit, and log(1 + mass) of
    hits with more than one error.

    The mass of a hit is its term's log odds; one with an error counts in part. The
    third feature lets the regression correct that part where the sample shows it. Hits with more errors count
    by the last feature alone: for as much as they tell in the sample, where another word may be as near.
    """
    low = (text or "").lower()
    words = _FIND.findall(low)
    match = trie.match
    hits = {w: m for w in set(words) if (m := match(w)) is not None}
    abuse = quoted = misspelled = plain = far = 0.0
    if hits:
        for at, m in enumerate(_FIND.finditer(low)):
            hit = hits.get(m.group())
            if hit is not None:
                c = context_weight(low, m.start(), m.end(), words, at)
                if hit[1] > 1:
                    far += c * weights[hit[0]]
                    continue
                part = MISSPELLED if hit[1] else 1.0
                abuse += part * c * weights[hit[0]]
                quoted += part * (1 - c) * weights[hit[0]]
                misspelled += c * weights[hit[0]] * (hit[1] > 0)
                plain = max(plain, part * c)
    return [math.log1p(abuse), math.log1p(quoted), math.log1p(misspelled), plain, math.log1p(far)]


FEATURES = 5


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.05, steps: int = 60) -> np.ndarray:
    """Weights and, last, the intercept, by Newton steps with a ridge penalty."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = penalty * np.diag([*[1.0] * (x.shape[1] - 1), 1e-3])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


@F.pandas_udf(LongType())
def _sketch(text: pd.Series) -> pd.Series:
    """The least shingle key: near copies mostly share it."""
    return pd.Series([int(k[0] >> np.uint64(1)) if len(k := shingle_keys(t)) else 0 for t in text], dtype="int64")


class Scorer:
    """A fitted lexicon and its regression: small, closed over by the scoring function."""

    def __init__(self, terms: list[str], weights: list[float], coefficients: np.ndarray):
        self.terms, self.weights, self.coefficients = terms, weights, coefficients

    def column(self, text: Column) -> Column:
        terms, weights, w = self.terms, self.weights, self.coefficients

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            trie = FuzzyTrie(terms)
            for texts in batches:
                x = np.array([features(t, trie, weights) for t in texts]).reshape(-1, FEATURES)
                yield pd.Series(1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30))))
            del trie
            release_memory()

        return score(text)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Scorer:
    """Learn from the labelled rows of ``docs`` (``labels``: doc_id, toxic); at most ``sample_rows`` of them, chosen by a hash of the id; of rows that
    repeat an id, the smallest text.

    Without toxic or without other rows in the sample, every text gets the share of toxic rows (0 without any).
    """
    small_batches(docs.sparkSession)
    known = labels.where(labels["toxic"].isNotNull() & labels["doc_id"].isNotNull()).groupBy(labels["doc_id"].alias("_id")).agg(F.max("toxic").alias("_toxic"))
    chosen = known.orderBy(F.xxhash64(F.lit(3), "_id"), "_id").limit(sample_rows)
    src = docs.select(docs["doc_id"].alias("_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    # One text per id: the sample is bounded also where rows repeat an id.
    drawn = src.join(F.broadcast(chosen), "_id").groupBy("_id", "_toxic").agg(F.min("text").alias("text"))
    sample = table(drawn.select("_id", "text", F.col("_toxic").cast("double").alias("y"), _sketch("text").alias("_sketch")), "toxicity-sample")
    apart = sample.groupBy("_sketch", "y").agg(F.min(F.struct("_id", "text")).alias("r")).select("y", F.col("r.text").alias("text"))
    apart = table(apart, "toxicity-apart")
    n1, n0 = apart.agg(F.coalesce(F.sum("y"), F.lit(0.0)), F.coalesce(F.sum(1 - F.col("y")), F.lit(0.0))).first()
    if not n1 or not n0:
        bias = 30.0 if n1 else -30.0
        return Scorer([], [], np.array([0.0] * FEATURES + [bias]))
    words = apart.select("y", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(f"(?U){TOKEN}"), F.lit(0)))).alias("word"))
    odds = F.log((F.col("pos") + 0.5) / (n1 + 1)) - F.log((F.col("neg") + 0.5) / (n0 + 1))
    counted = words.groupBy("word").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).withColumn("odds", odds)
    terms = (counted.where((F.col("pos") >= max(LEAST_TEXTS, LEAST_SHARE * n1)) & (F.col("odds") >= LEAST_LOG_ODDS) & (F.length("word") > 2))
             .orderBy(F.desc("pos"), "word").collect())
    lexicon, weights = [r.word for r in terms], [float(r.odds) for r in terms]

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = FuzzyTrie(lexicon)
        for b in batches:
            yield pd.DataFrame([[*features(t, trie, weights), y] for t, y in zip(b.text, b.y)], columns=[*"abcde", "y"])

    rows = sample.select("text", "y").mapInPandas(extract, "a double, b double, c double, d double, e double, y double").toPandas()
    return Scorer(lexicon, weights, _logistic(rows[list("abcde")].to_numpy(float), rows.y.to_numpy(float)))


def _is_held_out(doc_id: Column) -> Column:
    """One third of the ids, by crc32 of the id as text; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _learned(docs: DataFrame, labels: DataFrame) -> Scorer:
    return fit(docs, labels.where(~_is_held_out(labels["doc_id"])))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs``: doc_id, held_out, score, predicted (1 if score >= 0.7).

    Null and empty texts have no hits and score the intercept. Repeated rows score
    alike. Labels of ids without a document, null labels and repeated labels (the
    greatest counts) are allowed. Empty tables give an empty result. Only the text
    reaches the score; other columns are ignored.
    """
    scorer = _learned(docs, labels)
    out = docs.select(docs["doc_id"].alias("doc_id"), _is_held_out(docs["doc_id"]).alias("held_out"), scorer.column(docs["text"]).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))


def op3_toxicity(spark, sf_dir):
    """Toxicity of all documents."""
    return score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def toxicity_stage(spark, docs, sf_dir):
    """Pipeline stage: documents that score under 0.7 stay, as they are."""
    scorer = _learned(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    return docs.where(scorer.column(docs["text"]) < CUT)

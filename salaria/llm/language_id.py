"""Language ID with string kernels, Nyström landmarks and one-versus-rest kernel ridge regression.

Kernel: blended spectrum of character n-grams (1 to 3), by presence:
K(x, y) = |X & Y| / sqrt(|X| |Y|). A bounded sample of labelled texts gives the
landmarks and the rows of the ridge regression in the Nyström feature space.
Everything after the kernel is linear, so a fitted model scores a text as its
presence vector times one matrix (n-grams of the landmarks by languages), over
sqrt(|X|): the same number as kernel row, Nyström map and regression one by one.
Texts are scored in batches by one matrix product, in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salaria.llm.rows import documents, small_batches

#: Per language: texts sampled at most, landmarks among them. Ridge penalty.
SAMPLE, LANDMARKS, RIDGE = 500, 32, 1e-2
#: Of a sampled text, so many characters at most are learned from (predictions read whole texts). Languages at most.
SAMPLE_CHARS, LANGUAGES = 20_000, 1_000
BATCH = 256
#: Texts of a batch are numbered densely while their n-grams' numbers stay below this; else n-grams are sorted. Both are exact.
DENSE = 1 << 24
#: Stands for a run of other characters, and for both ends of a text, among code points.
EDGE = 0x110000
_BITS = 21
_NO_LANGUAGE = "und"


def _letter_table() -> np.ndarray:
    """By code point: true for letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def spell(text: str, letters: np.ndarray) -> np.ndarray:
    """The lower-cased letters of a text as code points, with ``EDGE`` for each run of other characters and at both ends."""
    x = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    x = np.concatenate([[EDGE], np.where(letters[x], x, EDGE), [EDGE]]).astype(np.int64)
    return x[np.concatenate([[True], (x[1:] != EDGE) | (x[:-1] != EDGE)])]


def grams(x: np.ndarray, base: int | None = None) -> list[np.ndarray]:
    """The n-grams (1 to 3) of spelled letters, each a number of its own.

    Without ``base``: code points packed in 21 bits each (none is 0, so lengths stay apart). With it, ``x`` holds
    numbers below ``base`` with 0 for ``EDGE``, and n-grams of each length have a range of their own.
    """
    one = x[x != (EDGE if base is None else 0)]
    if base is None:
        two = x[:-1] << _BITS | x[1:]
        return [one, two, two[:-1] << _BITS | x[2:]]
    two = x[:-1] * base + x[1:]
    return [one, two + base, two[:-1] * base + x[2:] + base + base ** 2]


class Presence:
    """Which of some n-grams (packed, ascending) texts hold, and how many distinct n-grams each has."""

    def __init__(self, wanted: np.ndarray):
        self.letters, self.wanted = _letter_table(), wanted
        mask = (1 << _BITS) - 1
        self.parts = [wanted >> 2 * _BITS, wanted >> _BITS & mask, wanted & mask]
        self.number = np.zeros(EDGE + 1, np.int64)

    def __call__(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(texts by n-grams, distinct n-grams of each text; 0 for a text without letters)."""
        rows, sums = np.zeros((len(texts), len(self.wanted)), np.float32), np.zeros(len(texts))
        spelled = [(i, x) for i, x in ((i, spell(t, self.letters)) for i, t in enumerate(texts) if t) if len(x) > 1]
        met = np.zeros(EDGE + 1, bool)
        for _, x in spelled:
            met[x] = True
        met[EDGE] = False
        alphabet = np.flatnonzero(met)
        base = len(alphabet) + 1
        if base + base ** 2 + base ** 3 > DENSE:
            for i, x in spelled:
                own = np.unique(np.concatenate(grams(x)))
                at = np.searchsorted(self.wanted, own)
                at, hit = np.minimum(at, max(0, len(self.wanted) - 1)), len(self.wanted) > 0
                rows[i, at[self.wanted[at] == own] if hit else []] = 1
                sums[i] = len(own)
            return rows, sums
        self.number[:] = -1
        self.number[alphabet] = np.arange(1, base)
        self.number[EDGE] = 0
        # The wanted n-grams in these numbers; one with a letter that no text here has is in none of them.
        a, b, c = (self.number[p] for p in self.parts)
        length = 1 + (self.parts[1] > 0) + (self.parts[0] > 0)
        numbers = np.choose(length - 1, [c, b * base + c + base, (a * base + b) * base + c + base + base ** 2])
        possible = (c >= 0) & ((length < 2) | (b >= 0)) & ((length < 3) | (a >= 0))
        numbers = numbers[possible]
        seen = np.zeros(base + base ** 2 + base ** 3, bool)
        for i, x in spelled:
            own = grams(self.number[x], base)
            for g in own:
                seen[g] = True
            rows[i, possible] = seen[numbers]
            sums[i] = np.count_nonzero(seen)
            for g in own:
                seen[g] = False
        return rows, sums


class Model:
    """languages, grams (packed, ascending), matrix (grams by languages)."""

    def __init__(self, languages: list[str], wanted: np.ndarray, matrix: np.ndarray):
        self.languages, self.grams, self.matrix = languages, wanted, matrix

    def columns(self, text: Column) -> Column:
        """struct<lang_pred, score>; null texts and texts without a letter are ``und`` with score 0."""
        model = self

        @F.pandas_udf("struct<lang_pred:string,score:double>")
        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            presence = Presence(model.grams)
            for texts in batches:
                langs, scores = [_NO_LANGUAGE] * len(texts), np.zeros(len(texts))
                for at in range(0, len(texts), BATCH):
                    if not len(model.languages):
                        continue
                    rows, sums = presence(texts.iloc[at:at + BATCH])
                    margins = (rows @ model.matrix) / np.sqrt(np.maximum(sums, 1))[:, None]
                    best = margins.argmax(axis=1)
                    for i in np.flatnonzero(sums):
                        langs[at + i] = model.languages[best[i]]
                        scores[at + i] = min(1.0, max(0.0, (float(margins[i, best[i]]) + 1) / 2))
                yield pd.DataFrame({"lang_pred": langs, "score": scores})

        return predict(text)


def train(texts: list[str], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on texts with letters. ``landmarks``: the first texts of each language."""
    letters = _letter_table()
    languages = sorted(set(labels))
    chosen = sorted(i for lang in languages for i in [k for k, x in enumerate(labels) if x == lang][:landmarks])
    wanted = np.unique(np.concatenate([g for i in chosen for g in grams(spell(texts[i], letters))]))
    presence = Presence(wanted)
    found = [presence(texts[at:at + BATCH]) for at in range(0, len(texts), BATCH)]
    rows, sums = np.concatenate([r for r, _ in found]), np.concatenate([n for _, n in found])
    rows = rows / np.sqrt(np.maximum(sums, 1))[:, None]
    marks = rows[chosen]
    kernel = marks @ marks.T
    values, vectors = np.linalg.eigh(kernel.astype(float))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])  # landmarks by features
    phi = (rows @ marks.T) @ root
    target = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    weights = np.linalg.solve(phi.T @ phi + ridge * np.eye(phi.shape[1]), phi.T @ target)
    return Model(languages, wanted, (marks.T @ (root @ weights)).astype(np.float32))


def _is_held_out(doc_id: Column) -> Column:
    """One fifth of the ids, by crc32 of the id as text; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Learn from rows with text and lang that are not held out: the ``sample`` of each language with the smallest hash of id and text.

    So the sample is bounded, in rows and in characters of each, and reproducible; the bound is applied before the
    shuffle, too. Rows that share an id are drawn by their texts. Without such rows the model knows no language;
    more than ``LANGUAGES`` languages are refused.
    """
    src = docs.select(docs["text"].alias("text"), docs["lang"].alias("lang"), F.xxhash64(F.lit(4), docs["doc_id"], docs["text"]).alias("draw"),
                      docs["doc_id"].alias("doc_id"))
    src = src.where(src["lang"].isNotNull() & src["text"].rlike(r"\p{L}") & ~_is_held_out(src["doc_id"]))
    src = src.select("lang", "draw", F.substring("text", 1, sample_chars).alias("text"))
    drawn = src.withColumn("_place", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))).where(F.col("_place") <= sample)
    rows = drawn.where("_place = 1").limit(LANGUAGES + 1).count()
    if rows > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    rows = [r for r in drawn.select("lang", "draw", "text").orderBy("draw", "lang", "text").collect() if any(map(str.isalpha, r.text.lower()))]
    if not rows:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32))
    return train([r.text for r in rows], [r.lang for r in rows])


def predict_languages(docs: DataFrame) -> DataFrame:
    """Every row of ``docs``: doc_id, held_out, lang_pred (a learned language, or ``und``), score (0 to 1).

    Null texts, empty texts and texts without a letter are ``und`` with score 0, and
    so is every text if there is nothing to learn from. Repeated rows come out alike;
    an empty table gives an empty result. Only the text reaches a prediction.
    """
    small_batches(docs.sparkSession)
    found = fit(docs).columns(docs["text"]).alias("_found")
    out = docs.select(docs["doc_id"].alias("doc_id"), _is_held_out(docs["doc_id"]).alias("held_out"), found)
    return out.select("doc_id", "held_out", "_found.*")


def op4_language_id(spark, sf_dir):
    """Languages of all documents."""
    return predict_languages(documents(spark, sf_dir))

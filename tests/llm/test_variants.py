import random
import re
import zlib
from collections import Counter

import pytest

from salaria.llm.variants import near_pairs, op13_spelling_variants, spelling_variants, word_counts
from tests_llm_data import awkward


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_counts(rows, letters=7, occurrences=2, drop=31):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode("utf-8"))
            if h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= letters and n >= occurrences}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words, times=10):
    near = {w: [v for v in words if abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= times * words[w]}
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


def result(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def vocabulary(seed, letters, n, least=1, most=9):
    rng = random.Random(seed)
    words = {}
    for _ in range(n):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(least, most)))
        words[w] = 3 ** rng.randint(0, 9)
        cut = rng.randrange(len(w))
        for v in (w[:cut] + w[cut + 1:], w[:cut] + rng.choice(letters) + w[cut:], w[:cut] + rng.choice(letters) + w[cut + 1:]):
            if v:
                words.setdefault(v, 3 ** rng.randint(0, 9))
    return words


@pytest.mark.parametrize("seed,letters,least,most", [(1, "ab", 1, 9), (2, "abcé÷", 4, 12), (3, "aÿ", 9, 14)])
def test_pairs_and_forms_equal_brute_force(spark, seed, letters, least, most):
    words = vocabulary(seed, letters, 120, least, most)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = [(r.word, r.near) for r in near_pairs(df).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if one_edit(a, b)}
    assert result(spelling_variants(df)) == brute(words)


def test_every_place_of_the_edit_is_found(spark):
    word = "abcdefghijklm"
    words = {word[:n]: 1 for n in range(7, 14)}
    for n in range(7, 14):
        w = word[:n]
        words |= {v: 1 for i in range(n + 1) for v in (w[:i] + "z" + w[i:], w[:i] + "y" + w[i + 1:], w[:i] + w[i + 1:]) if len(v) >= 6}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {(r.word, r.near) for r in near_pairs(df).collect()} == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_long_way_to_the_root_and_ties(spark):
    chain = ["abcdefgh" + "x" * k for k in range(8)]
    words = {w: 10 ** k for k, w in enumerate(chain)}
    words |= {"tiedwordsa": 100, "tiedwordsb": 100, "tiedwords": 10, "tiedwordsç": 100, "lonelyword": 5, "almostform": 99, "almostforms": 10}
    got = result(spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute(words)
    roots = {w: r for w, _, r, _, _, _ in got}
    assert roots[chain[0]] == chain[-1] and roots["lonelyword"] == "lonelyword"
    assert {w: f for w, f, *_ in got}["tiedwords"] == "tiedwordsa" and {w: f for w, f, *_ in got}["almostforms"] is None


def test_counts_equal_brute_force(spark, frame, monkeypatch):
    rng = random.Random(7)
    rows = awkward(3) + [(500, "Überraschung ÜBERRASCHUNG naïveté×÷ø Übung", "de", "x"), (None, "Wordwide wordwide WORDWIDE", None, None), (501, "x" * 40_000 + " " + "x" * 40_000, None, None)]
    rows += [(k, " ".join(rng.choice(("Considerable", "understanding", "Größenordnung", "wordwide")) for _ in range(60)), "en", "x") for k in range(600, 640)]
    words = word_counts(frame(rows, extra=True), occurrences=2)
    assert {(r.word, r.n) for r in words.collect()} == set(brute_counts([r[:2] for r in rows]).items())
    got = result(spelling_variants(words))
    assert got == brute(brute_counts([r[:2] for r in rows])) and any(f for _, f, *_ in got)


def test_empty_and_refused(spark, frame):
    assert word_counts(frame([])).count() == 0
    assert spelling_variants(word_counts(frame([]))).count() == 0
    with pytest.raises(ValueError):
        spelling_variants(word_counts(frame([])), times=1)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = op13_spelling_variants(spark, sf)
    assert got.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert result(got) == brute(brute_counts(rows))

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from salaria.llm.best_position import ORACLE, ImpactLists, count_terms, op12_best_position_search, ranked_search
from tests_llm_data import awkward, prose

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    """(item, rank, doc, score) by the written rule, every document scored in full."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    total, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = defaultdict(set)
    for item, text in items:
        if item is not None and text is not None:
            asked[item] |= set(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, c, n in counted:
            m = 100 - 50 + (50 * n * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted & c.keys())
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def rows_of(df):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "own") for r in rows], "item_id long, text string, n string")


@pytest.mark.parametrize("k,postings", [(3, 40), (50, 2_000_000)])
def test_equals_brute_force(spark, frame, k, postings):
    rng = random.Random(k)
    rows = awkward(4) + [(700, "Ünïcode ünïcode Ü٣ x1-y2_z3", None, None), (701, "x" * 5000 + " " + "y1 " * 4000, None, None), (702, "...!", None, None)]
    items = [(i, prose(rng, 12)) for i in range(12)]
    items += [(20, rows[0][1]), (21, "X1 y2 Z3 ünïcode nowhere"), (22, ""), (23, None), (None, "kara"), (24, "kara"), (24, "lodel"), (25, "-- ..."), (26, "kara kara KARA")]
    got = rows_of(ranked_search(frame(rows, extra=True), items_of(spark, items), k=k, postings=postings))
    assert got == brute([r[:2] for r in rows], items, k) and len(got) > 3 * k


def test_blocks_of_items_give_the_same(spark, frame):
    rng = random.Random(9)
    rows, items = awkward(5), [(i, prose(rng, 8)) for i in range(30)]
    whole = rows_of(ranked_search(frame(rows), items_of(spark, items), k=5))
    assert rows_of(ranked_search(frame(rows), items_of(spark, items), k=5, block_bytes=500)) == whole == brute([r[:2] for r in rows], items, 5)


def test_empty_tables(spark, frame):
    some = frame([(1, "kara lodel", "en", "x")])
    assert ranked_search(frame([]), items_of(spark, [(1, "kara")])).count() == 0
    assert ranked_search(some, items_of(spark, [])).count() == 0
    assert ranked_search(some, items_of(spark, [(1, "other")])).count() == 0


def test_terms_of_texts_longer_than_a_piece():
    rng = random.Random(1)
    for _ in range(30):
        text = "".join(rng.choice("aZ9é٣ -_\n\x7f") for _ in range(rng.randint(0, 300)))
        assert count_terms(text.encode(), piece=7) == Counter(t.encode() for t in terms(text))


def lists(rng, docs, terms, draw):
    rows = sorted({(t, int(d)): draw(rng, t, d) for t in range(terms) for d in rng.choice(docs, rng.integers(1, docs), replace=False)}.items())
    term, doc, impact = (np.array(x) for x in zip(*((t, d, s) for (t, d), s in rows)))
    return ImpactLists(docs, term, doc, impact, terms), term, doc, impact


@pytest.mark.parametrize("seed", range(6))
def test_search_equals_full_scores_also_at_ties(seed):
    rng = np.random.default_rng(seed)
    index, term, doc, impact = lists(rng, 200, 6, lambda r, t, d: int(r.integers(1, 4)))  # many equal scores
    for _ in range(40):
        asked = rng.choice(6, rng.integers(1, 6), replace=False)
        weights = rng.integers(1, 4, len(asked))
        full = np.zeros(200, np.int64)
        for t, w in zip(asked, weights):
            np.add.at(full, doc[term == t], w * impact[term == t])
        order = [(int(full[d]), int(d)) for d in np.lexsort((np.arange(200), -full)) if full[d] > 0]
        for k in (1, 5, 300):
            assert index.best(asked, weights, k, step=2)[0] == order[:k]


def test_best_positions_spare_documents():
    """Where lists agree on their heads, the search ends before most documents have been met."""
    rng = np.random.default_rng(0)
    index, *_ = lists(rng, 4000, 4, lambda r, t, d: 1 + 100_000 // (1 + int(d)) + int(r.integers(0, 3)))
    found, looked_up = index.best(np.arange(4), np.ones(4, np.int64), 5)
    assert len(found) == 5 and looked_up < 800


def test_query_equals_oracle(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    got = op12_best_position_search(spark, sf)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert rows_of(got) == sorted(con.execute(ORACLE).fetchall()) == brute(docs, items, 50)

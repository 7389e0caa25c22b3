import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from salaria.llm.mixing import (REPEATS, SHARE, WEIGHTS, block_pieces, mix_documents, mix_slots, mix_taken, mixed, permuted, shard_counts,
                                source_targets, stream_rows)
from tests_llm_data import awkward, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def size(text):
    return len(WORD.findall(text or ""))


def targets(sizes):
    """The contract's own procedure: share by weight, cut at the limit, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[k % len(WEIGHTS)] for k, s in enumerate(order)}
    total, fixed = SHARE * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > REPEATS * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * level for s in free}
        fixed |= {s: REPEATS * sizes[s] for s in over}


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation_is_one(spark, n):
    for seed in (1, 2):
        got = spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(seed)).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


def test_targets_sizes_and_limits(frame):
    rows = awkward(3, docs=150)
    got = mix_taken(frame(rows, extra=True), block_words=16).collect()
    assert sorted(((r.doc_id, r.size) for r in got), key=repr) == sorted(((r[0], size(r[1])) for r in rows), key=repr)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r[1])
    want, taken = targets(sizes), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 32 + 0.01 * want[s]


def test_reruns_agree_and_do_not_depend_on_row_order(frame):
    rows = awkward(4)
    one = sorted((tuple(r) for r in mix_taken(frame(rows)).collect()), key=repr)
    two = sorted((tuple(r) for r in mix_taken(frame(rows[::-1]).repartition(5)).collect()), key=repr)
    assert one == two


def test_blocks_are_taken_by_exact_permutations(frame):
    stream, sources, slots = mixed(frame(awkward(5, docs=100)), block_words=8)
    quota = {r.grp: (r.quota, r.blocks) for r in sources.collect()}
    times = defaultdict(lambda: defaultdict(int))
    seen = set()
    for r in slots.collect():
        assert (r.grp, r["pass"], r.block) not in seen
        seen.add((r.grp, r["pass"], r.block))
        times[r.grp][r.block] += 1
    for grp, (q, blocks) in quota.items():
        assert sum(times[grp].values()) == q
        assert all(0 <= b < blocks for b in times[grp])
        if q:
            assert set(times[grp][b] for b in range(blocks)) <= {q // blocks, q // blocks + 1}
    pieces = block_pieces(stream, 8).groupBy("grp", "block").agg(F.sum("n_words").alias("n")).collect()
    assert all(r.n <= 8 for r in pieces)


def test_shard_counts_follow_the_quotas(frame):
    rows = [(i, prose(__import__("random").Random(i), 50), None, "abc"[i % 3]) for i in range(200)]
    sources = source_targets(stream_rows(frame(rows)), block_words=2)
    slots = mix_slots(sources, shard_slots=500)
    share = {r.grp: r.quota for r in sources.collect()}
    total = sum(share.values())
    counts = defaultdict(dict)
    for r in shard_counts(slots).collect():
        counts[r.shard][r.grp] = r.slots
    for shard, own in counts.items():
        n = sum(own.values())
        for grp, q in share.items():
            assert abs(own.get(grp, 0) - n * q / total) <= 5 * (n * 0.25) ** 0.5


def test_mixed_documents_hold_the_taken_words(frame):
    rows = awkward(6)
    docs = frame(rows, extra=True)
    out = mix_documents(docs, block_words=16)
    assert out.columns == docs.columns
    taken = defaultdict(int)
    for r in mix_taken(docs, block_words=16).collect():
        taken[r.doc_id, r.size] += r.taken
    got = defaultdict(int)
    known = defaultdict(set)
    for i, t, _, _ in rows:
        known[i].add(t)
    for r in out.collect():
        assert r.n_chars == len(r.text)
        source = next(t for t in known[r.doc_id] if t and all(w in t for w in WORD.findall(r.text)))
        assert size(r.text) <= size(source)
        got[r.doc_id, size(source)] += size(r.text)
    assert got == {k: v for k, v in taken.items() if v}


def test_many_small_sources_meet_their_targets(frame):
    rng = __import__("random").Random(12)
    rows = [(i, prose(rng, 20), None, f"site{i:05d}") for i in range(3000)] + [(5000 + i, "one two three", None, "tiny") for i in range(2)]
    rows.append((6000, prose(rng, 3000), None, "large"))
    got = mix_taken(frame(rows)).collect()
    want = targets({**{r[3]: size(r[1]) for r in rows}, "tiny": 6})
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert r.taken <= 2 * r.size
    assert abs(sum(taken.values()) - sum(want.values())) <= 0.02 * sum(want.values())
    assert all(abs(taken[s] - want[s]) <= 2 * max(1, size_ // 64) for s, size_ in (("large", 3000), ("tiny", 6), *((f"site{i:05d}", 20) for i in range(3000))))


@pytest.mark.parametrize("block_words", [8, 128])
def test_taken_equals_walking_the_slots(frame, block_words):
    """Words are counted one by one: each slot's block, word after word, in its source's stream."""
    rows = awkward(5, docs=100)
    stream, sources, slots = mixed(frame(rows), block_words=block_words)
    words = defaultdict(list)  # source: for each word of the stream, the place of its row
    for r in sorted(stream.collect(), key=lambda r: r.pos):
        assert r.before_size == len(words[r.grp])
        words[r.grp] += [r.pos] * r["size"]
    taken = defaultdict(int)
    for r in slots.collect():
        own = words[r.grp]
        length = min(block_words, max(1, len(own) // 64))
        for pos in own[r.block * length:(r.block + 1) * length]:
            taken[r.grp, pos] += 1
    place = {(r.grp, r.pos): (r.doc_id, r["size"]) for r in stream.collect()}
    want = sorted(((*place[k], taken[k]) for k in place), key=repr)
    assert sorted(((r.doc_id, r["size"], r.taken) for r in mix_taken(frame(rows), block_words=block_words).collect()), key=repr) == want


def test_without_words(frame):
    assert mix_taken(frame([])).count() == 0
    got = mix_taken(frame([(1, None, None, None), (2, "", None, "x"), (3, " \n", None, "x")])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 3
    assert mix_documents(frame([(1, None, None, None)])).count() == 0

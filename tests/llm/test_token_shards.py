import json
import random
import zlib

import numpy as np
import pytest

from salaria.llm import stretches, token_shards
from salaria.llm.token_shards import END, Encoder, Shard, pack_shard, repair, token_index, tokenizer_json, write_token_shards
from tests_llm_data import awkward, prose

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

PARTS = ["the", "  ", " ", " ", " ", "\n", "\t", "ing", "日本", "é", " é", "🙂", "don't", "'s", "123", "==", "<|endoftext|>", "\xa0", "　", "\r\n", "\x1c", "\x85"]


@pytest.fixture(scope="module")
def tokenizer():
    t = tokenizers.Tokenizer.from_str(tokenizer_json())
    t.encode_special_tokens = True
    return t


def ids(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4")


def test_encoder_equals_the_library(tokenizer, monkeypatch):
    monkeypatch.setattr(token_shards, "MEMORY", 50)  # forgets and learns again
    rng = random.Random(1)
    encoder = Encoder(tokenizer_json())
    for _ in range(30):
        texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 15))) for _ in range(100)]
        assert encoder.batch(texts) == [ids(tokenizer, t).tobytes() for t in texts]


@pytest.mark.parametrize("least", [2, 5])
def test_grammar_is_lossless_with_random_access(least):
    rng = random.Random(least)
    docs = [[rng.choice((1, 1, 2, 3, 4)) if rng.random() < 0.8 else 7 for _ in range(rng.randint(1, 120))] for _ in range(200)]
    seq = np.array([x for d in docs for x in d], np.uint32)
    ends = np.zeros(len(seq), bool)
    ends[np.cumsum([len(d) for d in docs]) - 1] = True
    rules, symbols, last = repair(seq, ends, 10, turns=6, least=least)
    assert len(symbols) < 0.7 * len(seq) and last.sum() == len(docs)

    def grow(s):
        return [s] if s < 10 else [x for part in rules[s - 10] for x in grow(int(part))]

    assert [x for s in symbols.tolist() for x in grow(s)] == seq.tolist()
    blob = pack_shard(list(range(len(docs))), [np.array(d, "<u4").tobytes() for d in docs], 50)
    shard = Shard(blob)
    assert shard.ids().tolist() == seq.tolist()
    for k, d in enumerate(docs):
        assert shard.document(k).tolist() == d
    for _ in range(100):
        a = rng.randint(0, len(seq))
        b = rng.randint(a, len(seq))
        assert shard.ids(a, b).tolist() == seq[a:b].tolist()


def test_random_access_walks_down_only_the_rules_it_needs(monkeypatch):
    rng = np.random.default_rng(4)
    phrases = [rng.integers(0, 5000, 12) for _ in range(300)]
    docs = [np.concatenate([phrases[k] for k in rng.integers(0, 300, 20)] + [[END]]).astype("<u4") for _ in range(1500)]
    seq, at = np.concatenate(docs), np.cumsum([0, *map(len, docs)])
    shard = Shard(pack_shard(list(range(1500)), [d.tobytes() for d in docs], 5000))
    assert len(shard.rules) > 2000
    walked, real = [], token_shards.needed_rules

    def spy(*args):
        walked.append(len(real(*args)))
        return real(*args)

    monkeypatch.setattr(token_shards, "needed_rules", spy)
    for k in (0, 7, 1499):
        assert (shard.document(k) == docs[k]).all()
        assert (shard.ids(int(at[k]) + 3, int(at[k]) + 8) == docs[k][3:8]).all()
    assert max(walked[::2]) <= 20 * 12 and max(walked[1::2]) <= 3 * 12 and min(walked) > 0  # a phrase of 12 ids takes 11 rules
    assert shard.ids(5, 5).tolist() == [] and (shard.ids() == seq).all() and walked[-1] == len(shard.rules)


def test_runs_of_one_id():
    for n in (1, 2, 3, 64, 1001):
        seq = np.full(n, 5, np.uint32)
        blob = pack_shard([None], [seq.tobytes()], 10)
        assert Shard(blob).ids().tolist() == [5] * n and Shard(blob).doc_ids == [None]


def test_files_hold_all_documents_in_order(spark, frame, tokenizer, tmp_path):
    rows = [r for r in awkward(6, docs=150) if r[0] is not None]
    path = f"{tmp_path}/shards"
    write_token_shards(frame(rows, extra=True), path, shard_ids=3000)
    got = token_index(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(r[0] for r in rows)
    at = 0
    left = [(r[0], r[1]) for r in rows]
    for r in got:
        code = {(i, t): np.append(ids(tokenizer, t), END).astype("<u4") for i, t in left if i == r.doc_id}
        match = next(k for k, c in code.items() if (len(c), zlib.crc32(c.tobytes())) == (r.n_tokens, r.ids_crc32))
        left.remove(match)
        assert r.start == at
        at += r.n_tokens
    assert not left
    assert spark.read.parquet(path).count() > 3


def test_null_ids_and_empty_table(spark, frame, tmp_path):
    write_token_shards(frame([(None, "x", None, None), (1, None, None, None)]), f"{tmp_path}/a")
    got = token_index(spark, f"{tmp_path}/a").orderBy("start").collect()
    assert [(r.doc_id, r.n_tokens) for r in got] == [(None, 2), (1, 1)]
    write_token_shards(frame([]), f"{tmp_path}/b")
    assert token_index(spark, f"{tmp_path}/b").count() == 0


def test_repeated_text_compresses(tokenizer):
    codes = [ids(tokenizer, prose(random.Random(k % 7), 200)).tobytes() for k in range(300)]
    assert len(pack_shard(list(range(300)), codes, tokenizer.get_vocab_size())) < 0.35 * sum(map(len, codes))


def test_grammar_ends_when_no_pair_is_frequent():
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 50_000, 500)
    docs = [np.concatenate([rng.integers(0, 300, rng.integers(0, 80)), passage if k % 3 else passage[:90], [9] * (k % 40), [END]]) for k in range(900)]
    seq = np.concatenate(docs).astype(np.uint32)
    ends = np.zeros(len(seq), bool)
    ends[np.cumsum([len(d) for d in docs]) - 1] = True
    rules, symbols, last = repair(seq, ends, 50_257)
    assert len(np.unique(rules, axis=0)) == len(rules)
    uses, free = {}, {}
    for k in np.flatnonzero(~last[:-1]).tolist():
        pair = int(symbols[k]), int(symbols[k + 1])
        if free.get(pair, 0) <= k:  # does not overlap the last one counted
            uses[pair], free[pair] = uses.get(pair, 0) + 1, k + 2
    assert max(uses.values()) < token_shards.LEAST
    assert token_shards.expansion_lengths(rules, 50_257).max() >= 500
    blob = pack_shard(list(range(900)), [d.astype("<u4").tobytes() for d in docs], 50_257)
    assert (Shard(blob).ids() == seq).all() and (Shard(blob).document(7) == docs[7]).all()


def test_added_tokens_as_in_the_plain_call(spark, frame, tmp_path):
    plain = tokenizers.Tokenizer.from_str(tokenizer_json())
    texts = ["one two<|endoftext|>three four", "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>\n x", "no mark here", "<|endoftext"]
    assert 50256 in ids(plain, texts[0])
    rng = random.Random(2)
    texts += ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 15))) for _ in range(300)]
    encoder = Encoder(tokenizer_json(), literal=False)
    assert encoder.batch(texts) == [ids(plain, t).tobytes() for t in texts]
    write_token_shards(frame([(k, t, None, None) for k, t in enumerate(texts)]), f"{tmp_path}/shards")
    want = [np.append(ids(plain, t), END).astype("<u4") for t in texts]
    got = token_index(spark, f"{tmp_path}/shards").orderBy("start").collect()
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == [(k, len(c), zlib.crc32(c.tobytes())) for k, c in enumerate(want)]


#: What may stand at a border: every kind of white space, marks, letters and digits of one to four bytes, the longest stretches kept.
BORDERS = [*stretches.SPACES, *" \n'’.,!_\x00\x7f…“aZ9ñ²٣日🙂̀Ⅷ", "'s", "'ll", "\r\n", "\n\n", "  ", "<|endoftext|>", "word", "x" * 15, "x" * 16, "\x00" * 32, "y" * 33]


@pytest.mark.parametrize("memory", [5, 5000])
def test_stretches_end_where_the_library_begins_a_word(memory, monkeypatch):
    monkeypatch.setattr(token_shards, "MEMORY", memory)
    plain = tokenizers.Tokenizer.from_str(tokenizer_json())
    encoder = Encoder(tokenizer_json(), literal=False)
    texts = [a + b + c for a in ("w", " ", "\n", ".") for b in BORDERS for c in BORDERS]
    rng = random.Random(memory)
    texts += ["".join(rng.choice(BORDERS) for _ in range(rng.randint(0, 20))) for _ in range(1000)]
    rng.shuffle(texts)
    for k in range(0, len(texts), 300):
        some = texts[k:k + 300]
        assert encoder.batch(some) == [ids(plain, t).tobytes() for t in some]


def test_the_library_sees_a_stretch_once(monkeypatch):
    encoder = Encoder(tokenizer_json(), literal=False)
    seen, real = [], encoder.whole
    monkeypatch.setattr(encoder, "whole", lambda texts: seen.extend(texts) or real(texts))
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)]
    for mark in ("", ",", ".", ";", "!?", ".\nSo"):
        text = "Now " + " ".join(w + mark for w in words)
        assert encoder.batch([text, text]) == [ids(encoder.tokenizer, text).tobytes()] * 2
    assert sum(map(len, seen)) < 1.2 * len("".join(" " + w for w in words))  # marks behind words make no new ones


def test_stretches_of_one_hash_are_told_apart(monkeypatch):
    real = stretches._integers
    monkeypatch.setattr(stretches, "_integers", lambda *a: (real(*a)[0], real(*a)[1] >> np.uint64(62) << np.uint64(62)))
    encoder = Encoder(tokenizer_json())
    texts = ["one two three, four", "two three five six seven, one", "x" * 20 + " " + "x" * 21, "x" * 16 + " " + "x" * 17 + " six"]
    for _ in range(3):
        assert encoder.batch(texts) == [ids(encoder.tokenizer, t).tobytes() for t in texts]


def test_another_way_to_find_words_is_not_cut():
    spec = json.loads(tokenizer_json())
    spec["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    encoder = Encoder(json.dumps(spec))
    texts = ["of the of the, of the.\nof the", "", "the the"]
    assert encoder.batch(texts) == [ids(encoder.tokenizer, t).tobytes() for t in texts]


def test_pairs_to_replace_neither_overlap_nor_leave_room():
    rng = np.random.default_rng(5)
    for n in (1, 2, 50, 500):
        places = np.flatnonzero(rng.random(2 * n) < 0.8)
        chosen = token_shards._apart(places, places + 1, rng.integers(0, 3, len(places)))
        taken = set(places[chosen].tolist())
        assert not any(p + 1 in taken for p in taken)
        assert all({p - 1, p, p + 1} & taken for p in places.tolist())
    assert token_shards._every_other(np.array([0, 1, 1, 1, 0, 0, 1, 0], bool)).tolist() == [True, False, True, False, True, True, False, True]

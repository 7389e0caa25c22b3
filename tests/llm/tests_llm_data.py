"""Small tables of documents with every awkward case, for all operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside; an input may have them as well.
CLASHING = ("size", "pos", "name", "fp", "block", "n", "idx", "key", "rank", "shard", "slot", "level", "score", "page", "keep_id", "a", "b", "row_fp", "_id", "_row")

WORDS = [a + b for a in ("ka", "lo", "mi", "ru", "te", "vo", "zan", "qui") for b in ("ra", "shin", "del", "to", "ble", "nge", "p", "ss")]


def prose(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(("", "", ",", ".")) for _ in range(words))


def awkward(seed: int = 0, docs: int = 60) -> list[tuple]:
    """Rows (doc_id, text, lang, source): copies, near copies, nulls everywhere, empty and long texts, repeated rows, one source with half of them."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.choice((1, 3, 5, 40, 80, 200))) for _ in range(docs)]
    base = prose(rng, 150).split()
    for k in range(12):
        near = list(base)
        for _ in range(k % 4):
            near[rng.randrange(len(near))] = f"edit{k}"
        texts.append(" ".join(near))
    texts += [texts[0]] * 5 + [texts[1].replace(" ", "\n\t ")] * 2 + ["", "", None, None, " ", "\n", prose(rng, 9000)]
    rows = [(i, t, rng.choice(("en", "de", None)), "hot" if i % 2 else rng.choice(("x", "y", "zé", None))) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (4, "another text under a known id", "en", "x"), (None, texts[5], None, None), (None, None, None, None)]
    rng.shuffle(rows)
    return rows

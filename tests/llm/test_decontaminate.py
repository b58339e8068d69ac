import random

import pytest
from pyspark.sql import functions as F

from terrapipe.llm.decontaminate import SEEDS, Block, contamination, overlaps, seed_hashes, tokens

RNG = random.Random(5)
VOCABULARY = [f"w{i}" for i in range(3000)]
ITEM = " ".join(RNG.choices(VOCABULARY, k=40))
NOISE = " ".join(RNG.choices(VOCABULARY, k=300))


def changed(text, places, by="other"):
    words = text.split()
    for p in places:
        words[p] = by
    return " ".join(words)


def test_tokens_ignore_case_and_edges():
    assert tokens('The "End"!').tolist() == tokens("the end").tolist()
    assert tokens("| . --").tolist() == tokens("--").tolist() and not len(tokens("")) and not len(tokens(" ... "))


def test_every_window_with_a_substitution_keeps_a_seed():
    words = tokens(" ".join(VOCABULARY[:16]))
    for place in range(16):
        other = words.copy()
        other[place] ^= 1
        assert any((seed_hashes(words, s, k) == seed_hashes(other, s, k)).any() for k, s in enumerate(SEEDS))


@pytest.mark.parametrize("text,held", [
    (ITEM, True), (f"{NOISE} {ITEM} {NOISE}", True), (ITEM.upper().replace(" ", "\n"), True),
    (f"{NOISE} {changed(ITEM, range(3, 40, 7))} {NOISE}", True), (changed(ITEM, range(0, 40, 4)), True),
    (" ".join(ITEM.split()[:24]), True), (" ".join(ITEM.split()[:9]), False), (NOISE, False), ("", False),
    (" ".join(RNG.sample(ITEM.split(), 40)), False)])
def test_one_item(text, held):
    block = Block.of([(1, ITEM)])
    assert bool(overlaps(tokens(text), block, 0.5, 10, 20)) == held


def brute(text, item, coverage=0.5, least=10, run=20):
    """The best diagonal that holds a seed, by comparing everything with everything."""
    a, b = tokens(text).tolist(), tokens(item).tolist()
    best = 0
    for shift in range(-len(b), len(a)):
        same = [k for k in range(len(b)) if 0 <= k + shift < len(a) and a[k + shift] == b[k]]
        if any(set(k + o for o in s) <= set(same) for s in SEEDS for k in same):
            best = max(best, len(same))
    return best if b and best >= min(run, max(min(least, len(b)), coverage * len(b))) else 0


def test_against_brute_force(spark):
    rng = random.Random(7)
    items = [(i, " ".join(rng.choices(VOCABULARY[:60], k=rng.randint(4, 40)))) for i in range(25)] + [(90, None), (91, ""), (None, ITEM), (0, None)]
    texts = []
    for k in range(120):
        parts = rng.choices(VOCABULARY[:60], k=rng.randint(0, 60))
        if k % 2:
            _, item = rng.choice(items[:25])
            words = item.split()
            for _ in range(rng.randint(0, len(words) // 3)):
                words[rng.randrange(len(words))] = "zz"
            parts[len(parts) // 2:len(parts) // 2] = words
        texts.append((k if k != 50 else None, " ".join(parts) if k != 60 else None, k))
    docs = spark.createDataFrame(texts, "doc_id long, text string, item_id int")
    benchmark = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    for block_tokens in (1 << 20, 50):
        got = sorted(repr((r.id, r.item_id, r.n_agree)) for r in contamination(docs, benchmark, block_tokens=block_tokens).collect())
        want = sorted(repr((i, k, n)) for i, t, _ in texts for k, item in items if (n := brute(t or "", item or "")))
        assert got == want and len(want) > 30


def test_words_repeated_on_both_sides(monkeypatch):
    from terrapipe.llm import decontaminate

    monkeypatch.setattr(decontaminate, "HITS", 100)
    text, item = "the " * 400 + ITEM, "the " * 60
    block = Block.of([(1, item), (2, ITEM)])
    assert [(f[0], f[3]) for f in overlaps(tokens(text), block, 0.5, 10, 20)] == [(0, 60), (1, 40)]


def test_empty_tables(documents, empty):
    bench = documents.select(F.lit(1).cast("long").alias("item_id"), "text").limit(0)
    assert contamination(documents, bench).collect() == []
    full = documents.select(F.lit(1).cast("long").alias("item_id"), "text")
    assert contamination(empty, full).collect() == []


def test_scattered_words_of_a_long_item_are_no_run():
    rng = random.Random(11)
    weights = [1 / (k + 1) for k in range(3000)]
    item, other = (rng.choices(VOCABULARY, weights, k=2000) for _ in range(2))
    other[700:705] = item[700:705]
    block = Block.of([(1, " ".join(item)), (2, ITEM)])
    assert sum(a == b for a, b in zip(item, other, strict=True)) >= 20
    assert overlaps(tokens(" ".join(other)), block, 0.5, 10, 20) == []
    assert [f[0] for f in overlaps(tokens(" ".join(other[:600] + item[900:925] + other[625:])), block, 0.5, 10, 20)] == [0]
    assert [f[0] for f in overlaps(tokens(" ".join(other[:600] + ITEM.split()[:25])), block, 0.5, 10, 20)] == [1]
    assert [f[0] for f in overlaps(tokens(changed(" ".join(item), range(0, 2000, 3))), block, 0.5, 10, 20)] == [0]

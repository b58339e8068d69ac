import collections
import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import WORDS
from terrapipe.llm import quality, toxicity
from terrapipe.llm.labelled import fit_logistic, probability
from terrapipe.llm.queries import QUERIES


def auc(scores, labels):
    scores, labels = np.array(scores), np.array(labels)
    above = scores[labels == 1][:, None] - scores[labels == 0][None]
    return float((above > 0).mean() + (above == 0).mean() / 2)


@pytest.fixture(scope="module")
def labelled(spark):
    """Ordinary texts of made-up words; toxic ones with a few marked words; bad ones of symbols."""
    rng = random.Random(1)
    syllables = "ka lo mi ren tas vor ul pe dis gan fro sti".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 3)))
    rows = []
    for i in range(400):
        words = [word() for _ in range(rng.randint(30, 120))]
        toxic, bad = i % 4 == 0, i % 5 == 0
        if toxic:
            for _ in range(rng.randint(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(["zoxbrat", "qwimpel", "yuckfas"]))
        rows.append((i, " ".join(w + "!!" if bad else w for w in words), int(not bad), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows], "doc_id long, quality int, toxic int")
    return docs, labels, {r[0]: r for r in rows}


def test_toxicity_held_out(labelled):
    docs, labels, rows = labelled
    model = toxicity.fit(docs, labels, where=labels.doc_id % 8 < 4)
    assert any("zoxbrat" in g for g in toxicity.distinctive([t for _, t, _, x in rows.values() if x], [t for _, t, _, x in rows.values() if not x]))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i in rows if i % 8 >= 4]
    assert auc([got[i] for i in held], [rows[i][3] for i in held]) > 0.97
    kept = {r.doc_id for r in toxicity.reject(docs, model, 0.5).collect()}
    assert kept == {i for i, s in got.items() if s < 0.5}


def test_toxicity_edges(labelled, documents, empty):
    docs, labels, _ = labelled
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(documents, model).collect()
    assert len(rows) == documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.reject(documents, model, 2.0).columns == documents.columns
    assert toxicity.score(empty, model).count() == 0
    one_kind = toxicity.fit(docs, labels.where("toxic = 0"))
    assert len({r.score for r in toxicity.score(documents, one_kind).collect()}) == 1
    assert max(r.score for r in toxicity.score(documents, toxicity.fit(docs, labels.limit(0))).collect()) < 1e-9


def brute_base(text):
    words = WORDS.findall(text)
    windows = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    repeat = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat),
            len(words) < 20 or 100 * len(repeat) > 30 * len(words))


def test_base_counts(documents):
    rng = random.Random(2)
    texts = [r.text or "" for r in documents.collect()] + ["".join(rng.choices(["a ", "b ", "\n", "# ", "é|", "\x85", "c d e f g h i j "], k=rng.randint(0, 90))) for _ in range(200)]
    for text in texts:
        assert quality.base(text, quality.Shape.of(text)) == brute_base(text)


def test_word_hashes_do_not_depend_on_place():
    shape = quality.Shape.of("äb x äb\tx x äb")
    assert shape.words[0] == shape.words[2] == shape.words[5] and len(set(shape.words.tolist())) == 2


def test_quality_held_out(labelled, documents, empty):
    docs, labels, rows = labelled
    model = quality.fit(docs, labels, where=labels.doc_id % 3 < 2)
    got = {r.doc_id: r for r in quality.judge(docs, model).collect()}
    held = [i for i in rows if i % 3 == 2]
    assert auc([got[i].quality for i in held], [rows[i][2] for i in held]) > 0.97
    assert all(r.kept == (not r.base_failed and r.quality >= 0.5) for r in got.values())
    out = quality.judge(documents, model).collect()
    assert len(out) == documents.count() and not any(r.kept for r in out if r.n_words == 0)
    assert quality.judge(empty, model).count() == 0
    assert len({r.quality for r in quality.judge(documents, quality.fit(docs, labels.limit(0))).collect()}) == 1


def test_logistic_recovers_weights():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    w = fit_logistic(x, y)
    assert np.allclose(w, [2, -1, 0.5], atol=0.25) and ((probability(x, w) > 0.5) == y).mean() > 0.75


def test_registered_queries(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    scores = QUERIES["op8_toxicity"](spark, sf).collect()
    assert len(scores) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in scores)
    held = [(r.score, labels[r.doc_id].toxic) for r in scores if r.held_out and r.doc_id in labels]
    assert auc(*zip(*held, strict=True)) > 0.75
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op9_quality"](spark, sf).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_base(texts[r.doc_id] or "")


def test_copies_vouch_once():
    from terrapipe.llm.labelled import without_copies

    rng = random.Random(4)
    rows = [(" ".join(f"w{rng.randrange(5000)}" for _ in range(200)), i % 2) for i in range(20)]
    copies = [(t + " tail", y) for t, y in rows[:5] for _ in range(30)]
    assert without_copies(rows) == rows
    assert without_copies(rows + copies) == rows
    assert without_copies([("", 0), ("", 1), ("one", 1), ("one two", 0)]) == [("", 0), ("one", 1), ("one two", 0)]

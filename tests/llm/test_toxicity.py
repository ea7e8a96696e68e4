import math

import pytest

from tesserae.llm import toxicity


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    return toxicity.train(spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet"))


def test_sentences_and_noisy_or(model):
    weights = toxicity.WordWeights(model)
    text = "Clean words here. You idiot! More\nthings?"
    found = toxicity.sentences(text, weights)
    assert [text[s:e].strip() for s, e, _ in found] == ["Clean words here", "You idiot", "More", "things"]
    assert max(found, key=lambda x: x[2])[:2] == (17, 27)
    logits = [z for *_, z in found]
    assert abs(toxicity.noisy_or(logits) - (1 - math.prod(1 - 1 / (1 + math.exp(-z)) for z in logits))) < 1e-9
    assert toxicity.noisy_or([]) == 0 and toxicity.noisy_or([800.0, -800.0]) == 1


def test_held_out(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    got = toxicity.op9_toxicity(spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in got)
    assert right / len(got) > 0.9


def test_rows(model, odd_docs, no_docs):
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] in (4, 5, 6)} == {0.0}
    assert toxicity.score(no_docs, model).count() == 0
    kept = toxicity.reject(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(r["score"] < toxicity.THRESHOLD for r in rows)


def test_training_without_labels(spark, odd_docs):
    for rows in ([], [(1, None, 0)], [(i, 0, 0) for i in range(9)], [(None, 1, 1)]):
        model = toxicity.train(odd_docs, spark.createDataFrame(rows, "doc_id long, toxic int, quality int"))
        assert not model.weights.any()


def test_labels_kept_back_are_not_used(spark, odd_docs):
    """Rows whose crc32 mod 3 is 1 never reach the training."""
    import zlib

    ids = [i for i in range(1, 13) if zlib.crc32(str(i).encode()) % 3 == 1]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids], "doc_id long, toxic int, quality int")
    assert not toxicity.train(odd_docs, labels).weights.any()


def test_long_texts_are_fitted_on():
    text = "You there. " * 20_000
    (words,), (sizes,) = (toxicity._bags({"doc_id": [1], "toxic": [1], "text": [text]})[c] for c in ("words", "sizes"))
    assert 0.8 < 11 * len(sizes) / toxicity.TRAIN_CHARS < 1.2 and len(words) == sum(sizes)
    (short,) = toxicity._bags({"doc_id": [1], "toxic": [1], "text": ["You there. " * 9]})["sizes"]
    assert len(short) == 9


def test_fit_finds_the_offending_word():
    """Brute force: of random bags, the label hangs on one word, and training gives it the largest weight."""
    import random

    import numpy as np

    rng = random.Random(2)
    docs = [[[rng.choice("abcdefghijklmnop") * 4 for _ in range(5)] for _ in range(4)] for _ in range(400)]
    y = [int(rng.random() < 0.5) for _ in docs]
    for d, label in zip(docs, y, strict=True):
        if label:
            d[rng.randrange(4)].append("qqqq")
    flat = [w for d in docs for s in d for w in dict.fromkeys(s)]
    vocabulary = sorted(set(flat))
    sizes = [len(dict.fromkeys(s)) for d in docs for s in d]
    model = toxicity.fit(np.array(y), np.full(len(docs), 4), np.array(sizes), np.array([vocabulary.index(w) for w in flat]), vocabulary)
    weights = toxicity.WordWeights(model)
    assert max(vocabulary, key=weights.__getitem__) == "qqqq"
    scores = [toxicity.noisy_or([z for *_, z in toxicity.sentences(". ".join(" ".join(s) for s in d), weights)]) for d in docs]
    assert sum((s >= 0.5) == bool(label) for s, label in zip(scores, y, strict=True)) > 390

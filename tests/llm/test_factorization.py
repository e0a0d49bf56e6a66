"""The machine's score against the double loop over pairs, and what it can learn."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from savora.llm import factorization as fz


@pytest.fixture(scope="module")
def machine():
    random_ = np.random.default_rng(2)
    design = fz.Design(word_bits=6, statistics=True, unit_length=True)
    slots = np.sort(random_.choice(design.slots, 300, replace=False))
    return fz.Machine(design, slots, -0.3, random_.normal(0, 0.4, 300), random_.normal(0, 0.4, (300, 5)))


def test_sum_of_squares_equals_the_double_loop(machine):
    texts = ["", " \n", "a", "a a A.", "some words, and 12 MORE!\n\nof a text", "x " * 50_000, "é ü ß 中文"]
    lengths = [None, 3, 1, 7, None, 100_000, 9]
    index = fz._index(machine)
    got = fz.scores(texts, lengths, machine, index)
    for text, length, score in zip(texts, lengths, got, strict=True):
        _, kept = fz.inputs([text], [length], machine.design, index)
        words = sum(machine.slots[k] < machine.design.word_slots for k in kept)
        x = [1 / math.sqrt(words) if machine.slots[k] < machine.design.word_slots else 1.0 for k in kept]
        z = machine.bias + sum(machine.w[k] * v for k, v in zip(kept, x, strict=True))
        for i in range(len(kept)):
            for j in range(i):
                z += float(machine.v[kept[i]] @ machine.v[kept[j]]) * x[i] * x[j]
        assert score == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-9)


def test_words_that_tell_only_together(spark):
    pick = random.Random(8)
    rows = []
    for i in range(1200):
        a, b = pick.random() < 0.5, pick.random() < 0.5
        words = [w for w, there in (("insult", a), ("group", b), ("calm", not a), ("thing", not b)) if there]
        words += [f"w{pick.randrange(3000)}" for _ in range(12)]
        pick.shuffle(words)
        rows.append((i, " ".join(words), int(a == b)))
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    made = fz.fit(df.drop("label"), df.where("doc_id < 800"), fz.TOXICITY)
    scored = fz.with_score(df.where("doc_id >= 800"), made)
    wrong = scored.where((F.col("score") >= 0.5) != (F.col("label") == 1)).count()
    assert wrong < 0.05 * 400


def test_edge_cases(spark):
    rows = [(1, None, None), (2, "", 0), (3, "same text", 9), (3, "same text", 9), (None, "same text", 9), (4, "long " * 400_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumns({c: F.lit("x") for c in ("label", "slots", "__id", "__score")})
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (2, None), (2, 0), (9, 5)], "doc_id long, label int")
    for design in (fz.QUALITY, fz.TOXICITY):
        made = fz.fit(df, labels, design)
        scored = fz.with_score(df, made)
        assert scored.columns == [*df.columns, "score"]
        got = [(r.doc_id, r.text, r.score) for r in scored.collect()]
        assert len(got) == len(rows) and all(0 <= s <= 1 for *_, s in got)
        assert len({s for _, t, s in got if t == "same text"}) == 1
        assert fz.keep_good(df, made).columns == df.columns
    with pytest.raises(ValueError, match="score"):
        fz.with_score(df.withColumn("score", F.lit(1)), made)

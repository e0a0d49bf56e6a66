"""Two tokenizers aligned, against encoding whole texts."""

import random
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from savora.llm import alignment, queries
from tests.llm import brute

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    t = Tokenizer.from_file(BYTE)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=PIECE)


def test_common_ends():
    pick = random.Random(1)
    for _ in range(500):
        a, b = (np.array(sorted(pick.sample(range(60), pick.randrange(1, 50)))) for _ in range(2))
        start = np.searchsorted(b, a) - pick.randrange(1, 9)
        got = alignment.common_ends(a, b, np.maximum(start, 0))
        want = [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x == y]
        assert list(zip(*(x.tolist() for x in got), strict=True)) == want
    none = np.empty(0, np.int64)
    assert [len(x) for x in (*alignment.common_ends(none, a, none), *alignment.common_ends(a, none, a))] == [0] * 4


def test_groups_of_many_tokens(monkeypatch, libraries):
    monkeypatch.setattr(alignment, "PAIRS_OF_GROUP", 1)
    rows = list(enumerate(odd_texts()[:300]))
    _, _, ends, links, times = alignment.Aligner(BYTE, PIECE).texts([t for _, t in rows])
    width = libraries[1].get_piece_size()
    for (_, text), a, b in zip(rows, ends, ends[1:]):
        m = brute.aligned(text, *libraries)
        want = Counter(i * width + j for x, y in (m[2] if m else []) for i in x for j in y)
        assert dict(zip(links[a:b].tolist(), times[a:b].tolist(), strict=True)) == want


def odd_texts():
    pick = random.Random(7)
    chars = [chr(c) for c in range(0, 0x180)] + ["<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "▁", "'s", "　", " ", "\xa0"]
    chars += ["中文", "日本", "😀", "👩‍👩‍👧", "é", "ﬁ", "\t"] + [" ", "\n", "the", "of"] * 25 + list("abqzxj'") * 8
    odd = ["", " ", "  ", "\n", "a ", "a  ", "a \n", "\na", "a\n\n b", "x▁y", "a" * 300, "中" * 300, "a\n", "a\n\n", " a", "😀 " * 40]
    return odd + ["".join(pick.choices(chars, k=pick.randrange(1, 60))) for _ in range(1500)]


@pytest.mark.parametrize("held", [alignment.HELD, 50])
def test_groups_are_those_of_whole_texts(libraries, held):
    odd = odd_texts()
    aligner = alignment.Aligner(BYTE, PIECE, held)
    got = []
    for at in range(0, len(odd), 40):
        totals, groups, *_ = aligner.texts(odd[at : at + 40])
        got += zip(totals.tolist(), groups, strict=True)
    for text, ((n_a, n_b, n_groups, _), groups) in zip(odd, got, strict=True):
        want = brute.aligned(text, *libraries)
        assert (groups, n_a, n_b, n_groups) == (
            (";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in want[2]), len(want[0]), len(want[1]), len(want[2]))
            if want else ("", 0, 0, 0)
        ), repr(text)
    assert max(map(len, aligner.known)) <= alignment.LONGEST


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 20, 0])
def test_statistics(spark, libraries, frequent):
    rows = [(i, t) for i, t in enumerate(odd_texts()[:150])] + [(3, "the end of the end"), (3, "the end of the end"), (None, None), (None, "the end"), (900, "the very long end " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("row", "links", "n", "best", "groups")})
    got = alignment.link_statistics(df, BYTE, PIECE, frequent=frequent)
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr) == sorted(brute.op13(rows, *libraries), key=repr)
    if frequent:
        return
    texts = {r.doc_id: r for r in alignment.align(df.where("doc_id < 150 and doc_id != 3"), BYTE, PIECE).collect()}
    assert all(brute.sha(texts[w[0]].groups) == w[7] for w in brute.op13(rows, *libraries) if w[0] in texts and w[1])
    assert alignment.link_statistics(df.where("false"), BYTE, PIECE).count() == 0


def test_query(spark, libraries):
    folder = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet'").fetchall()
    got = sorted(tuple(r) for r in queries.op13_alignment(spark, folder).select(*COLUMNS).collect())
    assert got == sorted(brute.op13(docs, *libraries))

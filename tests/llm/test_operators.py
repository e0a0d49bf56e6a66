"""The text operators on edge cases, against plain Python versions."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from savora.llm import bpe, components, decontaminate, exact_dedup, factorization, fragments, licenses, minhash, records, repeats, surrogates
from tests.llm import brute

BASE = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    (0, BASE),
    (1, BASE.replace("word30 ", "other ")),
    (2, BASE),
    (3, "  " + BASE.upper() + "\n"),
    (4, None),
    (5, ""),
    (6, " \t\n"),
    (7, "é" * 50),
    (8, "a b"),
    (9, "A B"),
    (10, "spam " * 300),
    (11, BASE + " " + " ".join(f"more{i}" for i in range(200))),
    (12, "x<|endoftext|> y\r\n\n 'll don't"),
    (13, "Mr John Smith wrote to jo.smith@mail1.example.com, +1 (017) 555-7713, from 169.122.221.182."),
    (14, "Some words.\nLicensed under the Apache License, Version 2.0.\nmore"),
]
ITEMS = [(1, " ".join(f"word{i}" for i in range(5, 18))), (2, "A b"), (3, None), (4, ""), (5, "no such words here at all")]
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    """With extra columns of names the operators use."""
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    extra = {c: F.lit("x") for c in ("digest", "kept", "key", "spans", "bucket", "ids", "n")}
    return df.withColumn("n_chars", F.length("text").cast("long")).withColumns(extra)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("block_words", [200_000, 8])
def test_overlaps(spark, docs, empty, block_words):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.overlaps(docs, items, block_words=block_words)
    got = found.select("doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256), F.col("n_hit") > 0)
    assert sorted(map(tuple, got.collect())) == sorted(brute.contaminated(TEXTS, ITEMS))
    assert decontaminate.overlaps(empty, items).count() == 0
    assert decontaminate.overlaps(docs, items.where("false")).where("n_hit > 0").count() == 0
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items).collect()}
    assert 8 not in cut and "word10" not in cut[0] and cut[0].startswith("word0 ") and cut[4] is None


def test_blocks_are_collected_one_after_the_other(spark, docs, monkeypatch):
    steps, stage, block = [], decontaminate.stage, decontaminate._block
    monkeypatch.setattr(decontaminate, "stage", lambda df, label: steps.append(label) or stage(df, label))
    monkeypatch.setattr(decontaminate, "_block", lambda pieces, k: steps.append(k) or block(pieces, k))
    decontaminate.overlaps(docs, spark.createDataFrame(ITEMS, "item_id long, text string"), block_words=8).collect()
    count = steps[-1] + 1
    assert count > 1 and steps == ["blocks", *(s for k in range(count) for s in (k, "scanned"))][:-1]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda norm: F.substring(F.md5(norm), 1, 1)])
def test_exact_groups(docs, empty, digest):
    got = exact_dedup.exact_groups(docs, digest=digest)
    assert rows(got, "doc_id", "keep_id", "group_size", "kept") == sorted((x[:4] for x in brute.exact(TEXTS)), key=repr)
    assert exact_dedup.exact_groups(empty).count() == 0
    assert {r.doc_id for r in exact_dedup.drop_copies(docs).collect()} == {x[0] for x in brute.exact(TEXTS) if x[3]}


def test_state_goes_on_over_batches(spark, docs, tmp_path):
    for k in range(3):
        exact_dedup.digest_rows(docs.where(F.col("doc_id") % 3 == k)).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(exact_dedup.digest_rows(docs).schema).option("maxFilesPerTrigger", 1)
    state = exact_dedup.seen(source.parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert state.agg(F.sum("n")).first()[0] == len(TEXTS)
    assert state.count() == len({x[4] for x in brute.exact(TEXTS)})


@pytest.mark.parametrize("hot", [2_000, 1])
def test_repeats(docs, empty, hot):
    got = repeats.without_repeats(docs, 20, hot_segments=hot, text_bytes=500)
    got = got.select("doc_id", "n_bytes", F.col("n_bytes") - F.octet_length("kept"), F.size("spans"), F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect())) == sorted(brute.repeats(TEXTS, 20))
    assert repeats.without_repeats(empty, 20).count() == 0


def test_segments_come_once_from_copies(spark):
    texts = spark.createDataFrame([(bytes([i % 2]), "abcdefgh" * (1 + i % 2)) for i in range(40)], "key binary, text string").repartition(4)
    wanted = spark.createDataFrame(
        [(1, 2, 3, (b"\0", 1)), (1, 5, 2, (b"\1", 8))], "anchor long, content long, windows long, at struct<key:binary,start:long>"
    )
    got = repeats._fetch(texts, wanted, 4)
    assert rows(got, "anchor", "content", "windows", "bytes") == [(1, 2, 3, b"bcdefg"), (1, 5, 2, b"abcde")]
    flagged = repeats._count_windows(got.unionByName(got), 2)
    assert all(len(r.runs) == r.windows + 2 for r in flagged.collect())


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_groups(docs, empty, size, percent):
    near = minhash.Near(size, percent)
    got = minhash.near_groups(docs, near)
    assert rows(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(brute.near(TEXTS, size, percent), key=repr)
    assert minhash.near_groups(empty, near).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert {(r.node, r.root) for r in got.collect()} == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 160)}


def test_bpe(docs, empty):
    t = Tokenizer.from_file(BYTE)
    want = {d: t.encode(x or "", add_special_tokens=False).ids for d, x in TEXTS}
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, BYTE), BYTE).collect()}
    assert {d: r.ids for d, r in got.items()} == want
    assert {d: r.text for d, r in got.items()} == {d: t.decode(i, skip_special_tokens=False) for d, i in want.items()}
    assert bpe.encode(empty, BYTE).count() == 0
    assert {r.doc_id: (r.ids, r.text) for r in bpe.round_trip(docs, BYTE).collect()} == {d: (r.ids, r.text) for d, r in got.items()}
    odd = docs.select(F.lit(None).cast("long").alias("doc_id"), F.array(F.lit(-1), F.lit(10**6), F.lit(15496)).alias("ids")).limit(1)
    assert [r.text for r in bpe.decode(odd, BYTE).collect()] == ["Hello"]


@pytest.mark.parametrize("held", [96 << 20, 2000])
def test_byte_level_ids_of_texts_are_those_of_the_library(held):
    t = Tokenizer.from_file(BYTE)
    pick = random.Random(5)
    chars = [chr(c) for c in range(0, 0x180)] + ["<|endoftext|>", "'s", "\u3000", "\u2028", "\xa0", "中文", "😀", "e\u0301"] + [" ", "\n"] * 40 + list("abqzxj'") * 10
    odd = ["", "a" * 100_000, "zq " * 50_000] + ["".join(pick.choices(chars, k=pick.randrange(1, 60))) for _ in range(3000)]
    encoder = bpe.Encoder(BYTE, held)
    got = [i.tolist() for a in range(0, len(odd), 100) for i in encoder.texts([x.encode() for x in odd[a : a + 100]])]
    assert got == [e.ids for e in t.encode_batch(odd, add_special_tokens=False)]
    assert max(map(len, encoder.known)) <= bpe.LONGEST
    assert encoder.held == sum(bpe.ENTRY_BYTES + len(f) + len(i) for f, i in encoder.known.items())


def test_records(spark, docs, tmp_path):
    t = Tokenizer.from_file(WORD)
    data, index = f"file://{tmp_path}/data", f"file://{tmp_path}/index"
    records.write_records(docs, data, WORD, end_id=1, shard_bytes=1000)
    records.write_index(spark, data, index)
    start, want = 0, []
    for d, x in TEXTS:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 1]
        want.append((d, start, len(ids), brute.crc_ids(ids)))
        start += len(ids)
    table = spark.read.parquet(index)
    got = records.read_at(spark, data, table).join(table, "doc_id").select("doc_id", "start", "n_tokens", F.crc32("ids"))
    assert sorted(map(tuple, got.collect())) == want
    content = records.frame(7, b"\1\0", 2)
    with pytest.raises(ValueError, match="broken"):
        records.unframe(content[:15] + b"\xff" + content[16:])


def test_ids_of_texts_are_those_of_the_library():
    t = Tokenizer.from_file(WORD)
    odd = ["", " \t\n", "don't 'll x", "A<|endoftext|>b <|startoftext|>", "É ß ÿ İ ΑΣ", "a\x1cb\x0bc\x85d", "12 34.5%% ^^ `~ [x]\\ é€"]
    pick = random.Random(3)
    chars = [chr(c) for c in range(1, 0x180)] + ["<|endoftext|>", "'s"] + [" "] * 60 + list("abcdefghij'") * 10
    odd += ["".join(pick.choices(chars, k=pick.randrange(1, 40))) for _ in range(2000)]
    encode = fragments.FragmentIds(WORD, "<u2", *fragments.WORD_PIECES, limit=300, longest=5)
    got = [ids for at in range(0, len(odd), 50) for ids in encode.of_texts(odd[at : at + 50])]
    want = [e.ids for e in t.encode_batch(odd, add_special_tokens=False)]
    assert [memoryview(ids).cast("H").tolist() if ids else [] for ids in got] == want
    assert max(map(len, encode.known_pieces)) <= 5


def test_surrogates(docs, empty):
    got = {r.doc_id: r for r in surrogates.with_surrogates(docs, b"key").collect()}
    assert got[13].n_entities == 4 and not any(x in got[13].text for x in ("Smith", "jo.smith", "555-7713", "169.122"))
    assert got[0].text == BASE and got[4].text is None and got[4].n_entities == 0
    p = surrogates.Permutation(b"key", 0)
    made = {p.text(f"{i:03}", "t") for i in range(1000)}
    assert made == {f"{i:03}" for i in range(1000)}
    assert surrogates.replaced("A@B.com a@b.com", p)[0].lower().split()[0] == surrogates.replaced("a@b.com", p)[0]
    assert surrogates.with_surrogates(empty, b"key").count() == 0


@pytest.mark.parametrize("text,left,n", [
    ("Mr John Smith came. Smith said so, and John left.", ("John", "Smith"), 3),
    ("Mr John F. Kennedy, Mr John Paul Jones and Mr O'Brien", ("John", "F", "Kennedy", "Paul", "Jones", "O", "Brien"), 3),
    ("So Mary Miller-Stone wrote; MILLER too. Prof. Dr. Hans van der Berg's car", ("Mary", "Miller", "Stone", "MILLER", "Hans", "Berg"), 3),
    ("Вчера Иван Петрович Сидоров и г-жа Круглова пришли, Сидоров ушёл", ("Иван", "Петрович", "Сидоров", "Круглова"), 3),
    ("Η κυρία Παπαδοπούλου", ("Παπαδοπούλου",), 1),
])
def test_whole_names_and_mentions(text, left, n):
    for key in range(20):
        new, count = surrogates.replaced(text, surrogates.Permutation(b"key", key))
        now, was = (surrogates.WORD.findall(x) for x in (new, text))
        assert count == n and all((a == b) == (b not in left) for a, b in zip(now, was, strict=True))


def test_one_surrogate_for_one_person():
    new, _ = surrogates.replaced("Ms Priya Patel. Dr Priya Patel, PATEL, Mr Patel", surrogates.Permutation(b"key", 0))
    ms, priya, patel, dr, again, patel2, caps, mr, patel3 = new.replace(".", "").replace(",", "").split()
    assert priya == again and patel == patel2 == patel3 and caps == patel.upper()
    p = surrogates.Permutation(b"key", 1)
    pairs = [a + b for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for b in "abcdefghijklmnopqrstuvwxyz"]
    made = [p.word(x) for x in pairs]
    assert set(made) == set(pairs) and all(x != y for x, y in zip(pairs, made, strict=True))
    for names in surrogates.GIVEN.values():
        assert {p.word(x) for x in names.split()} == set(names.split()) and all(p.word(x) != x for x in names.split())


def test_licenses(docs, empty):
    got = licenses.license_notices(docs).collect()
    # The line itself, and the paragraph that holds it and begins a line before.
    assert sorted((r.doc_id, r.line, r.license, r.dice) for r in got) == [
        (14, 1, "Apache-2.0", 0.823529), (14, 2, "Apache-2.0", 1.0),
    ]
    assert licenses.license_notices(empty).count() == 0


MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
ISC_TEXT = """# Permission to use, copy, modify, and/or distribute this software for any
# purpose with or without fee is hereby granted, provided that the above
# copyright notice and this permission notice appear in all copies."""


def test_paragraphs_of_licence_texts(spark):
    df = spark.createDataFrame([(1, MIT_TEXT), (2, ISC_TEXT), (3, MIT_TEXT.replace("\n\n", " ").replace("\n", " "))], "doc_id long, text string")
    got = {(r.doc_id, r.line): (r.license, r.dice) for r in licenses.license_notices(df).collect()}
    assert got[1, 1] == ("MIT", 1.0) and got[1, 8] == ("MIT", 1.0) and got[2, 1] == ("ISC", 1.0)
    assert got[3, 1][0] == "MIT"


def test_factorization(spark, empty):
    texts = [(i, f"common words {'awful' if i % 2 else 'lovely'} number{i}", i % 2) for i in range(80)]
    df = spark.createDataFrame(texts, "doc_id long, text string, label int")
    machine = factorization.fit(df.drop("label"), df, factorization.TOXICITY)
    scored = factorization.with_score(df.select("doc_id", "text", "label"), machine)
    assert scored.where((F.col("score") >= 0.5) != (F.col("label") == 1)).count() == 0
    none = factorization.fit(df, df.where("false"), factorization.QUALITY)
    assert [r.score for r in factorization.with_score(df.select("text").limit(1), none).collect()] == [0.5]
    assert factorization.with_score(empty, machine).count() == 0

"""Exact copies over several runs, long and odd rows, against a plain Python version."""

import hashlib
import random
import re

import pytest

from pyspark.sql import functions as F

from savora.llm import exact_dedup as ed

SCHEMA = "doc_id long, text string"


def plain(rows):
    """(id, text) rows to sorted (id, keep, size, kept), by texts alone."""
    groups = {}
    for d, text in rows:
        groups.setdefault(re.sub(r"[ \t-\r]", "", text or ""), []).append((d, len(text or "")))
    found = []
    for members in groups.values():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        found += [(d, keep, len(members), d == keep) for d, _ in members]
    return sorted(found, key=repr)


def got(groups):
    return sorted((tuple(r) for r in groups.select("doc_id", "keep_id", "group_size", "kept").collect()), key=repr)


ODD = [
    (1, "a b"), (2, "ab "), (3, None), (4, ""), (5, "\n\t"), (6, "long " * 400_000), (7, "long" * 400_000), (8, "c"),
    (8, "c"), (8, "another text of the same id"), (None, "no id"), (None, "no id  "), (9, "no id"), (None, "alone"), (10, "é "),
    (11, "é  "),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit(1) for c in ("file", "row", "run", "best", "digest", "_metadata")})
    assert got(ed.exact_groups(docs)) == plain(ODD)
    left = [r.doc_id for r in ed.drop_copies(docs).collect()]
    assert sorted(left, key=repr) == sorted((d for d, _, _, kept in plain(ODD) if kept), key=repr)


def test_hot_group(spark):
    rows = [(i, f"copy{' ' * (i % 7)}" if i % 3 == 0 else f"text {i % 500}") for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert got(ed.exact_groups(docs, files_per_batch=2)) == plain(rows)


@pytest.mark.parametrize("digest", [ed.sha256, lambda norm: F.substring(F.md5(norm), 1, 1)])
def test_runs_share_state(spark, tmp_path, digest):
    draw = random.Random(3)
    rows = [(i, draw.choice("abcdefghijklmnop") * 3 + " " * draw.randrange(3)) for i in range(60)]
    folder = str(tmp_path / "seen")
    for k in range(3):
        part = rows[20 * k : 20 * k + 20]
        docs = spark.createDataFrame(part, SCHEMA)
        ids = {d for d, _ in part}
        want = [r for r in plain(rows[: 20 * k + 20]) if r[0] in ids]
        assert got(ed.exact_groups(docs, folder=folder, run=f"r{k}", digest=digest)) == want
    # A repeated call finds its rows stored and counts them once.
    assert got(ed.exact_groups(docs, folder=folder, run="r2", digest=digest)) == want
    assert ed.exact_groups(docs.limit(0), folder=folder, run="none", digest=digest).count() == 0
    with pytest.raises(ValueError):
        ed.exact_groups(docs, folder=folder, run="../r")


def test_state_locates_the_content(spark, tmp_path):
    rows = [(i, f"text {i % 10}{' ' * (i % 3)}") for i in range(40)]
    folder = str(tmp_path / "seen")
    ed.exact_groups(spark.createDataFrame(rows, SCHEMA).repartition(4), folder=folder)
    state = spark.read.parquet(f"{folder}/changes").select("digest", F.col("best.file").alias("file"), F.col("best.row").alias("row"))
    content = ed.located(spark.read.parquet(f"{folder}/content")).drop("digest")
    found = state.join(content, ["file", "row"]).collect()
    assert len(found) == state.count() == 10
    kept = {d for d, _, _, kept in plain(rows) if kept}
    for r in found:
        assert r.doc_id in kept
        assert r.digest == hashlib.sha256(r.text.replace(" ", "").encode()).hexdigest()

"""Scoring against a plain layer-by-layer computation in double precision."""

import numpy as np
import pytest

from savora.operators import network as nw

NUMERIC, CATEGORICAL, TAG, HIDDEN = 10, 4, 6, 8


def plain(weights, head, meta, tag):
    """Nothing folded, one operation per layer."""
    w = {k: v.astype(np.float64) for k, v in weights.items()}

    def linear(x, n):
        return x @ w[f"{n}.weight"].T + w[f"{n}.bias"]

    def norm(x, n):
        scaled = (x - w[f"{n}.running_mean"]) / np.sqrt(w[f"{n}.running_var"] + 1e-5)
        return scaled * w[f"{n}.weight"] + w[f"{n}.bias"]

    def relu(x):
        return np.where(x > 0, x, 0.0)

    def full(x, n):
        return relu(norm(linear(x, f"{n}.linear"), f"{n}.batchnorm"))

    def layer(x, kind, n):
        if kind == "full":
            return full(x, n)
        l1, b1, l2, b2 = {
            "residual": ("path.0", "path.1", "path.4", "path.5"),
            "expanding": ("fc1", "bn1", "fc2", "bn2"),
        }[kind]
        inner = relu(norm(linear(x, f"{n}.{l1}"), f"{n}.{b1}"))
        return relu(norm(linear(inner, f"{n}.{l2}"), f"{n}.{b2}") + x)

    def body(x):
        for n, kind in enumerate(nw.HEADS[head]):
            x = layer(x, kind, f"head.{n}")
        return x

    def layer_norm(x, n):
        m, v = x.mean(axis=1, keepdims=True), x.var(axis=1, keepdims=True)
        return (x - m) / np.sqrt(v + 1e-5) * w[f"{n}.weight"] + w[f"{n}.bias"]

    tags = full(full(tag, "tag_encoder.0"), "tag_encoder.1")
    if head == "two_tower":
        m = full(full(meta, "two_tower_meta_encoder.0"), "two_tower_meta_encoder.1")
        emb = np.hstack([layer_norm(m, "meta_norm"), layer_norm(body(tags), "tag_norm")])
        raw = linear(relu(linear(emb, "regressor.0")), "regressor.2")
    else:
        if head == "residual_v3":
            centres = np.linspace(-3, 3, 15)
            rows = []
            for x in meta[:, :NUMERIC]:
                parts = [
                    np.maximum(0, 1 - np.abs(v - centres) / (6 / 14)) @ w["plqp.embeddings"][f] for f, v in enumerate(x)
                ]
                rows.append(np.concatenate(parts))
            m = np.hstack([full(np.array(rows), "num_proj"), full(meta[:, NUMERIC:], "cat_proj")])
        else:
            m = full(full(meta, "default_meta_encoder.0"), "default_meta_encoder.1")
        emb = body(np.hstack([m, tags]))
        raw = linear(emb, "regressor")
    return 1 + 4 / (1 + np.exp(-raw[:, 0])), emb


@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(9)
    meta, tag = rng.normal(size=(57, NUMERIC + CATEGORICAL)), rng.uniform(size=(57, TAG))
    rows = [(str(n), f"item {n}", [*map(float, m)], [*map(float, t)], 4.0) for n, (m, t) in enumerate(zip(meta, tag))]
    schema = "recipe_id string, name string, meta array<float>, tag array<float>, target float"
    return spark.createDataFrame(rows, schema).repartition(3), meta.astype(np.float32), tag.astype(np.float32)


@pytest.mark.parametrize("head", nw.HEADS)
@pytest.mark.parametrize("double", [True, False])
def test_heads(spark, features, head, double):
    df, meta, tag = features
    shapes = nw.parameter_shapes(head, NUMERIC, CATEGORICAL, TAG, HIDDEN)
    weights = nw.read_weights(nw.weights_table(spark, nw.seeded_weights(shapes)))
    got = nw.score_corpus(df, weights, NUMERIC, CATEGORICAL, TAG, head, HIDDEN, batch_size=10, double=double).collect()
    got.sort(key=lambda r: int(r.recipe_id))
    prediction, embedding = plain(weights, head, meta.astype(np.float64), tag.astype(np.float64))
    size = np.abs(embedding).max() + 1
    tolerance = 1e-9 if double else 1e-5
    assert np.abs(np.array([r.prediction for r in got]) - prediction).max() < 4 * tolerance
    assert np.abs(np.array([r.embedding for r in got]) - embedding).max() < tolerance * size
    assert got[3].recipe_name == "item 3" and got[3].target == 4.0
    assert len(got) == 57 and len(got[0].embedding) == nw.embedding_width(head, HIDDEN)
    assert all(1.0 <= r.prediction <= 5.0 for r in got)
    if head != "two_tower":
        assert all(min(r.embedding) >= 0 for r in got)


def test_production_width():
    assert nw.embedding_width("two_tower") == 160 and nw.embedding_width("residual_v2") == 128
    shapes = nw.parameter_shapes("residual_v2", 10, 200, 34)
    assert shapes["head.3.fc1.weight"] == (512, 256) and shapes["regressor.weight"] == (1, 128)


def test_empty_group_gives_zeros():
    shapes = nw.parameter_shapes("residual_v3", 0, 3, 2, 8)
    run = nw.forward_pass(nw.seeded_weights(shapes), "residual_v3", 0, 3, 2, 8)
    prediction, embedding = run(np.ones((2, 3)), np.ones((2, 2)))
    assert prediction.shape == (2,) and embedding.shape == (2, 8)


def test_weights_are_checked(spark):
    weights = nw.seeded_weights(nw.parameter_shapes("shallow", 2, 0, 2, 8))
    old = {n.replace("default_meta_encoder", "legacy_meta_encoder"): v for n, v in weights.items()}
    assert set(nw.read_weights(nw.weights_table(spark, old))) == set(weights)
    less = {n: v for n, v in weights.items() if n != "regressor.bias"}
    with pytest.raises(ValueError, match="regressor.bias"):
        nw.forward_pass(less, "shallow", 2, 0, 2, 8)
    with pytest.raises(ValueError, match="shape"):
        nw.forward_pass(weights, "shallow", 3, 0, 2, 8)
    with pytest.raises(ValueError, match="unsupported"):
        nw.parameter_shapes("other", 1, 1, 1)

"""Scoring a corpus with a stored two-encoder rating network.

Weights are a table ``(param, shape, values)`` with one row per parameter, under the names of the
training framework's checkpoint. Tasks get them as a broadcast variable and score Arrow batches with
NumPy; rows are not shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from savora.functions.columns import BIN_CENTRES, BIN_HIGH, BIN_LOW
from savora.plans.skew import spread

# Layers of each head from input to output, the width of a numeric feature's learned
# bins, of the hidden layer of the two-tower output, and the small number of the normalisations.
HEADS = {
    "shallow": ("full",),
    "deep": ("full",) * 10,
    "residual": ("full", "residual", "residual", "full"),
    "residual_v2": ("full",) + ("expanding",) * 6 + ("full",),
    "residual_v3": ("full",) + ("expanding",) * 6 + ("full",),
    "two_tower": ("full",) + ("expanding",) * 6 + ("full",),
}
BIN_WIDTH = 16
TWO_TOWER_HIDDEN = 64
EPSILON = 1e-5
MAX_WEIGHTS = 200_000_000

WEIGHT_SCHEMA = "param string, shape array<int>, values array<float>"

Layer = Callable[[np.ndarray], np.ndarray]


def _linear_shapes(name: str, n_in: int, n_out: int) -> Iterator[tuple[str, tuple[int, ...]]]:
    yield f"{name}.weight", (n_out, n_in)
    yield f"{name}.bias", (n_out,)


def _norm_shapes(name: str, n: int) -> Iterator[tuple[str, tuple[int, ...]]]:
    for part in ("weight", "bias", "running_mean", "running_var"):
        yield f"{name}.{part}", (n,)


# Fixed values: (linear, normalisation) names inside each kind of layer.
PARTS = {
    "full": (("linear", "batchnorm"),),
    "residual": (("path.0", "path.1"), ("path.4", "path.5")),
    "expanding": (("fc1", "bn1"), ("fc2", "bn2")),
}


def _layer_shapes(kind: str, name: str, n_in: int, n_out: int):
    middle = 2 * n_out if kind == "expanding" else n_out
    widths = (n_in, n_out) if kind == "full" else (n_in, middle, n_out)
    for (linear, norm), i, o in zip(PARTS[kind], widths, widths[1:]):
        yield from _linear_shapes(f"{name}.{linear}", i, o)
        yield from _norm_shapes(f"{name}.{norm}", o)


def parameter_shapes(
    head: str, numeric: int, categorical: int, tag: int, hidden: int = 128
) -> dict[str, tuple[int, ...]]:
    """Every parameter the scoring pass of ``head`` reads, with its shape."""
    if head not in HEADS:
        raise ValueError(f"unsupported head: {head}")
    meta, half, quarter = numeric + categorical, hidden // 2, hidden // 4
    shapes: list[tuple[str, tuple[int, ...]]] = []

    def stack(name: str, *widths: int) -> None:
        for n, (i, o) in enumerate(zip(widths, widths[1:])):
            shapes.extend(_layer_shapes("full", f"{name}.{n}", i, o))

    if head == "two_tower":
        stack("two_tower_meta_encoder", meta, half, quarter)
    elif head == "residual_v3":
        if numeric:
            shapes.append(("plqp.embeddings", (numeric, BIN_CENTRES, BIN_WIDTH)))
            shapes.extend(_layer_shapes("full", "num_proj", numeric * BIN_WIDTH, half))
        if categorical:
            shapes.extend(_layer_shapes("full", "cat_proj", categorical, half))
    else:
        stack("default_meta_encoder", meta, hidden, hidden)
    stack("tag_encoder", tag, hidden, hidden)

    wide = hidden if head == "two_tower" else 2 * hidden
    kinds = HEADS[head]
    for n, kind in enumerate(kinds):
        out = hidden if n == len(kinds) - 1 else wide
        shapes.extend(_layer_shapes(kind, f"head.{n}", wide, out))
    if head == "two_tower":
        for name, n in (("meta_norm", quarter), ("tag_norm", hidden)):
            shapes += [(f"{name}.weight", (n,)), (f"{name}.bias", (n,))]
        shapes.extend(_linear_shapes("regressor.0", quarter + hidden, TWO_TOWER_HIDDEN))
        shapes.extend(_linear_shapes("regressor.2", TWO_TOWER_HIDDEN, 1))
    else:
        shapes.extend(_linear_shapes("regressor", hidden, 1))
    return dict(shapes)


def embedding_width(head: str, hidden: int = 128) -> int:
    return hidden // 4 + hidden if head == "two_tower" else hidden


def seeded_weights(shapes: Mapping[str, tuple[int, ...]], seed: int = 42) -> dict[str, np.ndarray]:
    """Random weights of the right shapes, spread as for rectified layers; for trials without a stored model."""
    rng = np.random.default_rng(seed)
    weights = {}
    for name, shape in shapes.items():
        if name.endswith("running_var"):
            values = rng.uniform(0.5, 1.5, shape)
        elif name.endswith((".bias", "running_mean")):
            values = rng.normal(0.0, 0.1, shape)
        elif len(shape) == 1:
            values = rng.uniform(0.8, 1.2, shape)
        else:
            values = rng.normal(0.0, np.sqrt(2.0 / prod(shape[1:])), shape)
        weights[name] = values.astype(np.float32)
    return weights


def weights_table(spark: SparkSession, weights: Mapping[str, np.ndarray]) -> DataFrame:
    rows = [(n, list(w.shape), w.ravel().tolist()) for n, w in weights.items()]
    return spark.createDataFrame(rows, WEIGHT_SCHEMA)


def read_weights(table: DataFrame) -> dict[str, np.ndarray]:
    """The stored parameters. Their number is set by the architecture, not by the data; it is checked first."""
    total = table.agg(F.sum(F.size("values").cast("bigint"))).first()[0] or 0
    if total > MAX_WEIGHTS:
        raise ValueError(f"{total} weights are too many to send to every task")
    renamed = ((r.param.replace("legacy_meta_encoder", "default_meta_encoder"), r) for r in table.collect())
    return {n: np.asarray(r["values"], dtype=np.float32).reshape(r["shape"]) for n, r in renamed}


def _affine(weights, linear: str, norm: str, dtype) -> Layer:
    """A linear layer with its batch normalisation folded in (stored statistics, no dropout)."""
    gain = weights[f"{norm}.weight"] / np.sqrt(weights[f"{norm}.running_var"] + EPSILON)
    offset = (weights[f"{linear}.bias"] - weights[f"{norm}.running_mean"]) * gain + weights[f"{norm}.bias"]
    matrix = (weights[f"{linear}.weight"] * gain[:, None]).T.astype(dtype)
    offset = offset.astype(dtype)
    return lambda x: x @ matrix + offset


def _relu(x: np.ndarray) -> np.ndarray:
    return np.maximum(x, 0)


def _layer(weights, kind: str, name: str, dtype) -> Layer:
    steps = [_affine(weights, f"{name}.{lin}", f"{name}.{norm}", dtype) for lin, norm in PARTS[kind]]
    if kind == "full":
        return lambda x: _relu(steps[0](x))
    return lambda x: _relu(x + steps[1](_relu(steps[0](x))))


def _chain(*layers: Layer) -> Layer:
    def run(x: np.ndarray) -> np.ndarray:
        for layer in layers:
            x = layer(x)
        return x

    return run


def _layer_norm(weights, name: str, dtype) -> Layer:
    gain, offset = weights[f"{name}.weight"].astype(dtype), weights[f"{name}.bias"].astype(dtype)

    def run(x: np.ndarray) -> np.ndarray:
        centred = x - x.mean(axis=1, keepdims=True)
        return centred / np.sqrt(centred.var(axis=1, keepdims=True) + EPSILON) * gain + offset

    return run


def _plain(weights, name: str, dtype) -> Layer:
    matrix, offset = weights[f"{name}.weight"].T.astype(dtype), weights[f"{name}.bias"].astype(dtype)
    return lambda x: x @ matrix + offset


def _binned(weights, dtype) -> Layer:
    """Soft bins of every numeric feature times its learned bin vectors."""
    vectors = weights["plqp.embeddings"].astype(dtype)
    centres = np.linspace(BIN_LOW, BIN_HIGH, BIN_CENTRES).astype(dtype)
    step = centres[1] - centres[0]

    def run(x: np.ndarray) -> np.ndarray:
        shares = _relu(1 - np.abs(x[:, :, None] - centres) / step)
        return np.einsum("bfn,fnm->bfm", shares, vectors).reshape(len(x), -1)

    return run


def forward_pass(
    weights: Mapping[str, np.ndarray],
    head: str,
    numeric: int,
    categorical: int,
    tag: int,
    hidden: int = 128,
    dtype=np.float32,
) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """``(meta, tag) -> (prediction, embedding)`` for matrices of rows."""
    for name, shape in parameter_shapes(head, numeric, categorical, tag, hidden).items():
        if name not in weights:
            raise ValueError(f"the weights lack {name}")
        if tuple(weights[name].shape) != shape:
            raise ValueError(f"{name} has shape {weights[name].shape}, not {shape}")

    weights = {name: values.astype(np.float64) for name, values in weights.items()}

    def stack(name: str, n: int = 2) -> Layer:
        return _chain(*(_layer(weights, "full", f"{name}.{i}", dtype) for i in range(n)))

    if head == "two_tower":
        encode_meta = stack("two_tower_meta_encoder")
    elif head == "residual_v3":

        def empty(x: np.ndarray) -> np.ndarray:
            return np.zeros((len(x), hidden // 2), dtype)

        numbers = (
            _chain(_binned(weights, dtype), _layer(weights, "full", "num_proj", dtype))
            if numeric
            else empty
        )
        classes = _layer(weights, "full", "cat_proj", dtype) if categorical else empty

        def encode_meta(x: np.ndarray) -> np.ndarray:
            return np.hstack([numbers(x[:, :numeric]), classes(x[:, numeric:])])

    else:
        encode_meta = stack("default_meta_encoder")
    encode_tag = stack("tag_encoder")
    body = _chain(*(_layer(weights, kind, f"head.{n}", dtype) for n, kind in enumerate(HEADS[head])))

    if head == "two_tower":
        meta_norm, tag_norm = (_layer_norm(weights, n, dtype) for n in ("meta_norm", "tag_norm"))
        output = _chain(_plain(weights, "regressor.0", dtype), _relu, _plain(weights, "regressor.2", dtype))

        def embed(meta, tags):
            return np.hstack([meta_norm(encode_meta(meta)), tag_norm(body(encode_tag(tags)))])

    else:
        output = _plain(weights, "regressor", dtype)

        def embed(meta, tags):
            return body(np.hstack([encode_meta(meta), encode_tag(tags)]))

    def run(meta, tags):
        embedding = embed(meta.astype(dtype), tags.astype(dtype))
        with np.errstate(over="ignore"):
            prediction = 1 + 4 / (1 + np.exp(-output(embedding)[:, 0]))
        return prediction.astype(dtype), embedding

    return run


def score_corpus(
    features: DataFrame,
    weights: Mapping[str, np.ndarray],
    numeric: int,
    categorical: int,
    tag: int,
    head: str = "residual_v2",
    hidden: int = 128,
    item: str = "recipe_id",
    name: str = "name",
    batch_size: int = 1024,
    double: bool = False,
) -> DataFrame:
    """``(recipe_id, recipe_name, target, prediction, embedding)`` for every row of ``features``.

    ``features`` has ``meta`` and ``tag`` vectors and the ``target``. Map-only. ``double`` computes in
    double precision.
    """
    dtype = np.float64 if double else np.float32
    meta_width = numeric + categorical
    forward_pass(weights, head, numeric, categorical, tag, hidden, dtype)  # fail early
    shared = features.sparkSession.sparkContext.broadcast(dict(weights))
    number = T.DoubleType() if double else T.FloatType()
    schema = T.StructType(
        [
            T.StructField("recipe_id", features.schema[item].dataType),
            T.StructField("recipe_name", features.schema[name].dataType),
            T.StructField("target", T.FloatType()),
            T.StructField("prediction", number),
            T.StructField("embedding", T.ArrayType(number, False)),
        ]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = forward_pass(shared.value, head, numeric, categorical, tag, hidden, dtype)

        def matrix(column, width):
            return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

        for whole in batches:
            for low in range(0, whole.num_rows, batch_size):
                batch = whole.slice(low, batch_size)
                prediction, embedding = run(matrix(batch["meta"], meta_width), matrix(batch["tag"], tag))
                width = embedding.shape[1]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, (batch.num_rows + 1) * width, width, dtype=np.int32)),
                    pa.array(np.ascontiguousarray(embedding).ravel()),
                )
                yield pa.RecordBatch.from_arrays(
                    [batch[item], batch[name], batch["target"], pa.array(prediction), lists],
                    names=["recipe_id", "recipe_name", "target", "prediction", "embedding"],
                )

    wanted = features.select(item, name, "meta", "tag", F.col("target").cast("float").alias("target"))
    return spread(wanted).mapInArrow(score, schema)

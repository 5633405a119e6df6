"""Feature embedding and message passing over typed edges, with weights given as data.

Weights are small constant matrices (hidden size squared). Vectors of nodes and edges
stay distributed: a layer is one join and one aggregation per edge type.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegraph.functions.vectors import mean_of_vectors, zeros
from casegraph.session import materialize


@dataclass(frozen=True)
class Norm:
    """Batch normalisation with fixed statistics."""

    mean: Sequence[float]
    var: Sequence[float]
    gamma: Sequence[float]
    beta: Sequence[float]
    eps: float = 1e-5


@dataclass(frozen=True)
class Affine:
    """``x @ weight + bias``; ``weight`` has one row per input."""

    weight: Sequence[Sequence[float]]
    bias: Sequence[float]


@dataclass(frozen=True)
class Convolution:
    """Weights of one edge type: of the neighbour mean (with bias) and of the node itself."""

    neighbour: Affine
    root: Sequence[Sequence[float]]


def _scale_shift(norm: Norm | None, dim: int) -> tuple[np.ndarray, np.ndarray]:
    if norm is None:
        return np.ones(dim), np.zeros(dim)
    scale = np.asarray(norm.gamma, float) / np.sqrt(np.asarray(norm.var, float) + norm.eps)
    return scale, np.asarray(norm.beta, float) - np.asarray(norm.mean, float) * scale


def affine(vector: Column, layer: Affine, norm: Norm | None = None, relu: bool = False) -> Column:
    """Affine map, then normalisation, then relu; one matrix product per Arrow batch."""
    weight, bias = np.asarray(layer.weight, float), np.asarray(layer.bias, float)
    scale, shift = _scale_shift(norm, len(bias))
    weight, bias = weight * scale, bias * scale + shift

    @F.pandas_udf("array<double>")
    def apply(x: pd.Series) -> pd.Series:
        out = np.stack(x.to_numpy()).astype(float) @ weight + bias if len(x) else np.empty((0, len(bias)))
        return pd.Series(list(np.maximum(out, 0.0) if relu else out))

    return apply(vector)


def embed(features: DataFrame, layer: Affine, norm: Norm | None = None, id_col: str = "hadm_id") -> DataFrame:
    """Feature embedding of each case: affine map and normalisation of its own features only."""
    return features.select(id_col, affine(F.col("features"), layer, norm).alias("embedding"))


def neighbour_means(edges: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """Per ``dst`` the mean of the vectors of its ``src`` nodes; parallel edges count each time.

    ``vectors`` is (id, vector) with unique ids. A hub on the source side is a skewed left
    partition, which AQE splits; a hub on the target side is combined before the shuffle.
    """
    sources = vectors.select(F.col("id").alias("src"), "vector")
    return edges.select("src", "dst").join(sources, "src").groupBy("dst").agg(
        mean_of_vectors(F.col("vector"), dim).alias("vector")
    )


def hetero_layer(
    nodes: dict[str, DataFrame],
    edges: dict[tuple[str, str, str], DataFrame],
    weights: dict[str, Convolution],
    dim: int,
    norms: dict[str, Norm] | None = None,
    relu: bool = True,
) -> dict[str, DataFrame]:
    """One message-passing layer over all node types.

    For each edge type into a node type: mean of the neighbours, affine, plus the affine image of the
    node itself; then the element-wise maximum over edge types, normalisation and relu. A
    node without neighbours of a type gets a zero mean for it. ``nodes`` are (id, vector),
    ``edges`` map (source type, edge type, target type) to (src, dst).
    """
    result = {}
    for node_type, table in nodes.items():
        incoming = [(key, e) for key, e in edges.items() if key[2] == node_type]
        if not incoming:
            continue
        joined = table
        for i, ((source_type, _, _), edge_table) in enumerate(incoming):
            means = neighbour_means(edge_table, nodes[source_type], dim)
            joined = joined.join(means.select(F.col("dst").alias("id"), F.col("vector").alias(f"m{i}")), "id", "left")
        columns = [F.coalesce(F.col(f"m{i}"), zeros(dim)) for i in range(len(incoming))]
        combine = _combine([weights[key[1]] for key, _ in incoming], (norms or {}).get(node_type), relu)
        result[node_type] = joined.select("id", combine(F.col("vector"), *columns).alias("vector"))
    return result


def _combine(convolutions: list[Convolution], norm: Norm | None, relu: bool):
    roots = [np.asarray(c.root, float) for c in convolutions]
    neighbours = [np.asarray(c.neighbour.weight, float) for c in convolutions]
    biases = [np.asarray(c.neighbour.bias, float) for c in convolutions]
    scale, shift = _scale_shift(norm, len(biases[0]))

    @F.pandas_udf("array<double>")
    def apply(*columns: pd.Series) -> pd.Series:
        if not len(columns[0]):
            return pd.Series([], dtype=object)
        own, *means = [np.stack(c.to_numpy()).astype(float) for c in columns]
        out = None
        for mean, root, weight, bias in zip(means, roots, neighbours, biases):
            message = mean @ weight + bias + own @ root
            out = message if out is None else np.maximum(out, message)
        out = out * scale + shift
        return pd.Series(list(np.maximum(out, 0.0) if relu else out))

    return apply


def hetero_forward(
    nodes: dict[str, DataFrame],
    edges: dict[tuple[str, str, str], DataFrame],
    layers: Sequence[tuple[dict[str, Convolution], dict[str, Norm] | None]],
    head: Affine,
    dim: int,
    target: str = "Admission",
) -> DataFrame:
    """Inference of a message-passing classifier: all layers with relu, then two logits of the target nodes.

    The node tables are written after each layer, which keeps the plan of the next one short.
    """
    for depth, (weights, norms) in enumerate(layers):
        nodes = hetero_layer(nodes, edges, weights, dim, norms)
        if depth + 1 < len(layers):
            nodes = {name: materialize(table, f"layer{depth}") for name, table in nodes.items()}
    return nodes[target].select("id", affine(F.col("vector"), head).alias("logits"))


def neighbourhood_features(
    features: DataFrame, item_edges: dict[str, DataFrame], dim: int, id_col: str = "hadm_id"
) -> DataFrame:
    """Own features plus, per edge type, the mean feature vector of cases that share items.

    Two weight-free hops (case -> item -> case) as in simplified graph convolutions:
    ``item_edges`` maps an edge type to (case, item) pairs. Result: id and ``features``.
    """
    own = features.select(F.col(id_col).alias("id"), F.col("features").alias("vector"))
    joined = own
    names = []
    for i, pairs in enumerate(item_edges.values()):
        forward = pairs.select(F.col("case").alias("src"), F.col("item").alias("dst"))
        backward = pairs.select(F.col("item").alias("src"), F.col("case").alias("dst"))
        items = neighbour_means(forward, own, dim).select(F.col("dst").alias("id"), "vector")
        context = neighbour_means(backward, items, dim)
        joined = joined.join(context.select(F.col("dst").alias("id"), F.col("vector").alias(f"h{i}")), "id", "left")
        names.append(f"h{i}")
    parts = [F.col("vector"), *[F.coalesce(F.col(n), zeros(dim)) for n in names]]
    return joined.select(F.col("id").alias(id_col), F.concat(*parts).alias("features"))

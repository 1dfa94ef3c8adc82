"""Near-duplicate vectors within a label: int8 tile products with rigorous error bounds.

Equal vectors form one class. Class representatives of a label are dealt to blocks of bounded
size; a tile multiplies the int8 codes of two blocks. With codes ``s c`` and errors ``e`` the true
product differs from ``s s' c.c'`` by at most ``|sc||e'| + |e||s'c'| + |e||e'|``, so only pairs
above the threshold by that margin are recomputed, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendwatch.llm.components import connected_components
from lendwatch.llm.vectors import is_finite, packed, stacked
from lendwatch.storage import materialize

TILES = "label string, dim int, block long, ids binary, codes binary, scales binary, norms binary, errors binary"


@dataclass(frozen=True)
class LinkConfig:
    threshold: float = 0.93
    block_rows: int = 1024
    slack: float = 1e-6  # far above the rounding of the bounds themselves


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, norms of the coded vectors and norms of their errors, of unit vectors."""
    # Scaled by the largest component first: squares of tiny or huge values would not survive.
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    scales = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scales[:, None]).astype(np.int8)
    coded = codes * scales[:, None]
    return codes, scales, np.linalg.norm(coded, axis=1), np.linalg.norm(unit - coded, axis=1)


def possible_pairs(a: tuple, b: tuple, threshold: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs whose cosine may reach the threshold."""
    dim = a[0].shape[1]
    # Products of int8 summed in floating point are exact while the sum fits the mantissa.
    kind = np.float32 if dim * 127 * 127 < 1 << 24 else np.float64
    product = (a[0].astype(kind) @ b[0].astype(kind).T) * a[1][:, None] * b[1][None, :]
    margin = a[2][:, None] * b[3][None, :] + a[3][:, None] * (b[2] + b[3])[None, :]
    return np.nonzero(product + margin >= threshold - slack)


def _blocks(classes: DataFrame, cfg: LinkConfig) -> DataFrame:
    counts = classes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / cfg.block_rows)
    dealt = classes.join(counts, ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("rep"), blocks))

    def pack(key, rows):
        codes, scales, norms, errors = quantise(stacked(rows["vector"], key[1]))
        row = [*key, packed(rows["rep"].to_numpy(np.int64)), packed(codes), packed(scales), packed(norms), packed(errors)]
        return pd.DataFrame([row], columns=["label", "dim", "block", "ids", "codes", "scales", "norms", "errors"])

    return materialize(dealt.groupBy("label", "dim", "block").applyInPandas(pack, TILES), "tiles")


def _candidates(tiles: DataFrame, cfg: LinkConfig) -> DataFrame:
    """Pairs of representatives that may be linked, each once."""
    last = tiles.groupBy("label", "dim").agg(F.max("block").alias("last"))
    parts = ("ids", "codes", "scales", "norms", "errors")
    left = tiles.join(last, ["label", "dim"]).withColumn("other", F.explode(F.sequence("block", "last")))
    right = tiles.select("label", "dim", F.col("block").alias("other"), *[F.col(c).alias(f"r_{c}") for c in parts])
    pairs = left.join(right, ["label", "dim", "other"])

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def side(r: dict, name: str) -> tuple:
            codes = np.frombuffer(r[f"{name}codes"], np.int8).reshape(-1, r["dim"])
            return codes, *[np.frombuffer(r[name + c]) for c in ("scales", "norms", "errors")]

        for batch in batches:
            for r in batch.to_pylist():
                i, j = possible_pairs(side(r, ""), side(r, "r_"), cfg.threshold, cfg.slack)
                if r["block"] == r["other"]:
                    i, j = i[i < j], j[i < j]
                u, v = np.frombuffer(r["ids"], np.int64)[i], np.frombuffer(r["r_ids"], np.int64)[j]
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    kept = ["dim", "block", "other", *parts, *[f"r_{c}" for c in parts]]
    return pairs.select(*kept).mapInArrow(multiply, "u long, v long")


def link(rows: DataFrame, cfg: LinkConfig = LinkConfig()) -> DataFrame:
    """Add ``n_links, component_id, kept`` to the rows of ``(vec_id, label, embedding)``.

    A row whose id, label or vector is NULL, or whose vector is empty, zero or has a NULL or
    non-finite component, links with nothing and is its own component. Vectors of different
    lengths are not linked. Rows that repeat an id and vector count as vectors of their own.
    Labels of any type are compared as written out. Components may be as small or large as a
    double: vectors are scaled by a power of two before their cosine is taken.
    Within a label all classes are compared, tile by tile; copies are one class, counted.
    """
    vector = F.col("embedding").cast("array<double>")
    zero = F.coalesce(F.forall("embedding", lambda x: x == 0), F.lit(True))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_finite(F.col("embedding")) & ~zero
    valid = rows.filter(usable).select("vec_id", F.col("label").cast("string").alias("label"), vector.alias("vector"))
    classes = materialize(
        valid.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("dim", F.size("vector")), "classes")
    unique = materialize(_own_numbers(classes), "class-numbers")
    tiles = _blocks(unique.select("label", "dim", F.col("key").alias("rep"), "vector"), cfg)
    # A power of two changes no digit, and squares of tiny or huge components survive.
    scale = F.pow(F.lit(2.0), F.floor(F.log2(F.array_max(F.transform("vector", F.abs)))))
    scaled = unique.withColumn("scale", scale).select("key", F.transform("vector", lambda x: x / F.col("scale")).alias("vector"))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda t, x: t + x * x))
    sides = scaled.select("key", "vector", norm.alias("norm"))
    dot = F.aggregate(F.zip_with("x", "y", lambda p, q: p * q), F.lit(0.0), lambda t, p: t + p)
    exact = (
        _candidates(tiles, cfg)
        .join(sides.select(F.col("key").alias("u"), F.col("vector").alias("x"), F.col("norm").alias("nx")), "u")
        .join(sides.select(F.col("key").alias("v"), F.col("vector").alias("y"), F.col("norm").alias("ny")), "v")
        .filter(dot / (F.col("nx") * F.col("ny")) >= cfg.threshold)
        .select("u", "v")
    )
    edges = materialize(exact, "links")
    copies = unique.select(F.col("key").alias("v"), "copies")
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    degrees = both.join(copies, "v").groupBy("u").agg(F.sum("copies").alias("linked")).withColumnRenamed("u", "key")
    components = connected_components(edges).withColumnRenamed("node", "key")
    # The lowest id of a component, over the ids of its classes.
    placed = unique.join(components, "key", "left").withColumn("component", F.coalesce("component", "key"))
    lowest = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    told = (
        placed.join(lowest, "component").join(degrees, "key", "left")
        .select(F.col("label").alias("c_label"), F.col("vector").alias("c_vector"), "component_id",
                (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    kept = [c for c in rows.columns if c not in ("n_links", "component_id", "kept")]
    own = rows.select(*[F.col(f"`{c}`") for c in kept], F.when(usable, vector).alias("__v"))
    same = (F.col("label").cast("string") == F.col("c_label")) & (F.col("__v") == F.col("c_vector"))
    return own.join(told, same, "left").select(
        *[F.col(f"`{c}`") for c in kept],
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _own_numbers(classes: DataFrame) -> DataFrame:
    """``key``: the representative's id, or a hash where several classes share that id."""
    # As many rows in a window as distinct vectors have one id.
    nth = F.row_number().over(Window.partitionBy("rep").orderBy("label", "vector"))
    numbered = classes.withColumn("nth", nth)
    clash = F.xxhash64("rep", "label", "vector")
    return numbered.withColumn("key", F.when(F.col("nth") == 1, F.col("rep")).otherwise(clash)).drop("nth")


def link_report(embeddings: DataFrame, cfg: LinkConfig = LinkConfig()) -> DataFrame:
    found = link(embeddings.select("vec_id", "label", "embedding"), cfg)
    return found.select("vec_id", "n_links", "component_id", "kept")

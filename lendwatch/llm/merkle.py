"""Merkle manifest of a dataset, its subtrees stored in van Emde Boas order.

A tree of fan-out 16 stands over the rows of each source, and one more over the sources. Aligned
subtrees of bounded height are one stored row each: their digests lie in an array split recursively
at half height, so a node and its siblings are found by address arithmetic alone. The roots of these
blocks are the leaves of the next layer, until one is left. Proofs come down the same layers: each
block adds its siblings to the path it was handed and hands it on to the blocks below.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendwatch.operators.ordering import row_numbers
from lendwatch.storage import materialize

WIDTH = 32  # bytes of a digest
BLOCK = "tree string, layer int, block long, size long, edges int, count int, nodes binary, root binary"
PATH = "array<struct<left: string, right: string>>"
PROVED = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"
_CHILDREN = 256  # paths handed on in one batch
_OF_ALL = ""  # the tree over the sources; those of sources begin with 0 or 1

Path = tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class ManifestConfig:
    """``edges``: height of a stored subtree, which has up to ``fanout ** edges`` leaves."""

    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")
    fanout: int = 16
    edges: int = 2

    @property
    def span(self) -> int:
        return self.fanout**self.edges


def nodes_in(levels: int, fanout: int) -> int:
    """Nodes of a complete tree."""
    return (fanout**levels - 1) // (fanout - 1)


@lru_cache(maxsize=256)
def addresses(depth: int, levels: int, fanout: int) -> np.ndarray:
    """Places of the nodes at ``depth`` of a tree of ``levels``: the upper half of the levels comes
    first, then the subtrees below it one after the other, each laid out by the same rule."""
    index = np.arange(fanout**depth)
    if levels == 1:
        return index
    upper = levels // 2
    if depth < upper:
        return addresses(depth, upper, fanout)
    lower, below = levels - upper, depth - upper
    subtree, inside = np.divmod(index, fanout**below)
    inner = addresses(below, lower, fanout)[inside]
    return nodes_in(upper, fanout) + subtree * nodes_in(lower, fanout) + inner


def digest_of(children: Iterable[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def height(leaves: int, fanout: int) -> int:
    """Levels above the leaves until one node is left."""
    edges = 0
    while leaves > 1:
        leaves, edges = -(-leaves // fanout), edges + 1
    return edges


class Subtree:
    """An aligned subtree; the rightmost one of a tree may lack nodes at its right edge."""

    def __init__(self, nodes: bytes, leaves: int, edges: int, fanout: int):
        self.nodes, self.edges, self.fanout = nodes, edges, fanout
        self.counts = [leaves]
        for _ in range(edges):
            self.counts.insert(0, -(-self.counts[0] // fanout))

    @classmethod
    def build(cls, leaves: list[bytes], edges: int, fanout: int) -> Subtree:
        tree = cls(b"", len(leaves), edges, fanout)
        last = max(int(tree._places(d)[-1]) for d in range(edges + 1))
        stored = np.zeros((last + 1, WIDTH), np.uint8)
        row = leaves
        for depth in range(edges, -1, -1):
            stored[tree._places(depth)] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, WIDTH)
            row = [bytes.fromhex(digest_of(n.hex() for n in row[i : i + fanout])) for i in range(0, len(row), fanout)]
        tree.nodes = stored.tobytes()
        return tree

    def _places(self, depth: int) -> np.ndarray:
        return addresses(depth, self.edges + 1, self.fanout)[: self.counts[depth]]

    def node(self, depth: int, index: int) -> str:
        at = int(self._places(depth)[index]) * WIDTH
        return self.nodes[at : at + WIDTH].hex()

    def siblings(self, depth: int, index: int) -> tuple[str, str]:
        """The digests before and after a node in its run."""
        first = index - index % self.fanout
        run = [self.node(depth, i) for i in range(first, min(first + self.fanout, self.counts[depth]))]
        return "".join(run[: index - first]), "".join(run[index - first + 1 :])

    def paths(self, above: Path = ()) -> list[Path]:
        """For each leaf its siblings up to the subtree's root, then ``above``."""
        found = [above]
        for depth in range(1, self.edges + 1):
            found = [(self.siblings(depth, i), *found[i // self.fanout]) for i in range(self.counts[depth])]
        return found


def folded(leaf: str, path: Path) -> str:
    for left, right in path:
        leaf = digest_of((left, leaf, right))
    return leaf


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Iterable[Column]) -> Column:
    """Digest of a row: each field with its length in bytes in front, ``-`` for NULL."""
    return F.sha2(F.concat(*[_encoded(f) for f in fields]), 256)


def leaves_of(docs: DataFrame, cfg: ManifestConfig = ManifestConfig(), claimed: Column | None = None) -> DataFrame:
    """``(doc_id, tree, leaf, claimed)``; ``claimed`` is a digest to check against the manifest, or NULL."""
    leaf = leaf_digest([F.col(f) for f in cfg.fields])
    tree = F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0"))  # NULL before all others
    return docs.select("doc_id", tree.alias("tree"), leaf.alias("leaf"), (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"))


def _layer(items: DataFrame, layer: int, cfg: ManifestConfig) -> DataFrame:
    """Blocks over ``items(tree, place, size, digest)``; places count from 0, ``size`` is the tree's."""

    def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        tree, block = (k.as_py() for k in key)
        rows = rows.sort_by("place")
        size = rows["size"][0].as_py()
        edges = min(cfg.edges, height(size, cfg.fanout))
        made = Subtree.build(rows["digest"].to_pylist(), edges, cfg.fanout)
        return pa.table(
            {"tree": [tree], "layer": pa.array([layer], pa.int32()), "block": [block], "size": [size],
             "edges": pa.array([edges], pa.int32()), "count": pa.array([rows.num_rows], pa.int32()),
             "nodes": pa.array([made.nodes], pa.binary()), "root": pa.array([bytes.fromhex(made.node(0, 0))], pa.binary())})

    placed = items.select("tree", F.floor(F.col("place") / cfg.span).alias("block"), "place", "size", "digest")
    return materialize(placed.groupBy("tree", "block").applyInArrow(build, BLOCK), f"blocks-{layer}")


def _grow(items: DataFrame, cfg: ManifestConfig) -> list[DataFrame]:
    """The layers of blocks over all trees of ``items``, the leaves' first."""
    layers = [_layer(items, 0, cfg)]
    while (layers[-1].agg(F.max("size").alias("m")).first().m or 0) > cfg.span:
        below = layers[-1].filter(F.col("size") > cfg.span)
        size = F.ceil(F.col("size") / cfg.span)
        layers.append(_layer(below.select("tree", F.col("block").alias("place"), size.alias("size"), F.col("root").alias("digest")), len(layers), cfg))
    return layers


def _tops(layers: list[DataFrame], cfg: ManifestConfig) -> DataFrame:
    """``(tree, root)``: the block of each tree that ends it."""
    ends = [l.filter(F.col("size") <= cfg.span).select("tree", "root") for l in layers]
    found = ends[0]
    for more in ends[1:]:
        found = found.unionByName(more)
    return found


@dataclass(frozen=True)
class Manifest:
    """Placed leaves, the layers of blocks of the sources and of the tree over them, and the root."""

    cfg: ManifestConfig
    leaves: DataFrame
    layers: list[DataFrame]
    sources: DataFrame
    over: list[DataFrame]
    root: str | None


def build(leaves: DataFrame, cfg: ManifestConfig = ManifestConfig()) -> Manifest:
    """The manifest of ``leaves_of`` a dataset.

    Leaves ascend by id in their source (NULL first, equal ids by digest); sources ascend by their
    bytes, NULL first. An empty dataset has no root. Every group of rows is a block of at most
    ``fanout ** edges`` digests, whatever the size of a source.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    placed = materialize(row_numbers(leaves, order, "place", ["tree"]), "leaves")
    placed = placed.withColumns({"place": F.col("place") - 1, "size": F.col("place_total")})
    layers = _grow(placed.select("tree", "place", "size", F.unhex("leaf").alias("digest")), cfg)
    sources = materialize(row_numbers(_tops(layers, cfg), [F.col("tree")], "place"), "sources")
    items = sources.select(F.lit(_OF_ALL).alias("tree"), (F.col("place") - 1).alias("place"), F.col("place_total").alias("size"), F.col("root").alias("digest"))
    over = _grow(items, cfg)
    top = _tops(over, cfg).first()
    return Manifest(cfg, placed, layers, sources, over, top and bytes(top.root).hex())


def _handed_down(blocks: DataFrame, cfg: ManifestConfig) -> DataFrame:
    """``(tree, block, path)`` for the children of ``blocks`` that come with their own ``path``."""

    def expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                made = Subtree(row["nodes"], row["count"], row["edges"], cfg.fanout)
                paths = made.paths(_read(row["path"]))
                for at in range(0, len(paths), _CHILDREN):
                    some = paths[at : at + _CHILDREN]
                    first = row["block"] * cfg.span + at
                    told = [[{"left": l, "right": r} for l, r in p] for p in some]
                    struct = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["tree"]] * len(some), pa.string()), pa.array(range(first, first + len(some)), pa.int64()), pa.array(told, struct)],
                        ["tree", "block", "path"])

    return blocks.select("tree", "block", "edges", "count", "nodes", "path").mapInArrow(expand, f"tree string, block long, path {PATH}")


def _read(path: list[dict]) -> Path:
    return tuple((p["left"], p["right"]) for p in path)


def _with_paths(layers: list[DataFrame], tops: DataFrame, cfg: ManifestConfig) -> DataFrame:
    """The blocks of the first layer with the ``path`` above them; ``tops(tree, path)`` ends each tree."""
    handed = None
    for i in range(len(layers) - 1, -1, -1):
        # A tree's last block gets its path from outside, all others from the block above.
        paths = tops.join(layers[i].filter(F.col("size") <= cfg.span).select("tree", "block"), "tree").select("tree", "block", "path")
        if handed is not None:
            paths = paths.unionByName(handed)
        found = layers[i].join(paths, ["tree", "block"])
        if i:
            handed = materialize(_handed_down(found, cfg), "paths")
    return found


def prove(manifest: Manifest) -> DataFrame:
    """``(doc_id, leaf, subroot, proof_sha256, folded_root)`` for every leaf.

    The proof is the siblings from the leaf to the root, here as one digest; the root is folded from
    the claimed digest where there is one, else from the leaf.
    """
    cfg = manifest.cfg
    start = manifest.over[-1].filter(F.col("size") <= cfg.span).select("tree", F.expr(f"cast(array() as {PATH})").alias("path"))
    over = _with_paths(manifest.over, start, cfg)
    places = _handed_down(over, cfg).withColumnRenamed("block", "at").select("at", "path")
    tops = manifest.sources.join(places, F.col("at") == F.col("place") - 1).select("tree", "path", F.hex("root").alias("subroot"))
    tops = materialize(tops, "tops")
    blocks = _with_paths(manifest.layers, tops.select("tree", "path"), cfg)
    blocks = blocks.join(tops.select("tree", F.lower("subroot").alias("subroot")), "tree")

    def fold(key: tuple[pa.Scalar, ...], leaves: pa.Table, block: pa.Table) -> pa.Table:
        (row,) = block.to_pylist()
        paths = Subtree(row["nodes"], row["count"], row["edges"], cfg.fanout).paths(_read(row["path"]))
        mine = [paths[p % cfg.span] for p in leaves["place"].to_pylist()]
        own = leaves["leaf"].to_pylist()
        claimed = [c or o for c, o in zip(leaves["claimed"].to_pylist(), own, strict=True)]
        proofs = [digest_of(left + right for left, right in p) for p in mine]
        roots = [folded(c, p) for c, p in zip(claimed, mine, strict=True)]
        return pa.table(
            {"doc_id": leaves["doc_id"].cast(pa.int64()), "leaf": pa.array(own, pa.string()), "subroot": pa.array([row["subroot"]] * len(own), pa.string()),
             "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(roots, pa.string())})

    leaves = manifest.leaves.select("tree", F.floor(F.col("place") / cfg.span).alias("block"), "place", "doc_id", "leaf", "claimed")
    above = blocks.select("tree", "block", "edges", "count", "nodes", "path", "subroot")
    return leaves.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(fold, PROVED)


def manifest_report(docs: DataFrame, cfg: ManifestConfig = ManifestConfig()) -> DataFrame:
    """Every document proved against the manifest, some of them with a changed text.

    Where 5 divides the crc32 of the id, the claimed row has its A-Z in lower case. NULL fields are
    part of the digest; a row without an id is unchanged and comes first in its source. Rows that
    repeat are leaves of their own. Other columns are not read.
    """
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate("text", capitals, capitals.lower())
    tampered = leaf_digest([lowered if f == "text" else F.col(f) for f in cfg.fields])
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    manifest = build(leaves_of(docs, cfg, F.when(chosen, tampered)), cfg)
    root = F.lit(manifest.root).cast("string")
    return prove(manifest).select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))

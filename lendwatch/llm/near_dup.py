"""Near-duplicate documents by SetSketch registers: band, estimate by likelihood, verify.

A document's shingles fill registers ``floor(1 - log_b(h))`` of exponentially distributed minima
``h``, truncated to a range; the register-wise maximum of two sketches is the sketch of the union,
and two registers are equal about as often as the sets are similar. Bands of equal registers join
documents to candidate components. Only those components' texts travel: in blocks of bounded size
pairs that share a band are first judged by the joint likelihood of their registers, then on the
full sets. Within a block, pairs that are connected already are not compared again. A Bloom filter keeps
the other documents' texts out of the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendwatch.llm.bloom import narrowed
from lendwatch.llm.components import connected_components
from lendwatch.llm.kept import kept_by, small_batches
from lendwatch.storage import materialize

SIGNED = "doc_id long, n_shingles long, digest binary, registers binary"
EDGES = "u long, v long"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_CACHED_WORDS = 300_000
_TOGETHER = 1_000_000  # shingles whose marks are counted at once


@dataclass(frozen=True)
class SketchConfig:
    """``share``: documents are linked when 100 * intersection >= share * union."""

    words: int = 5
    share: int = 85
    bands: int = 30
    rows: int = 7
    base: float = 1.02
    rate: float = 20.0
    top: int = 65534
    reject: float = 30.0  # twice the log likelihood by which a pair must fall short to be dropped
    block_shingles: int = 2_000_000

    @property
    def registers(self) -> int:
        return self.bands * self.rows


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a shorter text is one shingle as a whole."""
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens), seed=1)], np.uint64)
    own = np.fromiter(map(_hashes.__getitem__, tokens), np.uint64, len(tokens))
    mixed = np.zeros(len(own) - words + 1, np.uint64)
    for i in range(words):
        mixed = (mixed ^ own[i : i + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def _seeds(cfg: SketchConfig) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(7).integers(0, 1 << 64, size=(2, cfg.registers), dtype=np.uint64)
    return drawn[0], drawn[1] | np.uint64(1)


def sketch(shingles: np.ndarray, cfg: SketchConfig) -> np.ndarray:
    """Registers of a set: its minima as exponential variables of ``rate``, on a scale of ``base``."""
    mask, factor = _seeds(cfg)
    lowest = np.full(cfg.registers, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 512):  # bounded memory for very long texts
        part = (shingles[at : at + 512, None] ^ mask) * factor
        np.minimum(lowest, part.min(axis=0), out=lowest)
    exponential = -np.log1p(-(lowest.astype(np.float64) + 0.5) / 2.0**64) / cfg.rate
    values = np.floor(1 - np.log(exponential) / np.log(cfg.base))
    return np.clip(values, 0, cfg.top + 1).astype(np.uint16)


def log_likelihood(counts: np.ndarray, share: np.ndarray, similarity: np.ndarray, base: float) -> np.ndarray:
    """Joint log likelihood of (greater, smaller, equal) registers of two sets.

    ``share`` is the first set's part of the two sizes, ``similarity`` the Jaccard similarity. A
    register of the first is greater with probability ``p(u - v J)``, of the second ``p(v - u J)``.
    """
    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / np.log(base)

    u, v = share, 1 - share
    greater, smaller = p(u - v * similarity), p(v - u * similarity)
    chances = np.stack([greater, smaller, np.maximum(1 - greater - smaller, 0)])
    return (counts * np.log(np.maximum(chances, 1e-300))).sum(axis=0)


def _slope(counts: np.ndarray, share: np.ndarray, similarity: np.ndarray, base: float) -> np.ndarray:
    """Derivative of the log likelihood by the similarity."""
    u, v, c = share, 1 - share, (base - 1) / base
    one, two = u - v * similarity, v - u * similarity
    greater, smaller = -np.log1p(-one * c), -np.log1p(-two * c)
    by_one, by_two = -v * c / (1 - one * c), -u * c / (1 - two * c)
    equal = np.maximum(np.log(base) - greater - smaller, 1e-300)
    small = 1e-300
    return counts[0] * by_one / np.maximum(greater, small) + counts[1] * by_two / np.maximum(smaller, small) - counts[2] * (by_one + by_two) / equal


def may_reach(one: np.ndarray, others: np.ndarray, n_one: int, n_others: np.ndarray, cfg: SketchConfig) -> np.ndarray:
    """Which pairs may have the wanted similarity: sizes allow it and the likelihood is not hopeless.

    The likelihood has one maximum; halving by its slope finds it where that matters, below the
    wanted similarity.
    """
    least = cfg.share / 100
    small, large = np.minimum(n_one, n_others), np.maximum(n_one, n_others)
    reach = np.flatnonzero(small * 100 >= cfg.share * large)
    ok = np.zeros(len(n_others), bool)
    if not len(reach):
        return ok
    some = others[reach]
    counts = np.stack([(one > some).sum(axis=1), (one < some).sum(axis=1), (one == some).sum(axis=1)]).astype(float)
    share = n_one / (n_one + n_others[reach])
    wanted = np.full(len(reach), least)
    rising = _slope(counts, share, wanted, cfg.base) >= 0
    ok[reach[rising]] = True
    falling = np.flatnonzero(~rising)
    if len(falling):
        counts, share, wanted = counts[:, falling], share[falling], wanted[falling]
        low, high = np.zeros(len(falling)), wanted.copy()
        for _ in range(10):
            middle = (low + high) / 2
            up = _slope(counts, share, middle, cfg.base) >= 0
            low, high = np.where(up, middle, low), np.where(up, high, middle)
        best = log_likelihood(counts, share, low, cfg.base)
        ok[reach[falling]] = 2 * (best - log_likelihood(counts, share, wanted, cfg.base)) < cfg.reject
    return ok


def band_keys(registers: np.ndarray, cfg: SketchConfig) -> list[int]:
    raw = registers.reshape(cfg.bands, cfg.rows)
    return [xxhash.xxh3_64_intdigest(raw[i].tobytes(), seed=i) - (1 << 63) for i in range(cfg.bands)]


def links_of(
    sets: list[np.ndarray], registers: np.ndarray, joined: np.ndarray, cfg: SketchConfig
) -> list[tuple[int, int]]:
    """Links that connect whatever is linked among documents that share a band.

    Documents marked ``joined`` are known to be connected. Each document in turn is compared at once
    with all later ones it is not connected to yet: its shingles are marked, and the marks counted in
    the others' lists. So a pair costs one step for each shingle, no pair is remembered, and one link
    spares the rest of that component.
    """
    n = len(sets)
    component = np.arange(n)
    if joined.any():
        component[joined] = np.flatnonzero(joined)[0]
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    marks = np.zeros(int(numbers.max()) + 1, bool)
    keys = np.array([band_keys(r, cfg) for r in registers], np.int64)
    found = []
    for i in range(n - 1):
        later = np.flatnonzero(component[i + 1 :] != component[i]) + i + 1
        later = later[(keys[later] == keys[i]).any(axis=1)]
        later = later[may_reach(registers[i], registers[later], int(sizes[i]), sizes[later], cfg)]
        if not len(later):
            continue
        own = numbers[ends[i] - sizes[i] : ends[i]]
        marks[own] = True
        for some in np.array_split(later, int(sizes[later].sum()) // _TOGETHER + 1):
            if not len(some):
                continue
            starts = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
            shift = np.repeat(ends[some] - sizes[some] - starts, sizes[some])
            both = np.add.reduceat(marks[numbers[shift + np.arange(len(shift))]], starts, dtype=np.int64)
            for j in some[100 * both >= cfg.share * (sizes[i] + sizes[some] - both)].tolist():
                if component[i] != component[j]:
                    component[component == component[j]] = component[i]
                    found.append((i, j))
        marks[own] = False
    return found


def _sign(docs: DataFrame, cfg: SketchConfig) -> DataFrame:
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by("near_dup")
        for batch in batches:
            sizes, digests, registers = [], [], []
            for text in batch.column(1):
                own = shingle_set(text.as_py(), cfg.words)
                sizes.append(len(own))
                digests.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                registers.append(sketch(own, cfg).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(registers, pa.binary())],
                ["doc_id", "n_shingles", "digest", "registers"],
            )
        _hashes.clear()  # the worker process goes on to other stages

    return docs.select("doc_id", "text").mapInArrow(sign, SIGNED)


def _bands(signed: DataFrame, cfg: SketchConfig) -> DataFrame:
    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by("near_dup")
        for batch in batches:
            keys = [band_keys(np.frombuffer(r.as_py(), np.uint16), cfg) for r in batch.column(1)]
            ids = np.repeat(batch.column(0).to_numpy(), cfg.bands)
            flat = np.array(keys, np.int64).reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(flat, pa.int64())], ["rep", "band"])

    return signed.select("rep", "registers").mapInArrow(split, "rep long, band long")


def _verified(texts: DataFrame, cfg: SketchConfig) -> DataFrame:
    """Links within each block of ``texts(block, rep, joined, text)``."""

    def verify(rows):
        kept_by("near_dup")
        sets = [shingle_set(t, cfg.words) for t in rows["text"]]
        some = np.array([len(s) > 0 for s in sets])  # an id may have a wordless text besides
        ids, joined = rows["rep"].to_numpy()[some], rows["joined"].to_numpy()[some]
        sets = [s for s in sets if len(s)]
        registers = np.stack([sketch(s, cfg) for s in sets])
        pairs = links_of(sets, registers, joined, cfg)
        return pd.DataFrame({"u": [ids[i] for i, _ in pairs], "v": [ids[j] for _, j in pairs]}, dtype="int64")

    return texts.groupBy("block").applyInPandas(verify, EDGES)


def cluster(docs: DataFrame, cfg: SketchConfig = SketchConfig()) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text)``.

    Words are runs of non-white characters, A-Z lower-cased. NULL and wordless texts have no
    shingles and link with nothing. Rows without an id link with nothing, have no component and are
    kept. Rows that repeat an id are one document with several texts. A document without links is
    its own component; of each component the smallest id is kept. Shingles are compared by 64-bit
    hashes. Two texts just at the threshold share no band with probability 1e-5.
    """
    small_batches(docs.sparkSession)
    signed = materialize(_sign(docs, cfg), "signatures")
    usable = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    known = usable.join(classes, "digest")
    copies = known.filter("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    reps = materialize(known.filter("doc_id = rep").select("rep", "n_shingles", "registers"), "representatives")
    bands = _bands(reps, cfg)
    shared = bands.groupBy("band").agg(F.min("rep").alias("v"), F.max("rep").alias("most")).filter("v < most")
    chained = bands.join(shared.select("band", "v"), "band").filter("rep <> v").select(F.col("rep").alias("u"), "v")
    # A document weighs its shingles and, so that blocks of tiny texts stay small, some more.
    weights = reps.groupBy("rep").agg((F.sum("n_shingles") + 200).alias("n"))
    candidates = connected_components(chained)
    placed = materialize(
        weights.join(candidates, F.col("rep") == F.col("node")).select("rep", "n", F.col("component").alias("candidate")),
        "candidates")
    edges = _links(docs, placed, cfg).unionByName(copies)
    components = connected_components(edges).select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))
    told = signed.select("doc_id", "n_shingles").join(components, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return told.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def without_copies(docs: DataFrame, cfg: SketchConfig = SketchConfig()) -> DataFrame:
    """The rows of ``docs`` whose document is kept; repeated rows of a kept id all stay."""
    gone = cluster(docs, cfg).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(materialize(gone, "copies"), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def _labelled(nodes: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    found = connected_components(edges).select(F.col("node").alias("rep"), F.col("component").alias(name))
    return nodes.join(found, "rep", "left").withColumn(name, F.coalesce(name, "rep"))


def _links(docs: DataFrame, placed: DataFrame, cfg: SketchConfig) -> DataFrame:
    """Verified links between representatives, from blocks of their candidate components.

    A component larger than a block is dealt to several by hash; each block also holds the
    component's lowest document. What that leaves apart is then compared across blocks: the
    largest verified part of a component is connected already, so only blocks of the rest meet
    each other and the blocks of the largest part.
    """
    sizes = placed.groupBy("candidate").agg(F.sum("n").alias("total"), F.count("*").alias("docs")).filter("docs > 1")
    blocks = F.ceil(F.col("total") / cfg.block_shingles)
    dealt = placed.join(sizes.select("candidate", blocks.alias("blocks")), "candidate")
    dealt = materialize(dealt.withColumn("part", F.pmod(F.xxhash64("rep"), "blocks")), "blocks")
    texts = narrowed(docs.select(F.col("doc_id").alias("rep"), "text"), dealt.select("rep"), "rep")

    def named(frame: DataFrame) -> DataFrame:
        return frame.select("rep", F.xxhash64("candidate", "part").alias("block"), F.lit(False).alias("joined"))

    lead = dealt.filter("blocks > 1 and rep = candidate").select(
        "rep", "candidate", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("part"))
    where = named(dealt).unionByName(named(lead)).distinct()
    first = materialize(_verified(where.join(texts, "rep"), cfg), "links")
    split = dealt.filter("blocks > 1").select("rep", "candidate", "n")
    if split.isEmpty():
        return first
    parts = materialize(_labelled(split, first, "verified"), "parts")
    weight = parts.groupBy("candidate", "verified").agg(F.sum("n").alias("n"))
    largest = weight.groupBy("candidate").agg(F.max_by("verified", F.struct("n", -F.col("verified"))).alias("largest"))
    open_ = parts.join(largest, "candidate").withColumn("rest", F.col("verified") != F.col("largest"))
    counts = open_.groupBy("candidate").agg(
        *[F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("rest") == r, F.col("n")).otherwise(0)) / (cfg.block_shingles // 2))).alias(name)
          for name, r in (("rests", True), ("bulks", False))], F.max("rest").alias("any"))
    spread = open_.join(counts.filter("any"), "candidate").withColumn(
        "at", F.pmod(F.xxhash64(F.lit(2), "rep"), F.when(F.col("rest"), F.col("rests")).otherwise(F.col("bulks"))))
    # Tiles: (rest i, rest j >= i) and (rest i, bulk j).
    tiles = F.expr(
        "case when rest then concat("
        "transform(sequence(0L, rests - 1), j -> struct(true as r, least(at, j) as i, greatest(at, j) as j)), "
        "transform(sequence(0L, bulks - 1), j -> struct(false as r, at as i, j as j))) "
        "else transform(sequence(0L, rests - 1), i -> struct(false as r, i as i, at as j)) end")
    placed_tiles = spread.select("rep", "candidate", (~F.col("rest")).alias("joined"), F.explode(tiles).alias("t"))
    across = placed_tiles.select("rep", "joined", F.xxhash64("candidate", "t.r", "t.i", "t.j").alias("block"))
    apart = narrowed(docs.select(F.col("doc_id").alias("rep"), "text"), spread.select("rep"), "rep")
    second = materialize(_verified(across.join(apart, "rep"), cfg), "links-across")
    return first.unionByName(second)

"""Periodic runs of words: Lyndon-root candidates extended in both directions by suffix-tree LCE.

Ukkonen's algorithm builds the suffix trees of a stretch of words and of its reversal. Euler tours
answer longest common extensions of two places, forward and backward, in constant time. Of each place
the longest Lyndon word, in the order of the symbols and in the reverse order, is the only candidate
for a run's root; extending it both ways finds every run. Only stretches whose windows of words come
back within reach of a period are worked on: every window inside a run does.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Run = tuple[int, int, int]
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
ADDED = ("runs", "collapsed")
_SCAN = 16  # entries of a block of the range minimum
_SLICE = 4_000_000  # bytes of text answered in one batch


@dataclass(frozen=True)
class RunConfig:
    """A run is at least ``least`` words long and ``exponent`` periods."""

    least: int = 24
    exponent: int = 3

    @property
    def window(self) -> int:
        """Of a run's windows of so many words, each comes back one period before or behind it."""
        return max(self.least * (self.exponent - 2) // self.exponent + 1, 1)


class RangeMin:
    """Minima of ranges in constant time and linear memory: whole blocks by a sparse table."""

    def __init__(self, values: np.ndarray):
        short = -len(values) % _SCAN
        blocks = np.concatenate((values, np.full(short, np.iinfo(np.int32).max, np.int32))).reshape(-1, _SCAN)
        self.values = blocks.reshape(-1)
        self.upto = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        self.onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self.table = [blocks.min(axis=1)]
        while (half := 1 << (len(self.table) - 1)) * 2 <= len(blocks):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Least value of each closed range ``left`` to ``right``."""
        first, last = left // _SCAN, right // _SCAN
        out = np.minimum(self.onward[left], self.upto[right])
        inner = np.flatnonzero(last - first > 1)
        size = (last - first - 1)[inner]
        level = np.frexp(size.astype(float))[1] - 1
        for at in np.unique(level).tolist():
            some = inner[level == at]
            row = self.table[at]
            out[some] = np.minimum(out[some], np.minimum(row[first[some] + 1], row[last[some] - (1 << at)]))
        near = np.flatnonzero(first == last)
        if len(near):
            least, at, end = self.values[left[near]], left[near], right[near]
            for step in range(1, _SCAN):
                least = np.minimum(least, self.values[np.minimum(at + step, end)])
            out[near] = least
        return out


class SuffixTree:
    """Ukkonen's tree of symbols from 1 on, ended by the symbol 0."""

    def __init__(self, symbols: list[int]):
        self.text = [*symbols, 0]
        self.base = max(self.text) + 1
        self._grow()

    def _grow(self) -> None:
        text, base, n = self.text, self.base, len(self.text)
        start, end, link = [-1], [-1], [0]
        child: dict[int, int] = {}  # by node * base + first symbol
        node = length = edge = waiting = 0
        for i, c in enumerate(text):
            waiting += 1
            fresh = 0
            while waiting:
                if not length:
                    edge = i
                key = node * base + text[edge]
                to = child.get(key)
                if to is None:
                    child[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    at = start[to]
                    size = min(end[to], i + 1) - at
                    if length >= size:
                        node = to
                        edge += size
                        length -= size
                        continue
                    if text[at + length] == c:
                        length += 1
                        if fresh and node:
                            link[fresh] = node
                        break
                    split = len(start)
                    start += (at, i)
                    end += (at + length, n)
                    link += (0, 0)
                    child[key] = split
                    start[to] = at + length
                    child[split * base + text[at + length]] = to
                    child[split * base + c] = split + 1
                    if fresh:
                        link[fresh] = split
                    fresh = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        keys = np.fromiter(child.keys(), np.int64, len(child))
        nodes = np.fromiter(child.values(), np.int64, len(child))
        parent, first = keys // base, keys % base
        self.sizes = np.array(end) - np.array(start)
        self.sizes[0] = 0
        self.edges = parent, first, nodes

    def _children(self, first: np.ndarray) -> tuple[list[int], list[int]]:
        """Children of every node in the order of ``first``: offsets by node, and the nodes."""
        parent, _, nodes = self.edges
        order = np.lexsort((first, parent))
        offsets = np.searchsorted(parent[order], np.arange(len(self.sizes) + 1))
        return offsets.tolist(), nodes[order].tolist()

    def suffixes(self, backward: bool = False) -> list[int]:
        """Suffixes in lexicographic order, the end symbol first in either order of the others."""
        first = self.edges[1]
        offsets, nodes = self._children(np.where(first > 0, self.base - first, 0) if backward else first)
        sizes, n = self.sizes.tolist(), len(self.text)
        found, todo = [], [(0, 0)]
        while todo:
            node, depth = todo.pop()
            a, b = offsets[node], offsets[node + 1]
            if a == b:
                found.append(n - depth)
            else:
                todo += [(k, depth + sizes[k]) for k in reversed(nodes[a:b])]
        return found

    def tour(self) -> tuple[np.ndarray, np.ndarray]:
        """Depths along an Euler tour, and where it meets each suffix's leaf."""
        offsets, nodes = self._children(self.edges[1])
        sizes, n = self.sizes.tolist(), len(self.text)
        depths, met = [0], [0] * n
        nexts, path = offsets[:-1], [0]
        above = [0]
        while path:
            node = path[-1]
            at = nexts[node]
            if at < offsets[node + 1]:
                nexts[node] = at + 1
                to = nodes[at]
                depth = above[-1] + sizes[to]
                if offsets[to] == offsets[to + 1]:
                    met[n - depth] = len(depths)
                    depths += (depth, above[-1])
                else:
                    path.append(to)
                    above.append(depth)
                    depths.append(depth)
            else:
                path.pop()
                above.pop()
                if above:
                    depths.append(above[-1])
        return np.array(depths, np.int32), np.array(met, np.int64)


class Extensions:
    """Longest common extension of two different places, by the lowest common ancestor of leaves."""

    def __init__(self, tree: SuffixTree):
        depths, self.met = tree.tour()
        self.least = RangeMin(depths)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        left, right = self.met[a], self.met[b]
        return self.least(np.minimum(left, right), np.maximum(left, right)).astype(np.int64)


def _next_smaller(rank: list[int]) -> np.ndarray:
    """For each place the next one of smaller rank: there its longest Lyndon word ends."""
    out, open_ = [len(rank)] * len(rank), []
    for i, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = i
        open_.append(i)
    return np.array(out[:-1], np.int64)


def runs_of_symbols(symbols: list[int], cfg: RunConfig = RunConfig()) -> set[Run]:
    """Every run ``(start, length, period)`` of symbols from 1 on."""
    n = len(symbols)
    if n < cfg.least:
        return set()
    tree = SuffixTree(symbols)
    ends = []
    for backward in (False, True):
        rank = [0] * (n + 1)
        for at, suffix in enumerate(tree.suffixes(backward)):
            rank[suffix] = at
        ends.append(_next_smaller(rank))
    forward = Extensions(tree)
    del tree
    backward = Extensions(SuffixTree(symbols[::-1]))
    places = np.arange(n)
    found: set[Run] = set()
    for end in ends:
        inside = np.flatnonzero((end < n) | (n - places >= cfg.least))
        i, j = places[inside], end[inside]
        period = j - i
        ahead = np.zeros(len(i), np.int64)
        some = j < n
        ahead[some] = forward(i[some], j[some])
        behind = np.zeros(len(i), np.int64)
        some = i > 0
        behind[some] = backward(n - i[some], n - j[some])
        length = behind + period + ahead
        good = (length >= cfg.exponent * period) & (length >= cfg.least)
        found.update(zip((i - behind)[good].tolist(), length[good].tolist(), period[good].tolist(), strict=True))
    return found


def stretches(hashes: np.ndarray, cfg: RunConfig) -> list[tuple[int, int]]:
    """Half-open ranges of words that hold every run; others have windows that do not come back."""
    k = cfg.window
    done, todo = [], [(0, len(hashes))]
    while todo:
        begin, end = todo.pop()
        n = end - begin
        if n < cfg.least:
            continue
        own = hashes[begin:end]
        mixed = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            mixed = (mixed ^ own[i : i + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        order = np.argsort(mixed, kind="stable")
        ordered = mixed[order]
        # Equal windows no further apart than the longest period of a run in this range.
        back = (ordered[1:] == ordered[:-1]) & (order[1:] - order[:-1] <= n // cfg.exponent)
        again = np.zeros(len(mixed), bool)
        again[order[1:][back]] = True
        again[order[:-1][back]] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([False], again, [False])).astype(np.int8)))
        parts = [(begin + a, begin + b + k - 1) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
        # Fewer words may leave fewer windows; a range that hardly shrinks is searched as it is.
        if sum(b - a for a, b in parts) > 0.9 * n:
            done += parts
        else:
            todo += parts
    return [(a, b) for a, b in done if b - a >= cfg.least]


def runs_of(words: list[bytes], cfg: RunConfig = RunConfig()) -> list[Run]:
    """Every run of equal words, by start and period."""
    found: set[Run] = set()
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    for begin, end in stretches(hashes, cfg):
        numbers: dict[bytes, int] = {}
        symbols = [numbers.setdefault(w, len(numbers) + 1) for w in words[begin:end]]
        found.update((begin + s, length, period) for s, length, period in runs_of_symbols(symbols, cfg))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words with each run cut to its first period, joined by blanks."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, cfg: RunConfig = RunConfig()) -> DataFrame:
    """Rows of ``docs`` with ``runs``, by start and period, and the ``collapsed`` text.

    Words are stretches without white space (blank, tab to carriage return). NULL, empty and wordless
    texts have no runs and collapse to the empty text. Rows are independent: repeated ids stay, and
    columns named ``runs`` and ``collapsed`` are replaced. A text's memory is some 400 bytes for each
    word of its longest periodic stretch.
    """
    kept = [c for c in docs.columns if c not in ADDED]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    run_type = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
    schema = T.StructType([*rows.schema.fields, T.StructField("runs", run_type), T.StructField("collapsed", T.StringType())])
    at, names = kept.index("text"), [*kept, *ADDED]
    arrow_runs = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, size, told, short = 0, 0, [], []
            for row, text in enumerate(batch.column(at).cast(pa.binary())):
                words = (text.as_py() or b"").split()
                found = runs_of(words, cfg)
                told.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                short.append(collapsed(words, found))
                size += len(short[-1])
                if size >= _SLICE or row + 1 == batch.num_rows:
                    extra = [pa.array(told, arrow_runs), pa.array(short, pa.binary()).cast(pa.string())]
                    yield pa.RecordBatch.from_arrays([*batch.slice(first, len(told)).columns, *extra], names)
                    first, size, told, short = row + 1, 0, [], []

    # Plain names inside: a name with a dot cannot be resolved there.
    return rows.toDF(*[f"c{i}" for i in range(len(kept))]).mapInArrow(run, schema)


def runs_report(docs: DataFrame, cfg: RunConfig = RunConfig()) -> DataFrame:
    """Per document the number of runs, the one of greatest exponent, and digests of runs and rest."""
    best = F.expr(
        f"aggregate(runs, try_element_at(cast(array() as {RUNS}), 1), (a, r) -> "
        "case when a is null or r.length * a.period > a.length * r.period then r else a end)")
    told = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    found = periodic_runs(docs.select("doc_id", "text"), cfg).select("doc_id", "runs", "collapsed", best.alias("best"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` where every tenth text, by a hash of its id, repeats a stretch of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    marked = docs.withColumns({
        "__w": F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))), "__g": F.floor(h / 10)})
    sized = marked.withColumn("__n", F.coalesce(F.size("__w"), F.lit(0)))
    cut = sized.withColumn("__a", F.when(F.col("__n") > 0, F.expr("cast(__g % __n as int)")))
    step = cut.withColumn("__p", F.expr("cast(1 + (__n - __a) div (3 + __g % 8) as int)"))
    longer = F.expr("flatten(array_repeat(slice(__w, __a + 1, __p), cast(ceil((__n - __a) / __p) as int)))")
    words = F.concat(F.expr("slice(__w, 1, __a)"), F.slice(longer, F.lit(1), F.col("__n") - F.col("__a")))
    planted = step.withColumn("text", F.when(F.col("__n") > 0, F.array_join(words, " ")).otherwise(F.col("text")))
    return planted.select(*[F.col(f"`{c}`") for c in docs.columns])

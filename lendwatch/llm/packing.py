"""Packing documents into sequences by cutting-stock column generation.

A document is cut into full pieces and one rest. Rests are counted by length class; a linear
program over patterns of classes, whose columns a knapsack recursion prices, says how often each
pattern is used. Rounded patterns are then laid out over the documents by their rank in a class.
Only the histogram, of at most ``capacity / grain`` rows, reaches the driver.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendwatch.llm.kept import kept_by
from lendwatch.operators.ordering import row_numbers
from lendwatch.storage import materialize

_BLANKS = 50_000  # white space characters in a row; 300,000 still go through the pattern of ranks
_LONG_BLANK = re.compile(r"(?<!\s)\s{%d}" % _BLANKS)
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@dataclass(frozen=True)
class PackConfig:
    """``ranks``: the tokenizer's vocabulary as byte strings with ranks, and its split pattern.

    With them ``tiktoken`` encodes, which gives the same ids several times faster; texts with the
    strings of special tokens, and all texts without ranks, go through ``tokenizers``.
    """

    tokenizer: str
    ranks: tuple[str, str] | None = None
    end_id: int = 1
    capacity: int = 2048
    grain: int = 8  # lengths are rounded up to this for the program; never for the pieces


class TextIds:
    """Ids of whole texts, as little-endian 32-bit numbers."""

    def __init__(self, path: str, ranks: tuple[str, str] | None = None):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.exact = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        self.fast = _rank_encoder(*ranks) if ranks else self.exact

    def __call__(self, text: str) -> bytes:
        # Ranks do not know the strings of special tokens, and their pattern takes a stack as deep as
        # a run of white space is long.
        plain = not any(s in text for s in self.special) and not (len(text) > _BLANKS and _LONG_BLANK.search(text))
        encode = self.fast if plain else self.exact
        return array("I", encode(text)).tobytes()


def _rank_encoder(path: str, pattern: str) -> Callable[[str], list[int]]:
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def text_ids(cfg: PackConfig) -> TextIds:
    """One tokenizer per worker process, as long as it packs."""
    loaded: dict[tuple, TextIds] = kept_by("packing")
    key = cfg.tokenizer, cfg.ranks
    if key not in loaded:
        loaded[key] = TextIds(*key)
    return loaded[key]


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of full pieces and the rest, from 32-bit ids."""
    step = 4 * capacity
    parts = [ids[at : at + step] for at in range(0, len(ids), step)]
    return [(i * capacity, len(p) // 4, zlib.crc32(p)) for i, p in enumerate(parts)]


def cut_documents(docs: DataFrame, cfg: PackConfig) -> DataFrame:
    """Pieces of every document; a NULL or empty text is the end id alone."""
    end = array("I", [cfg.end_id]).tobytes()

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_ids(cfg)
        names = [f.split(" ")[0] for f in PIECES.split(", ")]
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                rows += [(key, *piece, len(ids) // 4) for piece in cut(ids, cfg.capacity)]
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return docs.select("doc_id", "text").mapInArrow(pieces, PIECES)


def _best_column(value: np.ndarray) -> tuple[float, dict[int, int]]:
    """Unbounded knapsack: the pattern of classes worth most; ``value[c]`` for class ``c`` > 0."""
    full = len(value) - 1
    best, choice = np.zeros(full + 1), np.zeros(full + 1, int)
    for room in range(1, full + 1):
        worth = value[1 : room + 1] + best[room - 1 :: -1] if room > 1 else value[1:2] + best[:1]
        at = int(worth.argmax())
        if worth[at] > best[room - 1]:
            best[room], choice[room] = worth[at], at + 1
        else:
            best[room], choice[room] = best[room - 1], 0
    pattern: Counter = Counter()
    room = full
    while room:
        if choice[room]:
            pattern[int(choice[room])] += 1
            room -= int(choice[room])
        else:
            room -= 1
    return float(best[full]), dict(pattern)


def _first_basis(demand: dict[int, int], full: int) -> tuple[list[int], list[dict[int, int]]]:
    """A pattern per class: each is used until it exhausts a class, which later ones leave out.

    Classes in the order of exhaustion, and their patterns: a triangular matrix, hence a basis.
    """
    left = {c: float(n) for c, n in demand.items()}
    classes, columns = [], []
    while left:
        value = np.zeros(full + 1)
        for c in left:  # long classes first: the short ones fill gaps later
            value[c] = c / full * (1 + c / full)
        _, pattern = _best_column(value)
        times, gone = min((left[c] / n, c) for c, n in pattern.items())
        classes.append(gone)
        columns.append(pattern)
        for c, n in pattern.items():
            left[c] = max(left[c] - times * n, 0.0)
        del left[gone]
    return classes, columns


def _lower_inverse(lower: np.ndarray) -> np.ndarray:
    inverse = np.zeros_like(lower)
    for i in range(len(lower)):
        inverse[i, i] = 1
        inverse[i] = (inverse[i] - (lower[i, :i, None] * inverse[:i]).sum(axis=0)) / lower[i, i]
    return inverse


def solve_patterns(
    demand: dict[int, int], full: int, gap: float = 1e-4, smoothing: float = 0.8
) -> list[tuple[dict[int, int], float]]:
    """Patterns and how often the linear program uses them, for ``demand`` by class.

    Revised simplex: a column worth more than a sequence enters until Farley's bound shows that
    the optimum is within ``gap``. The knapsack sees prices smoothed towards those of the best
    bound, which start in proportion to length; where that finds no column, the prices count.
    """
    classes, columns = _first_basis(demand, full)
    row = {c: i for i, c in enumerate(classes)}
    need = np.array([demand[c] for c in classes], float)
    inverse = _lower_inverse(np.array([[p.get(c, 0) for p in columns] for c in classes], float))
    used = np.maximum((inverse * need).sum(axis=1), 0)
    centre = np.array(classes) / full
    bound = centre @ need

    def priced(price: np.ndarray) -> tuple[float, dict[int, int]]:
        value = np.zeros(full + 1)
        value[classes] = np.maximum(price, 0)
        return _best_column(value)

    weight = smoothing
    for _ in range(200 * len(classes) + 100):
        if bound >= used.sum() * (1 - gap):
            break
        price = inverse.sum(axis=0)
        near = np.maximum(weight * centre + (1 - weight) * price, 0)
        worth, pattern = priced(near)
        if near @ need / worth > bound:
            bound, centre = near @ need / worth, near / worth
        if sum(price[row[c]] * n for c, n in pattern.items()) <= 1 + 1e-9:
            if weight == 0:
                break  # no column is worth more: this is the optimum
            weight = 0 if weight < 0.1 else weight / 2
            continue
        weight = smoothing
        column = np.zeros(len(classes))
        for c, n in pattern.items():
            column[row[c]] = n
        change = (inverse * column).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            steps = np.where(change > 1e-9, used / change, np.inf)
        leaving = int(steps.argmin())
        step = steps[leaving]
        used = np.maximum(used - step * change, 0)
        used[leaving] = step
        inverse[leaving] /= change[leaving]
        others = np.arange(len(classes)) != leaving
        inverse[others] -= np.outer(change[others], inverse[leaving])
        columns[leaving] = pattern
    return list(zip(columns, used.tolist(), strict=True))


def plan_patterns(demand: dict[int, int], full: int) -> list[tuple[dict[int, int], int]]:
    """Whole patterns that hold the demand exactly: (classes of a sequence, number of sequences).

    Programs' answers are rounded down; what is left, less than one sequence per basic pattern, is
    packed by best fit, largest first.
    """
    demand = {c: n for c, n in demand.items() if n}
    if not demand:
        return []
    left, plan = Counter(demand), Counter()
    for pattern, used in sorted(solve_patterns(demand, full), key=lambda p: (-p[1], sorted(p[0].items()))):
        times = min([int(used + 1e-6), *(left[c] // n for c, n in pattern.items())])
        if times > 0:
            plan[tuple(sorted(pattern.items()))] += times
            for c, n in pattern.items():
                left[c] -= n * times
    open_: list[tuple[int, Counter]] = []  # (room, classes), by room
    for c in sorted(left, reverse=True):
        for _ in range(left[c]):
            fit = min((i for i, (room, _) in enumerate(open_) if room >= c), key=lambda i: open_[i][0], default=None)
            room, held = open_.pop(fit) if fit is not None else (full, Counter())
            held[c] += 1
            open_.append((room - c, held))
    for _, held in open_:
        plan[tuple(sorted(held.items()))] += 1
    return [(dict(pattern), times) for pattern, times in sorted(plan.items())]


def slots(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, end rank, places per sequence, first sequence), a few rows per pattern."""
    dealt, rows, sequence = Counter(), [], 0
    for pattern, times in plan:
        for c, n in sorted(pattern.items()):
            rows.append((c, dealt[c], dealt[c] + n * times, n, sequence))
            dealt[c] += n * times
        sequence += times
    return rows


def pack(docs: DataFrame, cfg: PackConfig) -> DataFrame:
    """One row per piece: its place in the document and in a sequence.

    Documents that repeat an id are cut and packed one by one. Within a length class, pieces are
    ranked by id, start and checksum, so reruns agree. An empty table gives no rows. A sequence is
    padded to ``capacity`` unless its length is a power of two; offsets have no gaps.
    """
    spark = docs.sparkSession
    # Written, as the ordering below reads its rows twice: texts are encoded once.
    pieces = materialize(
        cut_documents(docs, cfg).withColumn("cls", F.ceil(F.col("length") / cfg.grain).cast("int")), "pieces")
    order = [F.col("doc_id").asc_nulls_last(), F.col("start"), F.col("ids_crc32")]
    ranked = materialize(row_numbers(pieces, order, "nth", ["cls"]).drop("nth_total"), "ranked")
    # At most capacity / grain rows.
    demand = {r.cls: r.n for r in ranked.groupBy("cls").agg(F.count("*").alias("n")).collect()}
    dealt = slots(plan_patterns(demand, cfg.capacity // cfg.grain))
    # At most two patterns per class, each with at most as many rows as it has classes.
    places = spark.createDataFrame(dealt, "cls int, low long, high long, per long, first long")
    nth = F.col("nth") - 1
    placed = ranked.join(F.broadcast(places), "cls").filter((nth >= F.col("low")) & (nth < F.col("high")))
    numbered = placed.withColumn("sequence_id", F.col("first") + F.expr("(nth - 1 - low) div per"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("cls"), "nth").rowsBetween(Window.unboundedPreceding, -1)
    return numbered.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"),
    )

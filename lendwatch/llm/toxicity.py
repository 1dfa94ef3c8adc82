"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Terms are words and the beginnings of longer words, known by 64-bit hashes. A bounded sample of
labelled documents gives the terms and the examples; all documents give the document frequencies.
A term's IDF is scaled by how far the sampled labels tell it apart, so that whole vectors are near by
what matters; an example that is judged by the others does not count its own label. Executors build the indexes and let each example be judged by the others; the
votes calibrate the scores. The driver sees term hashes and weights, the vectors piece by piece on
their way to the executors, and a vote for each example.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendwatch.llm.block_max import BlockMaxIndex, Joined, Vector, merged, use_one_thread
from lendwatch.llm.kept import give_back, kept_by, small_batches
from lendwatch.llm.terms import Terms, terms_of_each
from lendwatch.storage import materialize

_PARTS = 64  # ranges of terms whose document counts are added up together
_QUERIES = 512  # texts that are searched together
_FIRST_BITS = 20  # of a hash tell where in the vocabulary it stands
EXAMPLE = "doc_id long, toxic int, n int, packed binary"


@dataclass(frozen=True)
class ToxicConfig:
    """``examples``: the bound of the fitted sample, taken by a hash of the id.

    ``prefix``: the length of word beginnings that are terms too. ``even``: the weight, in units of
    one natural log odds, of a term that both labels use alike; ``smoothing``: the examples by which
    the odds start from the labels' shares. ``shard``: examples of an index; ``piece``: bytes of them
    that pass through the driver at a time.
    """

    examples: int = 20_000
    prefix: int = 5
    even: float = 0.2
    smoothing: float = 3.0
    neighbours: int = 15
    block: int = 32
    shard: int = 32_768
    piece: int = 8_000_000
    prior_weight: float = 0.2
    threshold: float = 0.5


class Vocabulary:
    """Known terms, ascending by hash, with their IDF and how many toxic and clean examples have them."""

    def __init__(self, hashes: np.ndarray, idf: np.ndarray, toxic: np.ndarray, clean: np.ndarray, sizes: tuple[int, int], cfg: ToxicConfig):
        """``sizes``: toxic and clean examples."""
        self.hashes, self.idf, self.sizes, self.cfg = hashes, idf.astype(np.float32), sizes, cfg
        self.toxic, self.clean = toxic.astype(np.int32), clean.astype(np.int32)
        self.weights = self._weights(np.arange(len(hashes)), None).astype(np.float32)

    @cached_property
    def ranges(self) -> np.ndarray:
        return begins(self.hashes)

    def _weights(self, numbers: np.ndarray, own: int | None) -> np.ndarray:
        """IDF times the log odds between the labels, which start from the share of either label."""
        a, b, (n_toxic, n_clean) = self.toxic[numbers], self.clean[numbers], self.sizes
        if own is not None:
            a, b = a - own, b - (1 - own)
        share = self.cfg.smoothing / max(n_toxic + n_clean, 1)
        start = share * max(n_toxic, 0.5), share * max(n_clean, 0.5)
        odds = np.log((a + start[0]) / (n_toxic + 2 * start[0])) - np.log((b + start[1]) / (n_clean + 2 * start[1]))
        return self.idf[numbers] * (self.cfg.even + np.abs(odds))

    def vector(self, numbers: np.ndarray, counts: np.ndarray, own: int | None = None) -> Vector:
        """Normalised weights, (1 + log tf) times the term's weight; ``own``: an example's label, not to be counted."""
        weights = (1 + np.log(counts)) * (self.weights[numbers] if own is None else self._weights(numbers, own))
        norm = np.sqrt(weights @ weights)
        return numbers, (weights / norm if norm else weights).astype(np.float32)


def begins(hashes: np.ndarray) -> np.ndarray:
    """How many hashes lie below each range of those with equal first bits."""
    half = 1 << (_FIRST_BITS - 1)
    return np.searchsorted(hashes, np.arange(-half, half, dtype=np.int64) << (64 - _FIRST_BITS))


def known(hashes: np.ndarray, terms: Terms, ranges: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ascending numbers of the terms that are among ``hashes``, and how often they occur.

    ``ranges``: what ``begins`` tells of the hashes, which spares a search for each term.
    """
    if not len(hashes):
        return np.empty(0, np.int64), terms[1][:0]
    if ranges is None:
        at = np.searchsorted(hashes, terms[0])
    else:
        at = ranges[(terms[0] >> (64 - _FIRST_BITS)) + (1 << (_FIRST_BITS - 1))]
        behind = np.flatnonzero(hashes.take(at, mode="clip") < terms[0])
        while len(behind):
            at[behind] += 1
            behind = behind[at[behind] < len(hashes)]
            behind = behind[hashes[at[behind]] < terms[0][behind]]
    inside = hashes.take(at, mode="clip") == terms[0]
    return at[inside], terms[1][inside]


def packed(numbers: np.ndarray, counts: np.ndarray) -> bytes:
    """Numbers and counts of a text, compressed: some two bytes a term."""
    both = np.concatenate((np.diff(numbers, prepend=0), counts)).astype("<u4")
    return zstandard.compress(np.ascontiguousarray(both.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    columns = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(columns.T).view("<u4").reshape(-1).astype(np.int64)
    return np.cumsum(both[: len(both) // 2]), both[len(both) // 2 :]


def held_out(name: str):
    return F.crc32(F.col(name).cast("string")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, cfg: ToxicConfig) -> DataFrame:
    """``(doc_id, text, toxic)``: labelled rows outside of the held-out fold, at most ``examples``.

    Labels that are NULL or contradict each other for an id teach nothing.
    """
    agreed = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    usable = agreed.filter("toxic = most").filter(~held_out("doc_id")).select("doc_id", "toxic")
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(cfg.examples)
    # An id of several rows teaches once.
    texts = docs.select("doc_id", "text").join(materialize(chosen, "examples"), "doc_id")
    return texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _term_counts(rows: DataFrame, cfg: ToxicConfig) -> DataFrame:
    """``(term, toxic, clean)``: examples with the term; a batch is added up before the shuffle."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by("toxicity").clear()  # an index of another model, which this one replaces
        for batch in batches:
            labels = batch.column(0).to_numpy()
            found = [t for t, _ in terms_of_each((t.as_py() for t in batch.column(1)), cfg.prefix)]
            if found:
                terms, at = np.unique(np.concatenate(found), return_inverse=True)
                toxic = np.bincount(at, np.repeat(labels, [len(t) for t in found]), len(terms)).astype(np.int64)
                clean = np.bincount(at, minlength=len(terms)) - toxic
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (terms, toxic, clean)], ["term", "toxic", "clean"])

    counted = rows.select("toxic", "text").mapInArrow(count, "term long, toxic long, clean long")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _document_counts(docs: DataFrame, hashes: np.ndarray, cfg: ToxicConfig) -> tuple[np.ndarray, int]:
    """How many documents have each known term, and how many documents there are.

    Each task adds up its documents in one array of the vocabulary's size and hands it on in parts.
    """
    sent = docs.sparkSession.sparkContext.broadcast(hashes)
    bounds = np.linspace(0, len(hashes), _PARTS + 1).astype(int)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows, ranges = np.zeros(len(sent.value), np.int64), 0, begins(sent.value)
        for batch in batches:
            rows += batch.num_rows
            for terms in terms_of_each((t.as_py() for t in batch.column(0)), cfg.prefix):
                total[known(sent.value, terms, ranges)[0]] += 1
        if rows:
            parts = [total[a:b].tobytes() for a, b in itertools.pairwise(bounds.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(_PARTS), pa.int32()), pa.array([rows] * _PARTS, pa.int64()), pa.array(parts, pa.binary())], ["part", "n", "counts"])

    def add(key: tuple[pa.Scalar, ...], rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in rows:
            for size, counts in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                own = np.frombuffer(counts.as_buffer(), np.int64)
                total, n = own if total is None else total + own, n + size
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["part", "n", "counts"])

    schema = "part int, n long, counts binary"
    counted = docs.select("text").mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema)
    rows = materialize(counted, "document-counts").orderBy("part").collect()
    return np.frombuffer(b"".join(r.counts for r in rows), np.int64), rows[0].n if rows else 0


def _vocabulary(rows: DataFrame, docs: DataFrame, cfg: ToxicConfig) -> Vocabulary:
    """Every term of the sampled rows, with its IDF over all documents."""
    counts = materialize(_term_counts(rows, cfg), "terms").orderBy("term").toArrow()
    hashes, a, b = (counts.column(i).to_numpy() for i in range(3))
    sums = rows.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    have, n = _document_counts(docs, hashes, cfg)
    idf = np.log((1 + n) / (1 + have)) + 1 if len(hashes) else np.empty(0)
    return Vocabulary(hashes, idf, a, b, (sums.t or 0, sums.n - (sums.t or 0)), cfg)


@dataclass(frozen=True)
class Shard:
    """Examples in an index, with their ids and labels, ascending by id."""

    keys: np.ndarray
    labels: np.ndarray
    index: BlockMaxIndex


def _open(key: str, pieces: list, vocabulary: Vocabulary, block: int) -> Shard:
    """The shard of broadcast pieces, indexed once per worker process; other models' are let go."""
    opened: dict[str, Shard] = kept_by("toxicity")
    if key not in opened:
        model = key.split(":")[0]
        for other in [k for k in opened if k.split(":")[0] != model]:
            del opened[other]
        rows = sorted((row for piece in pieces for row in piece.value), key=lambda r: r[0])
        for piece in pieces:
            vars(piece).pop("_value", None)  # the worker would keep it beside the index
        keys, labels = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], float)
        joined = Joined()
        for row in rows:
            joined.add(vocabulary.vector(*unpacked(row[3])))
        joined.end()
        del rows
        use_one_thread()
        give_back()
        index = BlockMaxIndex(np.array(joined.sizes, np.int64), joined.terms, joined.weights, block)
        opened[key] = Shard(keys, labels, index)
        del joined
    return opened[key]


def _examples(rows: DataFrame, vocabulary, cfg: ToxicConfig) -> DataFrame:
    """``(doc_id, toxic, n, packed)``: the terms of the sampled rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ranges = vocabulary.value.hashes, vocabulary.value.ranges
        for batch in batches:
            told = [known(hashes, t, ranges) for t in terms_of_each((t.as_py() for t in batch.column(2)), cfg.prefix)]
            columns = [pa.array([len(t) for t, _ in told], pa.int32()), pa.array([packed(*t) for t in told], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "toxic", "n", "packed"])

    return rows.select("doc_id", F.col("toxic").cast("int"), "text").mapInArrow(run, EXAMPLE)


class Judge:
    """The shards and the vote, as executors use them."""

    def __init__(self, vocabulary, shards: dict[str, list], prior: float, cfg: ToxicConfig):
        """``vocabulary``: broadcast; ``shards``: the broadcast pieces of each, under a name of its own."""
        self.vocabulary, self.shards, self.prior, self.cfg = vocabulary, shards, prior, cfg

    def nearest(self, vectors: list[Vector], own: list[int | None] | None = None) -> list[list[tuple[float, int, float]]]:
        """Up to ``neighbours`` (similarity, id, label) for each vector, best first, ties to the smaller id.

        The k-th best of the shards before goes to the next one. ``own``: an example's own id, passed over.
        """
        k = self.cfg.neighbours
        best: list[list[tuple[float, int]]] = [[] for _ in vectors]
        label_of: dict[int, float] = {}
        for name, pieces in self.shards.items():
            shard = _open(name, pieces, self.vocabulary.value, self.cfg.block)
            least = [b[-1][0] if len(b) == k else 0.0 for b in best]
            skip: list[int] = []
            if own is not None:
                at = np.minimum(np.searchsorted(shard.keys, own), len(shard.keys) - 1)
                skip = np.where(shard.keys[at] == own, at, -1).tolist()
            found = shard.index.nearest_of_each(vectors, k, least, skip)
            keys = shard.keys.tolist()
            label_of.update(zip(keys, shard.labels.tolist(), strict=True))
            for i, near in enumerate(found):
                mine = [(s, keys[e]) for s, e in near]
                best[i] = merged(best[i], mine, k) if best[i] else mine
        return [[(s, key, label_of[key]) for s, key in b] for b in best]

    def vote(self, near: list[tuple[float, int, float]]) -> float:
        """Similarity-weighted share of toxic neighbours, drawn to the prior where they are far."""
        weight, toxic = sum(s for s, _, _ in near), sum(s * label for s, _, label in near)
        return (toxic + self.cfg.prior_weight * self.prior) / (weight + self.cfg.prior_weight)


class Model:
    """Broadcast vocabulary and shards, and the calibration. Small itself."""

    def __init__(self, judge: Judge, empty: float, votes: np.ndarray, labels: np.ndarray, cfg: ToxicConfig):
        self.cfg, self.judge, self.empty = cfg, judge, empty
        self.at, self.chance = pooled(votes, labels, judge.prior)

    def scores(self, texts: Iterable[str | None]) -> Iterator[tuple[float, str]]:
        """Score and evidence of each text."""
        texts = iter(texts)
        vocabulary = self.judge.vocabulary.value
        while some := list(itertools.islice(texts, _QUERIES)):
            wordless, vectors = [], []
            for terms in terms_of_each(some, self.cfg.prefix):
                wordless.append(not len(terms[0]))
                vectors.append(vocabulary.vector(*known(vocabulary.hashes, terms, vocabulary.ranges)))
            near = self.judge.nearest(vectors)
            # Between pools the chance is interpolated; a small part of the vote breaks ties.
            votes = [self.judge.vote(found) for found in near]
            chances = np.interp(votes, self.at, self.chance).tolist()
            for empty, found, vote, chance in zip(wordless, near, votes, chances, strict=True):
                if empty or not self.judge.shards:
                    yield float(min(max(self.empty, 0.0), 1.0)), ""
                    continue
                evidence = ";".join(f"{key}:{int(label)}:{s:.4f}" for s, key, label in found[:5])
                yield min(max(0.999 * chance + 0.001 * vote, 0.0), 1.0), evidence


def pooled(votes: np.ndarray, labels: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Votes and their chance of label 1, made monotone by pooling adjacent violators."""
    pools: list[list[float]] = []  # first and last vote, toxic, all
    for i in np.lexsort((labels, votes)).tolist():
        pools.append([votes[i], votes[i], labels[i], 1])
        while len(pools) > 1 and (
            pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3] or pools[-2][1] == pools[-1][0]
        ):
            last = pools.pop()
            pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
    at = np.array([(a + b) / 2 for a, b, _, _ in pools] or [0.5])
    return at, np.array([(t + prior) / (n + 1) for _, _, t, n in pools] or [prior])


def _votes(examples: DataFrame, judge: Judge) -> DataFrame:
    """Each example's vote by the others, and whether it has terms."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = judge.vocabulary.value
        for batch in batches:
            for at in range(0, batch.num_rows, _QUERIES):
                ids, labels, sizes, data = (c.to_pylist() for c in batch.slice(at, _QUERIES).columns)
                near = judge.nearest([vocabulary.vector(*unpacked(d), own) for d, own in zip(data, labels, strict=True)], ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([judge.vote(n) for n in near], pa.float64()), pa.array(labels, pa.int32()), pa.array([n > 0 for n in sizes])],
                    ["vote", "toxic", "told"])

    return examples.mapInArrow(run, "vote double, toxic int, told boolean")


def fit(docs: DataFrame, labels: DataFrame, cfg: ToxicConfig = ToxicConfig()) -> Model:
    """The model of at most ``cfg.examples`` labelled documents.

    Of them come to the driver: 64-bit hashes, counts and weights of their terms, the vectors in
    pieces of bounded size one at a time, and two numbers for each example.
    """
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    context = spark.sparkContext
    rows = materialize(training_rows(docs, labels, cfg), "training")
    vocabulary = context.broadcast(_vocabulary(rows, docs, cfg))
    examples = materialize(_examples(rows, vocabulary, cfg), "vectors")
    shards: dict[str, list] = {}
    name, room, piece, size = uuid.uuid4().hex, 0, [], 0
    for row in itertools.chain(examples.toLocalIterator(), [None]):
        if piece and (row is None or size >= cfg.piece):
            if room <= 0:
                shards[f"{name}:{len(shards)}"] = []
                room = cfg.shard
            room -= len(piece)
            list(shards.values())[-1].append(context.broadcast(piece))
            piece, size = [], 0
        if row is not None:
            piece.append((row.doc_id, row.toxic, row.n, bytes(row.packed)))
            size += len(row.packed)
    sums = examples.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    prior = ((sums.t or 0) + 1) / (sums.n + 2)
    judge = Judge(vocabulary, shards, prior, cfg)
    votes = materialize(_votes(examples, judge), "votes").toArrow()
    vote, toxic, told = (votes.column(i).to_numpy() for i in range(3))
    told = told.astype(bool)
    empty = (toxic[~told].sum() + prior) / ((~told).sum() + 1)
    return Model(judge, float(empty), vote[told], toxic[told].astype(float), cfg)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` with ``score`` (0 to 1) and ``evidence`` (nearest examples id:label:similarity).

    Only the text is read for the score. NULL and wordless texts get the rate among
    such examples. Rows that repeat an id are scored one by one.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("score", "evidence")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("evidence", T.StringType())])
    at, names = kept.index("text"), [*kept, "score", "evidence"]

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = list(model.scores(t.as_py() for t in batch.column(at)))
            extra = [pa.array([s for s, _ in told], pa.float64()), pa.array([e for _, e in told], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names)

    # Plain names inside: a name with a dot cannot be resolved there.
    return rows.toDF(*[f"c{i}" for i in range(len(kept))]).mapInArrow(judge, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, cfg: ToxicConfig = ToxicConfig()) -> DataFrame:
    """Per row of ``docs`` the held-out fold (no id: not in it), score, decision and evidence.

    Rows that repeat an id are scored one by one; an empty table gives no rows.
    """
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, cfg))
    return scored.select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= cfg.threshold).cast("int").alias("predicted"), "evidence",
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score below the threshold."""
    clean = score(docs, model).filter(F.col("score") < model.cfg.threshold)
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])

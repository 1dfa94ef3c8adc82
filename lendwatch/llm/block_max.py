"""Exact nearest examples by dot product: inverted index with block maxima."""

from __future__ import annotations

import ctypes
import glob
import os
from collections.abc import Iterable, Iterator, Sequence

import numpy as np

from lendwatch.llm.kept import give_back

Vector = tuple[np.ndarray, np.ndarray]  # ascending terms and their weights
_DENSE = 1024  # so many of the most frequent terms of a kind have a column of weights instead of postings
_OFTEN = 26  # a frequent term is in one of so many examples of the kind at least
_TOGETHER = 128  # queries that are multiplied with those rows at a time
_WINDOW = 512  # queries among which those with the same best blocks are brought together
_PART = 200_000  # terms of vectors that are put in place at a time
_FETCHED = 32_768  # postings that are summed at a time
_SEEN = 128  # of the most frequent terms tell examples' groups
_KINDS = 4  # groups of examples that are laid side by side
_RUN = 8  # blocks that are multiplied together with the queries that want one of them
_ROUNDING = 4e-6  # of sums of single precision, for vectors of length 1


def use_one_thread() -> None:
    """Let matrix products of this process use one thread: each of Spark's tasks has a core of its own.

    Threads that wait for each other would keep a second core busy. Where the library is another or
    has no such switch, nothing changes.
    """
    for path in glob.glob(os.path.join(os.path.dirname(np.__file__), "..", "numpy.libs", "*openblas*")):
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)


def _kinds(rows: np.ndarray) -> np.ndarray:
    """A group number for each row, by a few rounds of spherical means from evenly spread rows."""
    n = len(rows)
    centres = rows[np.linspace(0, n - 1, min(_KINDS, n)).astype(int)].copy()
    best = np.zeros(n, int)
    for _ in range(4):
        best = (rows @ centres.T).argmax(axis=1)
        for kind in range(len(centres)):
            mean = rows[best == kind].sum(axis=0)
            size = np.sqrt(mean @ mean)
            if size > 0:
                centres[kind] = mean / size
    return best


def _most_frequent(counts: np.ndarray, size: int) -> np.ndarray:
    """The terms of ``counts`` that are frequent among ``size`` examples, most frequent first."""
    often = np.flatnonzero((counts > 0) & (counts * _OFTEN >= size))
    return often[np.argsort(-counts[often], kind="stable")[:_DENSE]]


def _parts(terms: Sequence[np.ndarray], ends: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The number of each part of the vectors' terms, and the examples of its terms."""
    at = 0
    for number, part in enumerate(terms):
        yield number, np.searchsorted(ends, np.arange(at, at + len(part)), "right")
        at += len(part)


class Joined:
    """Vectors one after the other, in parts of some ``_PART`` terms."""

    def __init__(self):
        self.sizes: list[int] = []
        self.terms: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        self._some: list[Vector] = []
        self._length = 0

    def add(self, vector: Vector) -> None:
        self._some.append(vector)
        self.sizes.append(len(vector[0]))
        self._length += len(vector[0])
        if self._length >= _PART:
            self.end()

    def end(self) -> None:
        """Put what was added since the last part in one of its own."""
        if self._some:
            self.terms.append(np.concatenate([t for t, _ in self._some]).astype(np.int32))
            self.weights.append(np.concatenate([w for _, w in self._some]).astype(np.float32))
            self._some, self._length = [], 0


class BlockMaxIndex:
    """Examples' vectors of length at most 1 by term, and the largest weights in each block of examples.

    ``nearest_of_each`` finds the ``k`` largest dot products above 0 exactly, ties to the smaller
    example. Similar examples share blocks, and the blocks of a kind have their own frequent terms,
    so that the words of a language or subject are dense where they are used. The postings of the
    terms that are rare in a kind are summed; its frequent terms, which rule out no example there, are
    columns of weights whose block maxima bound what they add. The blocks of the highest bounds are
    scored first, and their k-th score, or a higher one from another index, rules out every block
    whose bound is lower. The other blocks are multiplied in single precision, and what comes near
    the k-th score is summed again in double precision.
    """

    def __init__(self, sizes: np.ndarray, terms: np.ndarray | list[np.ndarray], weights: np.ndarray | list[np.ndarray], block: int = 32):
        """From the vectors' sizes and their terms and weights, one vector after the other.

        Terms and weights are arrays or lists of their parts. Lists are emptied while the index
        fills, so that vectors and index are never held whole at once.
        """
        self.size, self.block = len(sizes), block
        if isinstance(terms, np.ndarray):
            terms, weights = ([a[at : at + _PART] for at in range(0, len(a), _PART)] for a in (terms, weights))
        counts = np.zeros(max((int(t.max(initial=0)) for t in terms), default=0) + 1, np.int64)
        for part in terms:
            counts += np.bincount(part, minlength=len(counts))
        ends = np.cumsum(sizes)
        kind, length = self._alike(_most_frequent(counts, self.size), terms, weights, ends)
        kinds = int(kind.max(initial=0)) + 1
        # Blocks of one kind and about one length have tight maxima; each kind begins a block of its own.
        order = np.lexsort((length, kind))
        members = np.bincount(kind, minlength=kinds)
        room = -(-members // block)
        self.blocks = int(room.sum())
        self.kind_of = np.repeat(np.arange(kinds), room)
        place = np.empty(self.size, np.int64)
        place[order] = np.arange(self.size) + np.repeat((np.cumsum(room) - room) * block - (np.cumsum(members) - members), members)
        self.order = np.full(self.blocks * block, -1)
        self.order[place] = np.arange(self.size)
        # The frequent terms of each kind, and the column that each has there.
        # Only what is frequent enough for the smallest kind can be frequent in any.
        maybe = np.flatnonzero(counts * _OFTEN >= members[members > 0].min(initial=self.size))
        column = np.full(len(counts), -1, np.int32)
        column[maybe] = np.arange(len(maybe))
        by_kind = np.zeros((kinds, len(maybe)), np.int64)
        for part, ids in _parts(terms, ends):
            at = column[terms[part]]
            seen = np.flatnonzero(at >= 0)
            by_kind += np.bincount(kind[ids[seen]] * len(maybe) + at[seen], minlength=by_kind.size).reshape(by_kind.shape)
        frequent = []
        for i, own in enumerate(by_kind):
            most = _most_frequent(own, int(members[i]))
            frequent.append(maybe[most])
            counts[frequent[-1]] -= own[most]
        often = np.unique(np.concatenate(frequent))
        self.row = np.full(len(counts), -1, np.int32)
        self.row[often] = np.arange(len(often))
        width = max(map(len, frequent))
        self.columns = np.full((kinds, width), len(often))  # the last row of a query is nothing
        column = np.full((kinds, len(often) + 1), -1, np.int32)
        for i, own in enumerate(frequent):
            self.columns[i, : len(own)] = self.row[own]
            column[i, self.row[own]] = np.arange(len(own))
        # A posting is one complex number, place and weight, so that both are fetched at once.
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.postings = np.empty(self.first[-1], np.complex64 if self.blocks * block < 1 << 24 else complex)
        free = self.first[:-1].copy()
        dense: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # places, columns and weights
        for part, ids in _parts(terms, ends):
            own_terms, own_weights = terms[part], weights[part]
            terms[part] = weights[part] = ends[:0]
            at = column[kind[ids], self.row[own_terms]]  # -1: not frequent anywhere, and the last column is -1
            often = np.flatnonzero(at >= 0)
            dense.append((place[ids[often]].astype(np.int32), at[often].astype(np.int16), own_weights[often]))
            rare = np.flatnonzero(at < 0)
            rare = rare[np.argsort(own_terms[rare], kind="stable")]
            ranked = own_terms[rare]
            begin = np.flatnonzero(np.diff(ranked, prepend=-1))
            own, number = ranked[begin], np.diff(begin, append=len(ranked))
            to = np.repeat(free[own] - begin, number) + np.arange(len(rare))
            free[own] += number
            self.postings.real[to], self.postings.imag[to] = place[ids[rare]], own_weights[rare]
        del free, column
        give_back()
        # Weights of the frequent terms by example, and the largest of each column in a block. They
        # come last: a page of few written weights is held whole.
        self.dense = np.zeros((self.blocks * block, width), np.float32)
        while dense:
            places, columns, own_weights = dense.pop()
            self.dense[places, columns] = own_weights
        self.most = self.dense.reshape(self.blocks, block, width).max(axis=1, initial=0)
        give_back()
        # One array for the sums of all batches: new ones would leave holes where small things stay.
        self._sums = np.zeros((_TOGETHER, self.blocks * block))

    def _alike(self, frequent: np.ndarray, terms: list[np.ndarray], weights: list[np.ndarray], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A kind for each example, and the length of the part that tells it, by a few of the most frequent terms."""
        row = np.full(max((int(t.max(initial=0)) for t in terms), default=0) + 1, -1, np.int32)
        row[frequent[:_SEEN]] = np.arange(len(frequent[:_SEEN]))
        telling = np.zeros((self.size, len(frequent[:_SEEN])), np.float32)
        for part, ids in _parts(terms, ends):
            seen = np.flatnonzero(row[terms[part]] >= 0)
            telling[ids[seen], row[terms[part][seen]]] = weights[part][seen]
        if not telling.size:
            return np.zeros(self.size, int), np.zeros(self.size)
        return _kinds(telling), np.square(telling).sum(axis=1)

    def _rare_sums(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        sums = np.zeros(self.blocks * self.block)
        starts = self.first[terms]
        sizes = self.first[terms + 1] - starts
        ends = np.cumsum(sizes)
        shift = starts - ends + sizes
        begin = 0
        # So many postings at a time that what is made of them stays in the processor's cache.
        for end in np.searchsorted(ends, np.arange(_FETCHED, sizes.sum() + _FETCHED, _FETCHED)).tolist():
            end = min(end + 1, len(terms))
            if begin < end:
                number = sizes[begin:end]
                at = np.arange(ends[begin] - sizes[begin], ends[end - 1])
                at += np.repeat(shift[begin:end], number)
                met = self.postings.take(at, mode="clip")
                products = np.repeat(weights[begin:end], number).astype(float)
                products *= met.imag
                sums += np.bincount(met.real.astype(np.int64), products, len(sums))
                begin = end
        return sums

    def _exact(self, sums: np.ndarray, places: np.ndarray, asked: list[np.ndarray]) -> np.ndarray:
        """Scores of examples, ``asked`` by kind; equal vectors give equal scores."""
        told, kinds = np.empty(len(places)), self.kind_of[places // self.block]
        for kind in np.unique(kinds).tolist():
            mine = np.flatnonzero(kinds == kind)
            columns = np.flatnonzero(asked[kind])
            dense = self.dense[places[mine, None], columns[None, :]].astype(float)
            told[mine] = sums[places[mine]] + dense @ asked[kind][columns].astype(float)
        return np.round(told, 12)

    def _batch(
        self, asked: np.ndarray, limits: np.ndarray, rare: list[Vector], k: int, least: list[float], skip: list[int]
    ) -> list[list[tuple[float, int]]]:
        """Answers to queries given by their frequent terms, the bounds those have by block, and all their terms."""
        sums = self._sums[: len(rare)]
        for i, (query, passed) in enumerate(zip(rare, skip, strict=True)):
            sums[i] = self._rare_sums(*query)
            if passed >= 0:
                sums[i, passed] = -9.0  # below any bound
        limits = limits + _ROUNDING + sums.reshape(len(rare), self.blocks, self.block).max(axis=2)
        limits[limits <= _ROUNDING] = -np.inf
        by_kind = [asked[:, columns] for columns in self.columns]
        runs = []
        for kind in range(len(by_kind)):
            begin, end = np.searchsorted(self.kind_of, (kind, kind + 1)).tolist()
            runs += [(first, min(first + _RUN, end), kind) for first in range(begin, end, _RUN)]
        highest = np.stack([limits[:, first:last].max(axis=1) for first, last, _ in runs])
        best, kth = np.zeros((len(rare), k)), np.array(least) - _ROUNDING
        met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # queries, places and scores
        for run in np.argsort(-np.maximum(highest, 0).sum(axis=1), kind="stable").tolist():
            mine = np.flatnonzero(highest[run] >= kth)
            if len(mine):
                first, last, kind = runs[run]
                part = slice(first * self.block, last * self.block)
                scores = sums[mine, part]
                scores += by_kind[kind][mine] @ self.dense[part].T
                best[mine] = np.partition(np.concatenate((best[mine], scores), axis=1), -k, axis=1)[:, -k:]
                kth[mine] = np.maximum(kth[mine], best[mine].min(axis=1) - 2 * _ROUNDING)
                query, at = np.nonzero(scores >= np.maximum(kth[mine], 1e-300)[:, None])
                met.append((mine[query], at + part.start, scores[query, at]))
        query, places, scores = (np.concatenate([m[i] for m in met] or [np.empty(0, int)]) for i in range(3))
        near = np.flatnonzero(scores >= kth[query])
        near = near[np.argsort(query[near], kind="stable")]
        ends = np.searchsorted(query[near], np.arange(len(rare) + 1)).tolist()
        told = []
        for i, own in enumerate(sums):
            mine = places[near[ends[i] : ends[i + 1]]]
            exact = self._exact(own, mine, [q[i] for q in by_kind])
            examples = self.order[mine[exact > 0]]
            exact = exact[exact > 0]
            order = np.lexsort((examples, -exact))[:k]
            told.append(list(zip(exact[order].tolist(), examples[order].tolist(), strict=True)))
        return told

    def nearest_of_each(self, queries: Sequence[Vector], k: int, least: Sequence[float] = (), skip: Sequence[int] = ()) -> list[list[tuple[float, int]]]:
        """Up to ``k`` (score, example) for each query, best first.

        Scores below ``least`` of a query may be left out; ``skip`` is an example it passes over, or -1.
        """
        if not self.size:
            return [[] for _ in queries]
        least = least or [0.0] * len(queries)
        taken = np.flatnonzero(self.order >= 0)
        places = taken[np.argsort(self.order[taken])]
        skipped = [int(places[s]) if s >= 0 else -1 for s in skip] if len(skip) else [-1] * len(queries)
        told: list[list[tuple[float, int]]] = [[] for _ in queries]
        for begin in range(0, len(queries), _WINDOW):
            window = queries[begin : begin + _WINDOW]
            asked, rare = np.zeros((len(window), int(self.row.max()) + 2), np.float32), []
            for i, (terms, weights) in enumerate(window):
                terms = terms[: np.searchsorted(terms, len(self.row))]
                weights, rows = weights[: len(terms)], self.row[terms]
                asked[i, rows[rows >= 0]] = weights[rows >= 0]
                rare.append((terms, weights))
            limits = np.empty((len(window), self.blocks), np.float32)
            for kind, columns in enumerate(self.columns):
                mine = self.kind_of == kind
                limits[:, mine] = asked[:, columns] @ self.most[mine].T
            together = np.argsort(limits.argmax(axis=1), kind="stable")
            for at in range(0, len(window), _TOGETHER):
                some = together[at : at + _TOGETHER]
                mine = (begin + some).tolist()
                found = self._batch(
                    asked[some], limits[some], [rare[i] for i in some.tolist()], k, [least[i] for i in mine], [skipped[i] for i in mine])
                for i, near in zip(mine, found, strict=True):
                    told[i] = near
        return told


def merged(one: list[tuple[float, int]], two: Iterable[tuple[float, int]], k: int) -> list[tuple[float, int]]:
    """The ``k`` best of two answers, ties to the smaller example."""
    return sorted([*one, *two], key=lambda f: (-f[0], f[1]))[:k]

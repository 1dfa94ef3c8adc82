"""SentencePiece encoding that keeps byte offsets, and decoding.

A text is normalised by the longest prefix that the model's compiled character map knows, and every
normalised byte remembers the source byte it came from. The normalised text is merged into pieces by
the ``sentencepiece`` library, whose own normaliser is switched off; through the alignment each piece
is projected to the bytes of the original text it stands for. Words are merged once per worker where
the vocabulary has no piece that spans two of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendwatch.llm.kept import kept_by

SPACE = "▁"  # stands for a blank in pieces
_SPACE = SPACE.encode()
_BPE, _BYTE, _USER = 2, 6, 4  # numbers of the model format
_CACHED_CHUNKS = 400_000
_CACHED_LENGTH = 64
_SLICE = 4_000_000  # characters of text encoded together


class CharacterMap:
    """A compiled map: a double array over UTF-8 bytes, and the zero-ended strings it points to."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.strings = compiled[4 + size :]

    def _child(self, node: int, byte: int) -> int | None:
        """The unit's place after one more byte; ``node`` already has its offset applied."""
        at = node ^ byte
        unit = self.units[at] if at < len(self.units) else 1 << 31
        return at if unit & 0x800000FF == byte else None

    def _below(self, at: int) -> tuple[int, int | None]:
        """The place below a unit, and the value there if a key ends."""
        unit = self.units[at]
        node = at ^ ((unit >> 10) << ((unit & 0x200) >> 6))
        return node, self.units[node] & 0x7FFFFFFF if unit >> 8 & 1 else None

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest key that ``data`` has at ``at``."""
        if not self.units:
            return None
        node, found = self._below(0)[0], None
        for end in range(at, len(data)):
            place = self._child(node, data[end])
            if place is None:
                break
            node, value = self._below(place)
            if value is not None:
                found = value, end + 1 - at
        if found is None:
            return None
        return self.strings[found[0] : self.strings.index(b"\0", found[0])], found[1]

    def plain(self) -> bytes:
        """ASCII characters that no key of ASCII characters alone begins with."""
        if not self.units:
            return bytes(range(128))

        def ends(place: int) -> bool:
            node, value = self._below(place)
            if value is not None:
                return True
            return any(ends(p) for b in range(1, 128) if (p := self._child(node, b)) is not None)

        root = self._below(0)[0]
        return bytes(b for b in range(128) if (p := self._child(root, b)) is None or not ends(p))


class Normaliser:
    """Text to normalised bytes and, for each of them and their end, the source byte."""

    def __init__(self, spec, as_suffix: bool = False, symbols: Iterable[str] = ()):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix = spec.add_dummy_prefix and not as_suffix
        self.suffix = spec.add_dummy_prefix and as_suffix
        self.squeeze, self.escape = spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.symbols = sorted((s.encode() for s in symbols), key=len, reverse=True)
        self.identity = not self.map.units
        if self.identity and not self.symbols:
            plain, self.after = b"[\\x00-\\xff]", b""
        else:
            kept = self.map.plain().translate(None, bytes({s[0] for s in self.symbols}))
            plain, self.after = b"[" + b"".join(b"\\x%02x" % b for b in kept) + b"]" if kept else b"(?!)", b"(?![\\x80-\\xff])"
        # Stretches whose characters no rule touches, whatever follows.
        self.verbatim = re.compile(b"(?:" + plain + self.after + b")+")

    def _unit(self, data: bytes, at: int) -> tuple[bytes, int]:
        """What stands at ``at``: a symbol, a mapped key or one character."""
        for s in self.symbols:
            if data.startswith(s, at):
                return s, len(s)
        found = self.map.longest(data, at)
        if found is not None:
            return found
        first = data[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return data[at : at + size], size

    def _mapped(self, data: bytes, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Mapped bytes from ``at`` on and their sources; repeated blanks squeezed if asked."""
        parts, sources, blank = [], [], self.squeeze
        while at < len(data):
            found = self.verbatim.match(data, at)
            if found:
                own = np.frombuffer(data, np.uint8, found.end() - at, at)
                source = np.arange(at, found.end(), dtype=np.int32)
                if self.squeeze:
                    is_blank = own == 32
                    kept = ~(is_blank & np.concatenate(([blank], is_blank[:-1])))
                    blank = bool(is_blank[-1])
                    own, source = own[kept], source[kept]
                parts.append(own)
                sources.append(source)
                at = found.end()
                continue
            text, size = self._unit(data, at)
            if blank:
                text = text.lstrip(b" ")
            if text:
                parts.append(np.frombuffer(text, np.uint8))
                sources.append(np.full(len(text), at, np.int32))
                blank = text.endswith(b" ")
            blank = blank and self.squeeze
            at += size
        if not parts:
            return np.empty(0, np.uint8), np.empty(0, np.int32)
        return np.concatenate(parts), np.concatenate(sources)

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        data, at = text.encode("utf-8", "replace"), 0
        if self.squeeze:
            while at < len(data):
                unit, size = self._unit(data, at)
                if unit != b" ":
                    break
                at += size
        if at == len(data):
            return b"", np.zeros(1, np.int32)
        out, source = self._mapped(data, at)
        end = len(data)
        if self.prefix:
            out = np.concatenate((np.array([32], np.uint8), out))
            source = np.concatenate((np.array([at], np.int32), source))
        blank = b" "
        if self.escape:
            blank, is_blank = _SPACE, out == 32
            source = np.repeat(source, np.where(is_blank, 3, 1))
            result = out.tobytes().replace(b" ", _SPACE)
        else:
            result = out.tobytes()
        if self.squeeze:
            while result.endswith(blank):
                result = result[: -len(blank)]
                end = int(source[len(result)])
        source = source[: len(result)]
        if self.suffix:
            result += blank
            source = np.concatenate((source, np.full(len(blank), end, np.int32)))
        return result, np.append(source, np.int32(end))


class Pieces:
    """A model's encoder and decoder."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        model = ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        self.library = SentencePieceProcessor(model_proto=model.SerializeToString())
        pieces = [p.piece for p in model.pieces]
        self.normalise = Normaliser(
            model.normalizer_spec, model.trainer_spec.treat_whitespace_as_suffix,
            [p.piece for p in model.pieces if p.type == _USER])
        spec = model.normalizer_spec
        spec.precompiled_charsmap = b""
        spec.name, spec.add_dummy_prefix, spec.escape_whitespaces, spec.remove_extra_whitespaces = "identity", False, False, False
        self.merger = SentencePieceProcessor(model_proto=model.SerializeToString())
        self.is_byte = np.array([p.type == _BYTE for p in model.pieces])
        self.lengths = np.where(self.is_byte, 1, [len(p.encode()) for p in pieces]).astype(np.int64)
        self.unknown = self.library.unk_id()
        # Merges stay within a run of blanks and the word behind it, if no piece says otherwise.
        apart = model.trainer_spec.model_type == _BPE and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.split = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall if apart else lambda text: [text] if text else []
        self.known: dict[str, bytes] = {}  # ids of words already merged; emptied when full

    def merge(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of normalised texts; words not met before are merged together in one call."""
        chunks = [self.split(t) for t in texts]
        if len(self.known) > _CACHED_CHUNKS:
            self.known.clear()
        new = list({c for own in chunks for c in own if c not in self.known})
        for chunk, ids in zip(new, self.merger.encode(new, num_threads=1), strict=True):
            self.known[chunk] = np.array(ids, np.int32).tobytes()
        out = [np.frombuffer(b"".join(map(self.known.__getitem__, own)), np.int32) for own in chunks]
        for chunk in new:
            if len(chunk) > _CACHED_LENGTH:
                del self.known[chunk]
        return out

    def spans(self, normal: bytes, source: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Original byte spans of pieces; of a character's byte pieces only the last has its bytes."""
        lengths = self.lengths[ids]
        if (ids == self.unknown).any():
            # An unknown piece is as long as the text it stands for.
            found = self.merger.encode(normal.decode(), return_type="proto").pieces
            lengths = np.array([p.end - p.begin for p in found], np.int64)
            if len(lengths) != len(ids):
                raise ValueError("merged words and the whole text differ")
        ends = np.cumsum(lengths)
        starts = ends - lengths
        single = self.is_byte[ids]
        if single.any():
            inner = np.append((np.frombuffer(normal, np.uint8) & 0xC0) == 0x80, False)
            heads = np.maximum.accumulate(np.where(inner, 0, np.arange(len(inner))))
            starts = np.where(single, heads[np.minimum(starts, len(normal))], starts)
            ends = np.where(single & inner[ends], starts, ends)
        return source[starts], source[ends]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, starts, ends) of each text, in bytes of the text."""
        normal = [self.normalise(t) for t in texts]
        ids = self.merge([n.decode() for n, _ in normal])
        return [(i, *self.spans(n, source, i)) for i, (n, source) in zip(ids, normal, strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


def pieces_of(path: str) -> Pieces:
    """One model per worker process, as long as it encodes."""
    loaded: dict[str, Pieces] = kept_by("pieces")
    if path not in loaded:
        loaded[path] = Pieces(path)
    return loaded[path]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    sizes = np.concatenate(([0], np.cumsum([len(a) for a in arrays])))
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int32()))


ADDED = ("ids", "starts", "ends", "decoded")


def encode(docs: DataFrame, model: str) -> DataFrame:
    """Rows of ``docs`` with ``ids``, the byte spans ``starts`` and ``ends``, and the ``decoded`` text.

    ``model`` is a path that every executor has. NULL and empty texts have no pieces and decode to the
    empty text. Rows are independent: repeated ids stay, columns of the four names are replaced.
    Whole texts are encoded; a row's memory is some ten times its text, and a batch is worked on in
    slices of bounded text.
    """
    kept = [c for c in docs.columns if c not in ADDED]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    numbers = T.ArrayType(T.IntegerType())
    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, numbers) for n in ADDED[:3]], T.StructField("decoded", T.StringType())])
    at, names = kept.index("text"), [*kept, *ADDED]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces_of(model)
        for batch in batches:
            start, size, texts = 0, 0, []
            for row, text in enumerate(batch.column(at)):
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size < _SLICE and row + 1 < batch.num_rows:
                    continue
                found = known.encode(texts)
                columns = [_lists([f[i] for f in found]) for i in range(3)]
                decoded = pa.array([known.decode(f[0]) for f in found], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.slice(start, len(texts)).columns, *columns, decoded], names)
                start, size, texts = row + 1, 0, []

    # Plain names inside: a name with a dot cannot be resolved there.
    return rows.toDF(*[f"c{i}" for i in range(len(kept))]).mapInArrow(run, schema)


def encode_report(docs: DataFrame, model: str) -> DataFrame:
    """Per document: pieces, digests of ids and decoded text, and the bytes the pieces' spans cover."""
    found = encode(docs.select("doc_id", "text"), model)
    covered = F.expr("aggregate(zip_with(starts, ends, (s, e) -> cast(e - s as bigint)), 0L, (a, x) -> a + x)")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"), covered.alias("covered_bytes"),
    )

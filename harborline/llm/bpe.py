"""Byte-level BPE encoding and decoding by backtracking over longest matches.

A piece of text (one match of the split pattern) is spelled in Latin-1, one character per byte, and a
pyahocorasick automaton over the reversed vocabulary reports in one pass the longest token that starts
at each byte. Tokens are laid down from the left, longest first. Two neighbours are kept only when
merging would really leave that boundary between them; this is decided by undoing merges on both
sides and is memoised per pair. A position from which no token fits is marked and never tried again,
so every position is visited at most once and the work is linear in the piece.

``encode`` returns the whole texts' ids, ``decode`` their bytes. Null texts count as empty and give an
empty array; null ids inside an array, or ids outside the vocabulary, raise. Repeated rows are encoded
each. Other columns pass through untouched; the new column replaces one of the same name.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_MEMO = 1 << 19  # entries kept per memo in a worker; a full memo is emptied, results don't change
_ROWS = 512  # rows turned into Python objects at once
_READY: dict[int, Codec] = {}


class Codec:
    """Encoder and decoder for one vocabulary of (bytes, rank) pairs."""

    def __init__(self, vocabulary: list[tuple[bytes, int]], pattern: str):
        import ahocorasick
        import regex

        self.pieces = regex.compile(pattern).findall
        ranked = sorted(vocabulary, key=lambda x: x[1])
        self.size = ranked[-1][1] + 1 if ranked else 0
        self.bytes: list[bytes | None] = [None] * self.size
        self.spelled: dict[str, int] = {}
        for raw, rank in ranked:
            self.bytes[rank] = raw
            self.spelled[raw.decode("latin-1")] = rank
        self.tokens = pa.array(self.bytes, pa.binary())
        self.length = [len(raw) if raw is not None else 0 for raw in self.bytes]
        self.automaton = ahocorasick.Automaton()
        for text, rank in self.spelled.items():
            self.automaton.add_word(text[::-1], rank)
        self.automaton.make_automaton()
        self.shorter = [self._shorter(raw) for raw in self.bytes]
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(self.size)]
        self.fits_memo: dict[tuple[int, int], bool] = {}
        self.piece_memo = _Memo(self.piece)
        for raw, rank in ranked:
            self._learn(raw.decode("latin-1"), rank)
        self.fits_memo.clear()

    def _shorter(self, raw: bytes | None) -> int:
        """The longest other token that starts ``raw``, or -1."""
        text = raw.decode("latin-1") if raw else ""
        return next((self.spelled[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.spelled), -1)

    def _learn(self, text: str, rank: int) -> None:
        """Find the two tokens whose merge makes token ``rank``."""
        left = self.shorter[rank]
        while left >= 0:
            right = self.spelled.get(text[self.length[left] :], -1)
            if 0 <= right < rank and left < rank and self.fits(left, right):
                self.merged[left, right] = rank
                self.parts[rank] = (left, right)
                return
            left = self.shorter[left]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging by rank leaves the boundary between two adjacent tokens standing."""
        key = (left, right)
        known = self.fits_memo.get(key)
        if known is None:
            if len(self.fits_memo) >= _MEMO:
                self.fits_memo.clear()
            known = self.fits_memo[key] = self._stands(left, right)
        return known

    def _stands(self, left: int, right: int) -> bool:
        # Walk back in time: the side whose token was merged last is split, and a merge across the
        # boundary would have come first if its rank is below that of the latest split.
        bound = self.size
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < bound:
                return False
            left_whole, right_whole = self.parts[left][1] == left, self.parts[right][0] == right
            if left_whole and right_whole:
                return True
            if right_whole or (left > right and not left_whole):
                bound, left = left, self.parts[left][1]
            else:
                bound, right = right + 1, self.parts[right][0]

    def piece(self, text: str) -> list[int]:
        """Ids of one piece."""
        spelled = text.encode("utf-8", "surrogatepass").decode("latin-1")
        whole = self.spelled.get(spelled)
        return [whole] if whole is not None else self._backtrack(spelled)

    def _backtrack(self, text: str) -> list[int]:
        n, last = len(text), len(text) - 1
        length, shorter, fits_memo = self.length, self.shorter, self.fits_memo
        longest = [-1] * n
        for end, rank in self.automaton.iter(text[::-1]):  # at one end the longest comes first
            if longest[last - end] < 0:
                longest[last - end] = rank
        open_ends = bytearray(b"\x01") * (n + 1)
        made: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            if token < 0:  # nothing fits here: give the last token back
                if not made:
                    raise ValueError("the vocabulary doesn't cover all bytes")
                open_ends[at] = 0
                token = made.pop()
                at -= length[token]
                token = shorter[token]
                continue
            end = at + length[token]
            if open_ends[end]:
                fits = True
                if made:
                    fits = fits_memo.get((made[-1], token))
                    if fits is None:
                        fits = self.fits(made[-1], token)
                if fits:
                    made.append(token)
                    at = end
                    token = longest[at] if at < n else -1
                    continue
            token = shorter[token]
        return made

    def packed(self, text: str | None) -> bytes:
        """Ids of a whole text as 32-bit numbers, one after the other."""
        return b"".join(map(self.piece_memo.__getitem__, self.pieces(text or "")))

    def encode(self, text: str | None) -> list[int]:
        return array("i", self.packed(text)).tolist()


class _Memo(dict):
    """Packed ids by piece, of short pieces; a full memo is emptied."""

    def __init__(self, piece: Callable[[str], list[int]]):
        super().__init__()
        self.piece = piece

    def __missing__(self, match: str) -> bytes:
        found = array("i", self.piece(match)).tobytes()
        if len(match) <= 64:
            if len(self) >= _MEMO:
                self.clear()
            self[match] = found
        return found


class Vocabulary:
    """A rank file read by the driver and broadcast: its size is that of the vocabulary, not of the data.

    ``path`` is a file with one base64 token and its rank per line, ``pattern`` the split pattern.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as file:
            self.shared: Broadcast = spark.sparkContext.broadcast((file.read(), pattern))


def _rank_file(shared: Broadcast) -> list[tuple[bytes, int]]:
    lines = map(bytes.split, shared.value[0].splitlines())
    return [(base64.b64decode(line[0]), int(line[1])) for line in lines if line]


def _codec(shared: Broadcast) -> Codec:
    """The codec of this worker process, built once."""
    key = hash(shared.value)
    if key not in _READY:
        _READY[key] = Codec(_rank_file(shared), shared.value[1])
    return _READY[key]


def _mapped(docs: DataFrame, name: str, kind: T.DataType, source: str, ready: Callable[[], Callable[[pa.Array], pa.Array]]) -> DataFrame:
    """``docs`` with column ``name`` made from arrays of column ``source`` by the function that ``ready()`` gives."""
    schema = T.StructType([f for f in docs.schema.fields if f.name != name] + [T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = ready()
        for whole in batches:
            for start in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(start, _ROWS)
                names = [n for n in batch.schema.names if n != name]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), made(batch.column(source))], [*names, name])

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of each whole text as array<int>."""
    shared = vocabulary.shared

    def ready() -> Callable[[pa.Array], pa.Array]:
        packed = _codec(shared).packed

        def made(texts: pa.Array) -> pa.Array:
            rows = [packed(t) for t in texts.to_pylist()]
            ends = np.zeros(len(rows) + 1, dtype=np.int32)
            np.cumsum([len(row) // 4 for row in rows], out=ends[1:])
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), dtype=np.int32)))

        return made

    return _mapped(docs, ids, T.ArrayType(T.IntegerType()), text, ready)


def decode(docs: DataFrame, vocabulary: Vocabulary, ids: str = "token_ids", raw: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of each id array as binary."""
    shared = vocabulary.shared

    def ready() -> Callable[[pa.Array], pa.Array]:
        tokens = _codec(shared).tokens

        def made(rows: pa.Array) -> pa.Array:
            numbers = rows.flatten()
            least, most = pc.min_max(numbers).values()
            if numbers.null_count or (len(numbers) and not 0 <= least.as_py() <= most.as_py() < len(tokens)):
                raise KeyError("an id outside the vocabulary")
            lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy()
            ends = np.zeros(len(rows) + 1, dtype=np.int64)
            np.cumsum(lengths, out=ends[1:])
            found = tokens.take(numbers)
            if found.null_count:
                raise KeyError("an id outside the vocabulary")
            return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends), found), b"").cast(pa.binary())

        return made

    return _mapped(docs, raw, T.BinaryType(), ids, ready)

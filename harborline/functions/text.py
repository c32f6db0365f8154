"""Tokens, word and character chunks, and hashed text vectors."""

from __future__ import annotations

import hashlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as a word, and every character that separates words.
WORD = r"[A-Za-z0-9]+(?:['_-][A-Za-z0-9]+)*"
SPACES = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
SEPARATORS = ("\n\n", "\n", " ", "")
FEATURES = 1 << 18  # about as many features are hashed together
SLICE = 1 << 24  # about as many characters, at most, make a partition whose terms are counted
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def words(text: Column) -> Column:
    """Text split at white space, no empty words."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def tokens(text: Column) -> Column:
    """Lower-case words made of letters and digits."""
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda t: F.lower(t))


def bigrams(terms: Column) -> Column:
    """Adjacent pairs as ``a_b``."""
    n = F.greatest(F.size(terms) - 1, F.lit(0))
    return F.zip_with(F.slice(terms, F.lit(1), n), F.slice(terms, F.lit(2), n), lambda a, b: F.concat_ws("_", a, b))


def sliced(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` in partitions of at most about ``SLICE`` characters: a task that counts terms holds its distinct ones."""
    chars = docs.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    n = -(-chars // SLICE)
    if docs.rdd.getNumPartitions() >= n:
        return docs
    # rows are dealt by number: a deal in turn would sort whole splits, one by text would gather copies
    return docs.withColumn("_no", F.monotonically_increasing_id()).repartition(n, "_no").drop("_no")


def text_features(text: Column) -> Column:
    terms = tokens(text)
    return F.concat(terms, bigrams(terms))


def word_windows(terms: Column, size: int, overlap: int) -> Column:
    """Texts of ``size`` words, each starting ``size - overlap`` words after the one before.

    The last window is the first one to reach the end; no words give no windows.
    """
    if size < 1:
        raise ValueError("chunk size must be at least 1")
    if overlap < 0 or overlap >= size:
        raise ValueError("overlap must be at least 0 and below the chunk size")
    step = size - overlap
    last = F.greatest(F.ceil((F.size(terms) - size) / step), F.lit(0)).cast("int")
    windows = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(terms, i * step + 1, F.lit(size)), " ")
    )
    return F.when(F.size(terms) > 0, windows).otherwise(F.array().cast("array<string>"))


def chunk_id(source: Column, page: Column, index: Column, text: Column) -> Column:
    """First 24 hex digits of the SHA-256 of source, page, index and text."""
    identity = F.concat_ws("|", source, F.coalesce(page.cast("string"), F.lit("None")), index.cast("string"), text)
    return F.substring(F.sha2(identity, 256), 1, 24)


def _pieces(text: Column, separator: str) -> Column:
    """Non-empty pieces of a text, each starting with the separator it was cut at."""
    parts = F.split(text, separator, -1)
    return F.filter(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit(separator), p))), lambda p: p != "")


def _piece(whole: Column, text: Column) -> Column:
    return F.struct(whole.alias("whole"), text.alias("text"))


def _closed(held: Column) -> Column:
    """The chunk that ``held`` makes, as an array; nothing where only white space is left."""
    chunk = F.btrim(F.array_join(held, ""), F.lit(BLANKS))
    return F.filter(F.array(_piece(F.lit(False), chunk)), lambda c: c["text"] != "")


def _packed(pieces: Column, size: int, overlap: int) -> Column:
    """Chunks of adjacent short pieces, in order with the long pieces between them, which stay ``whole``."""
    none = F.array().cast("array<string>")

    def state(out: Column, held: Column, n: Column) -> Column:
        return F.struct(out.alias("out"), held.alias("held"), n.alias("n"))

    def add(a: Column, piece: Column) -> Column:
        n = F.length(piece)
        out = F.concat(a["out"], _closed(a["held"]))
        room = F.least(F.lit(overlap), size - n)
        longer = lambda t, h: (t["k"] == t["seen"]) & (t["n"] + F.length(h) <= room)
        # the longest end of the chunk that fits in front of the piece
        end = F.aggregate(
            F.reverse(a["held"]),
            F.struct(F.lit(0).alias("k"), F.lit(0).alias("n"), F.lit(0).alias("seen")),
            lambda t, h: F.struct(
                F.when(longer(t, h), t["k"] + 1).otherwise(t["k"]).alias("k"),
                F.when(longer(t, h), t["n"] + F.length(h)).otherwise(t["n"]).alias("n"),
                (t["seen"] + 1).alias("seen"),
            ),
        )
        tail = lambda e: F.slice(a["held"], F.size(a["held"]) - e["k"] + 1, e["k"])
        reopened = F.transform(F.array(end), lambda e: state(out, F.concat(tail(e), F.array(piece)), e["n"] + n))
        return (
            F.when(n >= size, state(F.concat(out, F.array(_piece(F.lit(True), piece))), none, F.lit(0)))
            .when((a["n"] > 0) & (a["n"] + n > size), F.get(reopened, F.lit(0)))
            .otherwise(state(a["out"], F.concat(a["held"], F.array(piece)), a["n"] + n))
        )

    start = state(F.array().cast("array<struct<whole:boolean,text:string>>"), none, F.lit(0))
    return F.aggregate(pieces, start, add, lambda a: F.concat(a["out"], _closed(a["held"])))


def _character_windows(text: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` characters put together from strips of ``size - overlap``, so no text is scanned twice."""
    step = size - overlap
    last = F.greatest(F.ceil((F.length(text) - size) / step), F.lit(0)).cast("int")
    strips = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    span = -(-size // step)
    windows = F.transform(
        F.array(strips),
        lambda cut: F.transform(
            F.sequence(F.lit(0), last), lambda i: F.left(F.array_join(F.slice(cut, i + 1, F.lit(span)), ""), F.lit(size))
        ),
    )
    if size == 1:
        return F.flatten(windows)
    return F.filter(F.transform(F.flatten(windows), lambda w: F.btrim(w, F.lit(BLANKS))), lambda w: w != "")


def chunk_characters(text: Column, size: int = 500, overlap: int = 80) -> Column:
    """Array of chunks of at most ``size`` characters, cut at paragraphs, then lines, then spaces, then anywhere.

    A piece keeps the separator it was cut at. Pieces shorter than ``size`` are joined while they fit, each chunk
    starting with up to ``overlap`` characters of the one before, in whole pieces; a longer piece closes what is open
    and is cut by the next separator. White space at the ends of a chunk goes. A text without anything else gives
    no chunks, a null gives null. Everything is one expression, a step per separator.
    """
    if size < 1:
        raise ValueError("chunk size must be at least 1")
    if overlap < 0 or overlap >= size:
        raise ValueError("overlap must be at least 0 and below the chunk size")
    made = F.array(_piece(F.lit(True), text))
    for separator in SEPARATORS[:-1]:
        cut = lambda c, s=separator: _packed(_pieces(c["text"], s), size, overlap)
        made = F.flatten(F.transform(made, lambda c: F.when(c["whole"], cut(c)).otherwise(F.array(c))))
    windows = lambda c: _character_windows(c["text"], size, overlap)
    chunks = F.flatten(F.transform(made, lambda c: F.when(c["whole"], windows(c)).otherwise(F.array(c["text"]))))
    return F.when(text.isNotNull(), chunks)


def _blake2b(feature: str) -> bytes:
    return hashlib.blake2b(feature.encode("utf-8"), digest_size=8).digest()


def _md5(feature: str) -> bytes:
    return hashlib.md5(feature.encode("utf-8"), usedforsecurity=False).digest()


DIGESTS = {"blake2b": _blake2b, "md5": _md5}


def hash_embed(features: Column, dimensions: int = 384, digest: str = "blake2b") -> Column:
    """Unit vector of signed feature counts; all zeros when there is no feature.

    The first four digest bytes (little endian) choose the position, the lowest bit of the fifth
    the sign. Rows stay where they are: hashing is a narrow step in Arrow batches, taken by runs of rows with about
    ``FEATURES`` features, each of which hashes a distinct feature once.
    """
    if dimensions < 8:
        raise ValueError("a vector needs 8 positions or more")
    hashed = DIGESTS[digest]

    def counted(rows: pa.Array, lengths: np.ndarray) -> np.ndarray:
        terms = rows.flatten().dictionary_encode()
        codes = terms.indices.to_numpy(zero_copy_only=False)
        digests = np.frombuffer(b"".join(hashed(feature) for feature in terms.dictionary.to_pylist()), dtype=np.uint8)
        digests = digests.reshape(len(terms.dictionary), -1)[:, :8]
        place = (digests[:, :4].copy().view("<u4").ravel() % dimensions).astype(np.int64)
        sign = np.where(digests[:, 4] & 1, 1.0, -1.0)
        cell = np.repeat(np.arange(len(lengths)), lengths) * dimensions + place[codes]
        counts = np.bincount(cell, weights=sign[codes], minlength=len(lengths) * dimensions).reshape(-1, dimensions)
        norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        return counts / np.where(norms > 0, norms, 1.0)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def embed(rows: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        run = (np.cumsum(lengths) - lengths) // FEATURES
        vectors = np.zeros((len(rows), dimensions))
        for start, stop in pairwise([0, *(np.flatnonzero(np.diff(run)) + 1), len(rows)]):
            if lengths[start:stop].any():
                vectors[start:stop] = counted(rows.slice(start, stop - start), lengths[start:stop])
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * dimensions)
        return pa.ListArray.from_arrays(offsets, pa.array(vectors.ravel()), mask=pc.is_null(rows))

    return embed(features)

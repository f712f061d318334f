"""Shared text helpers: native word expressions and vectorised byte-level word hashing.

Two word definitions are used by the operators; both treat every non-ASCII character as part
of a word, so they can be evaluated on UTF-8 bytes as well as on code points:

* ``SPACE_WORD``: runs of anything but space, tab, LF, VT, FF, CR;
* ``ALNUM_WORD``: runs of ASCII letters, digits and non-ASCII characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE_WORD = r"[^\x20\x09-\x0D]+"
SPACE_SEP = r"[\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ALNUM_SEP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Bytes hashed at once by the vectorised helpers; bounds the memory of one Python worker.
CHUNK_BYTES = 1 << 20


# ---------------------------------------------------------------- native expressions

def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the fast ``lower``; the others must not
    lower-case letters such as É, so they go through ``translate``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def split_words(text: Column, separators: str) -> Column:
    """Words of a text as an array; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators), lambda w: w != "")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a variable. An expression that a
    lambda captures is otherwise evaluated again for every array element."""
    return F.transform(F.array(value), body)[0]


def computed(df: DataFrame, *names: str) -> DataFrame:
    """Hand on the named columns as results: a later filter then tests the values and is not
    rewritten into the expressions behind them, which would evaluate them again (and, where a
    chain of columns uses each one twice, many times)."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*rest, F.explode_outer(F.array(F.struct(*names))).alias("_v")).select(
        *rest, *[F.col(f"_v.{c}").alias(c) for c in names])


def shifted(a: Column, k: int) -> Column:
    """``a`` without its first ``k`` elements (empty when there are no more)."""
    return F.slice(a, k + 1, F.greatest(F.size(a) - k, F.lit(0)))


def doc_key() -> list[Column]:
    """(doc_id, 64-bit text hash): rows equal in both are the same document."""
    return [F.col("doc_id").alias("doc_id"), F.xxhash64(F.col("text")).alias("_th")]


# ---------------------------------------------------------------- vectorised hashing

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POW: dict[str, np.ndarray] = {}


def _inverse(base: int) -> int:
    x = base
    for _ in range(6):  # Newton steps for the inverse modulo 2^64
        x = (x * (2 - base * x)) % (1 << 64)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "b" not in _POW or len(_POW["b"]) < n + 1:
        size = max(n + 1, CHUNK_BYTES + 1)
        for name, base in (("b", int(_BASE)), ("i", _inverse(int(_BASE)))):
            p = np.full(size, np.uint64(base), np.uint64)
            p[0] = 1
            _POW[name] = np.multiply.accumulate(p)
    return _POW["b"], _POW["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (public domain splitmix constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_table(separators: bytes) -> np.ndarray:
    t = np.ones(256, bool)
    t[list(separators)] = False
    return t


SPACE_BYTES = _byte_table(bytes([0x20, *range(0x09, 0x0E)]))
_TO_LOWER = np.arange(256, dtype=np.uint8)
_TO_LOWER[0x41:0x5B] += 32


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [lo, hi) of a string array with their bytes and offsets, about CHUNK_BYTES at a
    time (a longer single text comes alone and whole). Null texts are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + CHUNK_BYTES, "right")) - 1)
        hi = min(hi, len(texts))
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_hashes(data: np.ndarray, off: np.ndarray, table: np.ndarray = SPACE_BYTES,
                lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of some texts and, per text, the index of its first word
    (one more entry at the end)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    if lower:
        data = _TO_LOWER[data]
    inside = table[data]
    cut = np.zeros(n + 1, bool)  # a text starts or ends here
    cut[off] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | cut[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    pw, inv = _powers(n)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * pw[:n], out=prefix[1:])
    h = mix((prefix[e] - prefix[s]) * inv[s] ^ (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return h, np.searchsorted(s, off)


def shingle_hashes(h: np.ndarray, first: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its ``k``-word shingles; a text of fewer words
    has its whole sequence as the one shingle, a text without words has none."""
    n = np.diff(first)
    w = len(h)
    g = np.zeros(w, np.uint64)
    owner_end = np.repeat(first[1:], n)
    pos = np.arange(w)
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    for j in range(k):
        g = mix(g * np.uint64(0x2545F4914F6CDD1D) + np.where(pos + j < owner_end, padded[j:j + w], np.uint64(j + 1)))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        out.append(np.unique(g[a:max(b - k + 1, a + (b > a))]))
    return out

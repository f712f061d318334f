"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Method. Documents are de-duplicated by an exact shuffle on their full text; every distinct text is
encoded and aligned once, and what it adds to a pair's count is weighted by its number of copies.

* *Encode and align.* Both encodings of a text spell the same bytes (a space and the text), so the
  token ends of both cut it into segments: each segment is the overlap of one A token and one B
  token, a *link*; segments that both end together close a *group*. Texts are handled in chunks of
  bounded size with numpy over byte positions.
* *Count.* A chunk hands on its distinct id pairs with the number of documents that hold them (copies
  included), and per text which of the chunk's pairs it links, how often (differences, deflated).
  Pair counts are grouped sums over the chunks' pairs; the best count of an A id is a grouped
  maximum over the counts.
* *Measure.* The counts go back to the chunks that hold the pairs (one row per chunk and pair, not
  per text and pair), and the texts' measures go to the documents by a 128-bit hash of the text.

Cases: a null or empty text, a text that is not UTF-8, and a text whose tokens do not spell exactly
a space and the text in both vocabularies have no tokens: zeros and an empty groups_sha256. Every
row counts as a document of its own, also where doc_id and text repeat; a null doc_id stays; other
columns are ignored; an empty table gives an empty result. One text is encoded by one task: memory
follows the longest text, else ``CHUNK_BYTES``.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.session import materialize

TOKENIZER_DIR = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
CHUNK_BYTES = 1 << 20  # text aligned at once
# Fixed value: the word pattern of byte-level BPE.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_BLANK = re.compile(r"\s{10000}")

_PASS1 = ("chunk bigint, tkey string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
          "links binary, pair bigint, docs bigint")
_PASS2 = ("tkey string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
          "groups_sha256 string")


# ---------------------------------------------------------------- vocabularies

def byte_alphabet() -> dict[str, int]:
    """Character by which a byte-level vocabulary writes each byte: printable Latin-1 characters
    stand for themselves, the other bytes for the characters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """An encoder and the bytes of each of its ids."""
    encode: Callable[[list[str]], list[list[int]]]
    entries: list[bytes]

    def __post_init__(self) -> None:
        self.lengths = np.array([len(e) for e in self.entries], np.int64)


def byte_level(raw: bytes) -> Vocabulary:
    """Byte-level BPE from the bytes of its JSON file. A space goes before every text.

    Where the file is plain byte-level BPE (its merges in the order of their ids, no normaliser, the
    common word pattern), its own vocabulary goes into the faster of the two encoders, which then
    gives the same ids; otherwise, and for texts with very long runs of white space (its pattern
    matcher recurses on them), the file's own encoder is used."""
    spec, alphabet = json.loads(raw), byte_alphabet()
    vocab = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    entries = [b""] * (max(vocab.values()) + 1)
    for entry, i in vocab.items():
        known = all(c in alphabet for c in entry)
        entries[i] = bytes(alphabet[c] for c in entry) if known else entry.encode("utf-8")
    fast, own = _plain_encoder(spec, entries), []

    def one(text: str) -> list[int]:
        if fast is not None and not LONG_BLANK.search(text):
            return fast.encode_ordinary(" " + text)
        if not own:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            own.append(Tokenizer.from_str(raw.decode("utf-8")))
            own[0].encode_special_tokens = True
        return own[0].encode(" " + text, add_special_tokens=False).ids

    return Vocabulary(lambda texts: [one(t) for t in texts], entries)


def _plain_encoder(spec: dict, entries: list[bytes]):
    """The vocabulary of a plain byte-level file in an encoder that merges by id, or None."""
    import tiktoken

    model, split = spec["model"], spec["pre_tokenizer"] or {}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    order = [model["vocab"][m] for m in merged]
    special = {t["id"] for t in spec["added_tokens"]}
    ranks = {entries[i]: i for i in model["vocab"].values() if i not in special}
    plain = (model["type"] == "BPE" and spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex")
             and not split["add_prefix_space"] and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
             and all(x < y for x, y in zip(order, order[1:])) and len(ranks) == 256 + len(order) and all(bytes([b]) in ranks for b in range(256))
             and all(ranks[bytes([b])] < order[0] for b in range(256)))
    return tiktoken.Encoding("file", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}) if plain else None


def piece_level(raw: bytes) -> Vocabulary:
    """Piece BPE with byte fallback from the bytes of its model file, which adds the space itself."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    entries = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode("utf-8")
               for i, p in enumerate(pieces)]
    return Vocabulary(lambda texts: sp.encode(texts, num_threads=1), entries)


_LOADED: dict[str, Vocabulary] = {}


def _vocabulary(kind: Callable[[bytes], Vocabulary], raw: bytes) -> Vocabulary:
    """One vocabulary per worker, kept between tasks."""
    key = f"{kind.__name__}-{hashlib.sha256(raw).hexdigest()}"
    if key not in _LOADED:
        _LOADED[key] = kind(raw)
    return _LOADED[key]


# ---------------------------------------------------------------- alignment of a chunk

@dataclass
class Aligned:
    """Alignment of some texts: per text the numbers of tokens, groups and links and the digest of
    the groups; per link the text, the A id and the B id."""
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    text: np.ndarray
    a: np.ndarray
    b: np.ndarray


def _ids(texts: list[bytes], vocabulary: Vocabulary) -> list[list[int]]:
    """Ids per text; none where they do not spell a space and the text."""
    known = []
    for t in texts:
        try:
            known.append(t.decode("utf-8"))
        except UnicodeDecodeError:
            known.append("")
    entry = vocabulary.entries.__getitem__
    return [ids if s and b"".join(map(entry, ids)) == b" " + t else []
            for t, s, ids in zip(texts, known, vocabulary.encode(known), strict=True)]


def align(texts: list[bytes], va: Vocabulary, vb: Vocabulary) -> Aligned:
    """Align the two encodings of every text. See the module docstring."""
    ids_a, ids_b = _ids(texts, va), _ids(texts, vb)
    for i, (x, y) in enumerate(zip(ids_a, ids_b, strict=True)):
        if not x or not y:
            ids_a[i] = ids_b[i] = []
    n_a, n_b = np.array([len(x) for x in ids_a], np.int64), np.array([len(x) for x in ids_b], np.int64)
    a = np.fromiter(itertools.chain.from_iterable(ids_a), np.int64, n_a.sum())
    b = np.fromiter(itertools.chain.from_iterable(ids_b), np.int64, n_b.sum())
    del ids_a, ids_b
    if not len(a):
        zero = np.zeros(len(texts), np.int64)
        return Aligned(n_a, n_b, zero, zero, [""] * len(texts), zero[:0], a, b)
    end_a, end_b = np.cumsum(va.lengths[a]), np.cumsum(vb.lengths[b])
    mark = np.zeros(end_a[-1], np.uint8)  # texts follow each other; both encodings end where a text ends
    mark[end_a - 1] |= 1
    mark[end_b - 1] |= 2
    ends = mark[np.flatnonzero(mark)]
    is_a, is_b, shut = ends & 1, ends >> 1, (ends == 3).astype(np.int64)
    of_a = np.cumsum(is_a, dtype=np.int64) - is_a
    of_b = np.cumsum(is_b, dtype=np.int64) - is_b
    group = np.cumsum(shut) - shut
    text = np.repeat(np.arange(len(texts)), n_a)[of_a]
    n_links = np.bincount(text, minlength=len(texts))
    n_groups = np.bincount(text[shut == 1], minlength=len(texts))
    # groups in order, A ids of a group before its B ids, each id with the sign after it
    group_a, group_b = group[is_a == 1], group[is_b == 1]
    total = int(shut.sum())
    before_a = np.concatenate([[0], np.cumsum(np.bincount(group_a, minlength=total))])
    before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=total))])
    width = max(len(va.entries), len(vb.entries))
    order = np.zeros(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + before_b[group_a]] = a + width * (np.arange(len(a)) + 1 == before_a[group_a + 1])
    order[np.arange(len(b)) + before_a[group_b + 1]] = b + 2 * width * (np.arange(len(b)) + 1 == before_b[group_b + 1])
    signs = _signed(width)
    digests, at = [], 0
    for n in (n_a + n_b).tolist():
        spelt = b"".join(map(signs.__getitem__, order[at:at + n].tolist()))
        digests.append(hashlib.sha256(spelt[:-1]).hexdigest() if n else "")
        at += n
    return Aligned(n_a, n_b, n_groups, n_links, digests, text, a[of_a], b[of_b])


_SIGNED: dict[int, list[bytes]] = {}


def _signed(width: int) -> list[bytes]:
    """Decimal ids followed by a comma, a bar or a semicolon."""
    if width not in _SIGNED:
        _SIGNED[width] = [f"{i}{sign}".encode() for sign in ",|;" for i in range(width)]
    return _SIGNED[width]


def _packed(index: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending pair numbers as differences, and how often each is linked."""
    return zlib.compress(np.concatenate([np.diff(index, prepend=0), times]).astype("<i4").tobytes(), 1)


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zlib.decompress(raw), "<i4").astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


# ---------------------------------------------------------------- passes

def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[int], list[str]]]:
    texts, copies, keys, size = [], [], [], 0
    for b in batches:
        for t, m, k in zip(b.column("text"), b.column("copies"), b.column("tkey"), strict=True):
            t = t.as_buffer().to_pybytes()
            if texts and size + len(t) > CHUNK_BYTES:
                yield texts, copies, keys
                texts, copies, keys, size = [], [], [], 0
            texts.append(t)
            copies.append(m.as_py())
            keys.append(k.as_py())
            size += len(t)
    if texts:
        yield texts, copies, keys


def _rows(schema: pa.Schema, n: int, **columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
                                       for f in schema], schema=schema)


_ARROW1 = pa.schema([("chunk", pa.int64()), ("tkey", pa.string()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                     ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.binary()), ("pair", pa.int64()),
                     ("docs", pa.int64())])


def _aligner(raw_a, raw_b):
    """Pass over distinct texts: a row per text and a row per (chunk, id pair)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        va, vb = _vocabulary(byte_level, raw_a.value), _vocabulary(piece_level, raw_b.value)
        width, first = len(vb.entries), TaskContext.get().partitionId() << 32
        for number, (texts, copies, keys) in enumerate(_chunks(batches)):
            al = align(texts, va, vb)
            space = len(va.entries) * width
            held, times = np.unique(al.text * space + al.a * width + al.b, return_counts=True)
            text, pair = held // space, held % space
            pairs, index = np.unique(pair, return_inverse=True)
            docs = np.zeros(len(pairs), np.int64)
            np.add.at(docs, index, np.array(copies, np.int64)[text])
            cut = np.searchsorted(text, np.arange(len(texts) + 1))
            links = [_packed(index[lo:hi], times[lo:hi]) for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
            chunk = first + number
            yield _rows(_ARROW1, len(texts), chunk=np.full(len(texts), chunk), tkey=keys, n_a=al.n_a, n_b=al.n_b,
                        n_groups=al.n_groups, n_links=al.n_links, groups_sha256=al.digests, links=links)
            for lo in range(0, len(pairs), 1 << 16):
                some = slice(lo, lo + (1 << 16))
                yield _rows(_ARROW1, len(pairs[some]), chunk=np.full(len(pairs[some]), chunk), pair=pairs[some], docs=docs[some])
    return run


def _measure(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """Texts of a chunk with the corpus-wide counts of the chunk's pairs."""
    order = np.argsort(pairs.column("pair").to_numpy())
    count = pairs.column("docs").to_numpy()[order].astype(np.int64)
    best = pairs.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    n_best, count_sum = [], []
    for raw in texts.column("links"):
        index, times = _unpacked(raw.as_buffer().to_pybytes())
        n_best.append(int((best[index] * times).sum()))
        count_sum.append(int((count[index] * times).sum()))
    whole = {c: texts.column(c) for c in ("tkey", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(whole | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()),
                             "groups_sha256": texts.column("groups_sha256")})


@dataclass
class Alignment:
    """``pairs``: (a_id, b_id, docs, best) of the corpus; ``measures``: a row per document."""
    pairs: DataFrame
    measures: DataFrame


def align_corpus(docs: DataFrame, byte_bpe: str | None = None, piece_bpe: str | None = None) -> Alignment:
    """Align two tokenizers over ``docs`` (needs doc_id, text). The two files are read on the driver
    (a few MB, whatever the corpus) and sent to the executors. See the module docstring."""
    spark = docs.sparkSession
    raws = []
    for path in (byte_bpe or f"{TOKENIZER_DIR}/{BYTE_BPE}", piece_bpe or f"{TOKENIZER_DIR}/{PIECE_BPE}"):
        with open(path, "rb") as f:
            raws.append(f.read())
    width = len(piece_level(raws[1]).entries)
    src = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    spelt = F.octet_length("text") > 0
    distinct = src.filter(spelt).groupBy("text").agg(F.count("*").alias("copies")).withColumn("tkey", F.md5("text"))
    first = materialize(distinct.mapInArrow(_aligner(*[spark.sparkContext.broadcast(r) for r in raws]), _PASS1), "aligned")

    held = first.filter("pair IS NOT NULL").select("chunk", "pair", "docs")
    counts = held.groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a_id", F.expr(f"pair div {width}"))
    top = counts.groupBy("a_id").agg(F.max("docs").alias("top"))
    counts = counts.join(top, "a_id").select("pair", "a_id", F.expr(f"pair % {width}").alias("b_id"), "docs",
                                             (F.col("docs") == F.col("top")).alias("best"))
    known = held.select(F.col("chunk").alias("of"), "pair").join(counts.select("pair", "docs", "best"), "pair")
    texts = first.filter("tkey IS NOT NULL").select("chunk", "tkey", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    measured = texts.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(_measure, _PASS2)

    rows = src.select("doc_id", F.when(spelt, F.md5("text")).alias("tkey"))
    zeros = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    out = rows.filter("tkey IS NOT NULL").join(measured, "tkey", "left").unionByName(rows.filter("tkey IS NULL"), allowMissingColumns=True)
    return Alignment(counts.select("a_id", "b_id", "docs", "best"),
                     out.select("doc_id", *zeros, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")))

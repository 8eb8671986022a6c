"""Evaluation passages in training documents, found by winnowing.

Both sides keep, of every window of ``WINDOW`` consecutive k-gram hashes, the rightmost smallest. Any shared span of at least
``KGRAM + WINDOW - 1`` words then shares a kept hash. Hits are extended word by word to the whole shared span, and spans are confirmed on the
words themselves.

The fingerprints of both sides meet in an equi-join on the hash. What the documents' side does not need is left out before: a bitmap of
the items' hashes, of fixed size, is all that is broadcast to the pass over the documents. Each fingerprint carries the words around its
k-gram. As kept k-grams of a shared span are at most ``WINDOW`` words apart, the spans verified around them join up to the whole shared
span, so no text has to be fetched again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.common import BROADCAST_LIMIT

KGRAM = 8
WINDOW = 5
SPAN = KGRAM + WINDOW - 1
#: Bits of the bitmap that is broadcast, as a power of two: 2 MiB whatever the number of items. It leaves out fingerprints that no item
#: has; the join on the whole hash decides.
SIEVE_BITS = 24
#: Bytes of one fingerprint in a broadcast table, generously: sixteen words and what holds them.
PRINT_BYTES = 1024
_BUCKET_BITS = 15  # of one ``bitmap_construct_agg``

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)
_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_Q = _U(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, out=out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0x9FB21C651E98DF25)
    return x ^ (x >> _U(32))


_TABLE = np.zeros(256, dtype=bool)
_TABLE[ord("a") : ord("z") + 1] = True
_TABLE[ord("0") : ord("9") + 1] = True


class Words:
    """The words of many texts: runs of a-z and 0-9 after lower-casing, as positions in one byte buffer and as hashes."""

    def __init__(self, texts: list[str]):
        low = [t.lower().encode("utf-8", "replace") for t in texts]
        self.buffer = np.frombuffer(b"\n".join(low) + b"\n", dtype=np.uint8)
        lengths = np.fromiter((len(x) + 1 for x in low), dtype=np.int64, count=len(low))
        is_word = np.zeros(len(self.buffer) + 1, dtype=np.int8)
        is_word[1:] = _TABLE[self.buffer]
        step = np.diff(is_word)
        self.start = np.flatnonzero(step == 1)
        self.end = np.flatnonzero(step == -1)
        #: words [first[i], first[i + 1]) belong to text i
        self.first = np.searchsorted(self.start, np.concatenate([[0], np.cumsum(lengths)]))
        n = len(self.buffer)
        with np.errstate(over="ignore"):
            weighted = np.zeros(n + 1, dtype=_U)
            np.cumsum((self.buffer.astype(_U) + _U(1)) * _powers(_P, n), out=weighted[1:])
            self.hash = _mix((weighted[self.end] - weighted[self.start]) * _powers(_INV, n + 1)[self.start] + (self.end - self.start).astype(_U))

    def text(self, a: int, b: int) -> bytes:
        """Words [a, b) joined by blanks."""
        return b" ".join(self.buffer[self.start[i] : self.end[i]].tobytes() for i in range(a, b))

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        """(kept k-gram hashes, position of their first word). Texts shorter than ``SPAN`` words give none."""
        n = len(self.hash) - KGRAM + 1
        if n < WINDOW:
            return np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64)
        with np.errstate(over="ignore"):
            h = np.zeros(n, dtype=_U)
            for i in range(KGRAM):
                h = h * _Q + self.hash[i : i + n]
            h = _mix(h)
        windows = n - WINDOW + 1
        best, at = h[:windows].copy(), np.arange(windows)
        for j in range(1, WINDOW):
            other = h[j : j + windows]
            lower = other <= best
            best[lower] = other[lower]
            at[lower] = np.flatnonzero(lower) + j
        # a window must lie within one text
        owner = np.searchsorted(self.first, np.arange(len(self.hash)), side="right")
        whole = owner[:windows] == owner[SPAN - 1 : SPAN - 1 + windows]
        at = np.unique(at[whole])
        return h[at], at


FINGERPRINTS = "id long, h long, at int, gram string, before array<string>, after array<string>"
_SIDE = WINDOW - 1
_STRINGS = pa.list_(pa.string())
_ARROW = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("at", pa.int32()), ("gram", pa.string()), ("before", _STRINGS), ("after", _STRINGS)])


def _rows(ids: list[int], texts: list[str], sieve: np.ndarray | None) -> pa.RecordBatch:
    words = Words(texts)
    h, at = words.fingerprints()
    if sieve is not None:
        slot = h >> _U(64 - SIEVE_BITS)
        keep = (sieve[(slot >> _U(3)).astype(np.int64)] >> (slot & _U(7)).astype(np.uint8)) & 1 == 1
        h, at = h[keep], at[keep]
    owner = np.searchsorted(words.first, at, side="right") - 1
    lo, hi = words.first[owner], words.first[owner + 1]
    cut = lambda a, b: [words.buffer[words.start[i] : words.end[i]].tobytes().decode() for i in range(a, b)]
    gram = [words.text(p, p + KGRAM).decode() for p in at.tolist()]
    before = [cut(max(x, p - _SIDE), p)[::-1] for p, x in zip(at.tolist(), lo.tolist(), strict=True)]
    after = [cut(p + KGRAM, min(x, p + KGRAM + _SIDE)) for p, x in zip(at.tolist(), hi.tolist(), strict=True)]
    cols = [[ids[i] for i in owner.tolist()], h.view(np.int64), (at - lo).astype(np.int32), gram, before, after]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW, strict=True)], schema=_ARROW)


def fingerprints(texts: DataFrame, ident: str, text: str, sieve: bytes | None = None) -> DataFrame:
    """Kept k-grams of every text: id, hash, word position, the k-gram itself and up to ``WINDOW - 1`` words on either side, nearest first.

    With a ``sieve`` (see ``sieve_of``) those whose hash is in no text it was built from may be left out. One pass, no shuffle.
    """
    shared = texts.sparkSession.sparkContext.broadcast(sieve) if sieve is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.uint8) if shared is not None else None
        for b in batches:
            ids, many = b.column(0).to_pylist(), b.column(1).to_pylist()
            for chunk in _chunks(many):
                out = _rows(ids[chunk], many[chunk], bits)
                if out.num_rows:
                    yield out

    # SPAN words have at least that many characters and the gaps between them
    long = texts.filter(F.length(text) >= 2 * SPAN - 1).select(F.col(ident).cast("long").alias("id"), F.col(text).alias("text"))
    return long.mapInArrow(run, FINGERPRINTS)


def sieve_of(prints: DataFrame) -> tuple[bytes, int]:
    """Bitmap of the leading hash bits, built by map-side combined aggregates and of fixed size, and the number of fingerprints."""
    slot = F.shiftrightunsigned("h", 64 - SIEVE_BITS)
    parts = prints.select(F.shiftright(slot, _BUCKET_BITS).alias("b"), slot.bitwiseAND(F.lit((1 << _BUCKET_BITS) - 1)).alias("s")).groupBy("b").agg(F.bitmap_construct_agg("s").alias("bits"), F.count(F.lit(1)).alias("n"))
    out = bytearray(1 << (SIEVE_BITS - 3))
    per = 1 << (_BUCKET_BITS - 3)
    n = 0
    for r in parts.collect():  # at most 2 ** (SIEVE_BITS - _BUCKET_BITS) rows of 4 KiB
        out[r["b"] * per : r["b"] * per + per] = r["bits"]
        n += r["n"]
    return bytes(out), n


def _same(a: Column, b: Column) -> Column:
    """How many leading words two short lists share."""
    n = F.lit(0)
    for k in range(_SIDE, 0, -1):
        x, y = F.get(a, F.lit(k - 1)), F.get(b, F.lit(k - 1))
        n = F.when(x == y, n + 1).otherwise(F.lit(0))
    return n


def shared_spans(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_words) of every document and item that share ``SPAN`` or more consecutive words.

    n_words is the longest shared span. Null and short texts share nothing. Repeated documents each come out; equal ids count as one.
    """
    tests = fingerprints(items, item_id, text)
    sieve, n_tests = sieve_of(tests)
    docs = fingerprints(documents, doc_id, text, sieve)
    d = docs.select(F.col("id").alias("doc_id"), "h", "gram", F.col("at").alias("p"), F.col("before").alias("db"), F.col("after").alias("da"))
    t = tests.select(F.col("id").alias("item_id"), "h", "gram", F.col("at").alias("q"), F.col("before").alias("tb"), F.col("after").alias("ta"))
    # the items' side is broadcast only if what was counted fits; else both sides shuffle, and
    # a k-gram that very many documents hold makes one large partition of the shuffle, which the skew join splits
    hits = d.join(F.broadcast(t) if n_tests * PRINT_BYTES <= BROADCAST_LIMIT else t.hint("merge"), ["h", "gram"]).select("doc_id", "item_id", (F.col("p") - F.col("q")).alias("diagonal"), (F.col("p") - _same(F.col("db"), F.col("tb"))).alias("x"), (F.col("p") + KGRAM + _same(F.col("da"), F.col("ta"))).alias("y"))
    keys = ["doc_id", "item_id", "diagonal"]
    w = Window.partitionBy(*keys).orderBy("x", "y")
    begins = F.coalesce(F.col("x") > F.max("y").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    runs = hits.withColumn("_new", begins.cast("int")).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy(*keys, "run").agg((F.max("y") - F.min("x")).cast("int").alias("n")).filter(F.col("n") >= SPAN)
    return spans.groupBy("doc_id", "item_id").agg(F.max("n").alias("n_words"))


def _chunks(texts: list[str], size: int = 2 << 20) -> Iterator[slice]:
    """Slices of about ``size`` characters, so that the arrays of one step stay small."""
    at, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= size:
            yield slice(at, i + 1)
            at, n = i + 1, 0
    if at < len(texts):
        yield slice(at, len(texts))

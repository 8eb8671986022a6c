"""Splitting oversized texts at natural boundaries.

Cuts form a hierarchy: section, paragraph, sentence, word, character. A span that fits stays whole; one that does not is divided at its next
finer cuts. The blocks that result are packed greedily into pieces up to the limit, and each piece repeats the end of the one before.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.llm.tokens import DEFAULT_VOCABULARY, Counter, Tokenized, counter

LIMIT = 512
OVERLAP = 64

_EOL = r"(?:\r\n|\r|\n)"
# a cut lies at the end of each match; sections start with a heading line
_SECTION = re.compile(rf"{_EOL}(?=[^\S\r\n]*(?:\#+ |(?:EXAMPLE|Example|CLAIM|Claim|SECTION|Section|TABLE|Table|SEQ ID)\b[^\r\n]{{0,60}}{_EOL}|[A-Z][A-Z ,\-]{{3,60}}{_EOL}))")
_PARAGRAPH = re.compile(rf"{_EOL}[^\S\r\n]*{_EOL}\s*|{_EOL}(?=\[\d{{3,5}}\])")
_SENTENCE = re.compile(rf"[.!?;][\"')\]]?\s+|[。！？；]|{_EOL}")
_WORD = re.compile(r"\s+|(?<=[,\-/)])(?=[^\s\d])|[、，]")

SECTION, PARAGRAPH, SENTENCE = 3, 2, 1
#: Tokens left free when blocks are put together, for what their edges add.
_SLACK = 3


def natural_cuts(text: str) -> list[tuple[int, int]]:
    """(position, strength) of the inner cuts down to sentences, in order; the strongest counts where several meet."""
    cuts: dict[int, int] = {}
    for rx, strength in ((_SENTENCE, SENTENCE), (_PARAGRAPH, PARAGRAPH), (_SECTION, SECTION)):
        for m in rx.finditer(text):
            cuts[m.end()] = strength
    cuts.pop(0, None)
    cuts.pop(len(text), None)
    return sorted(cuts.items())


def _words(doc: Tokenized, start: int, end: int, limit: int) -> list[tuple[int, int, int]]:
    """Blocks of a sentence that is too long: words, and parts of words that are too long themselves."""
    edges = [start, *(m.end() for m in _WORD.finditer(doc.text, start, end) if start < m.end() < end), end]
    blocks: list[tuple[int, int, int]] = []
    for a, b in zip(edges, edges[1:], strict=False):
        # a token has at most ``longest`` bytes, so a longer word is over the limit without being counted
        n = doc.count(a, b) if b - a <= limit * doc.counter.longest else limit + 1
        if n <= limit:
            blocks.append((a, b, n))
        else:
            blocks += _characters(doc, a, b, limit)
    return blocks


def _characters(doc: Tokenized, start: int, end: int, limit: int) -> list[tuple[int, int, int]]:
    blocks = []
    while start < end:
        size = min(end - start, 4 * limit)
        while (n := doc.count(start, start + size)) > limit and size > 1:
            size = max(1, min(size - 1, size * limit // n))
        stop = start + size
        while start + 1 < stop < end and unicodedata.combining(doc.text[stop]):
            stop -= 1
        if stop != start + size:
            n = doc.count(start, stop)
        blocks.append((start, stop, n))
        start = stop
    return blocks


def _blocks(doc: Tokenized, limit: int) -> list[tuple[int, int, int]]:
    """Spans (start, end, tokens) of at most ``limit`` tokens that no piece cuts: the coarsest that fit."""
    cuts = natural_cuts(doc.text)
    edges = [0, *(p for p, _ in cuts), len(doc.text)]
    upto = doc.upto(edges)
    strength = [s for _, s in cuts]  # strength[i] lies between units i and i + 1
    out: list[tuple[int, int, int]] = []
    todo = [(0, len(edges) - 1, SECTION)]
    while todo:
        i, j, level = todo.pop()
        n = upto[j] - upto[i]
        if n <= limit:
            out.append((edges[i], edges[j], n))
        elif j - i == 1:
            out += _words(doc, edges[i], edges[j], limit)
        else:
            inner = [k + 1 for k in range(i, j - 1) if strength[k] >= level]
            bounds = [i, *inner, j]
            todo += [(x, y, level - 1) for x, y in reversed(list(zip(bounds, bounds[1:], strict=False)))]
    return out


def _overlap(doc: Tokenized, start: int, end: int, overlap: int) -> tuple[int, int]:
    """(start, tokens) of the longest run of whole words at the end of [start, end) with at most ``overlap`` tokens; of characters if no
    word begins there."""
    if overlap <= 0:
        return end, 0
    tail = _tail(doc, end, overlap)
    if tail <= start and (n := doc.count(start, end)) <= overlap:
        return start, n
    cuts = [p for m in _WORD.finditer(doc.text, max(start, tail), end) if start < (p := m.end()) < end]
    if cuts:
        # the text's own tokens say about where; the exact counts decide
        last = doc.upto([end])[0]
        i = next((k for k, n in enumerate(doc.upto(cuts)) if last - n <= overlap), len(cuts) - 1)
        while i < len(cuts) and (n := doc.count(cuts[i], end)) > overlap:
            i += 1
        while i > 0 and (m := doc.count(cuts[i - 1], end)) <= overlap:
            i, n = i - 1, m
        if i < len(cuts):
            return cuts[i], n
    return _suffix(doc, start, end, overlap)


def _tail(doc: Tokenized, end: int, overlap: int) -> int:
    """Where no overlap can begin any more: from a few tokens beyond it back until there are too many, and at most that many tokens of the
    greatest length before the end."""
    last = doc.upto([end])[0]
    near = int(doc.ends[last - overlap - 9]) if last > overlap + 8 else 0
    while near > 0 and doc.count(near, end) <= overlap:
        near = max(0, near - (end - near))
    return max(near, end - overlap * doc.counter.longest)


def _suffix(doc: Tokenized, start: int, end: int, overlap: int) -> tuple[int, int]:
    """(start, tokens) of the characters at the end of [start, end) with at most ``overlap`` tokens; no combining mark loses its base."""
    last = doc.upto([end])[0]
    at = max(start, int(doc.ends[last - overlap - 1])) if last > overlap else start
    while at < end and (n := doc.count(at, end)) > overlap:
        at += max(1, (end - at) * (n - overlap) // n)
    while at > start and doc.count(at - 1, end) <= overlap:
        at -= 1
    while at < end and (unicodedata.combining(doc.text[at]) or doc.count(at, end) > overlap):
        at += 1
    return (at, doc.count(at, end)) if at < end else (end, 0)


def split_text(text: str, limit: int, overlap: int, counter: Counter) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, tokens, overlapping characters) of the pieces; each has at most ``limit`` tokens, together they cover the text.

    The blocks are sized to leave room for the overlap. Token counts do not add up exactly across a cut, so each piece is counted as a whole and
    gives back blocks, then as much of the overlap as needed, until it fits.
    """
    # a short text mostly fits, and counting is cheaper than placing the tokens
    if len(text) <= 3 * limit and (n := counter.count(text)) <= limit:
        yield 0, len(text), n, 0
        return
    doc = Tokenized(text, counter)
    if len(doc) <= limit:
        yield 0, len(text), len(doc), 0
        return
    blocks = _blocks(doc, max(1, limit - overlap - _SLACK))
    i, start, n, before = 0, 0, 0, 0
    while i < len(blocks):
        j = i
        while j < len(blocks) and (j == i or n + blocks[j][2] <= limit - _SLACK):
            n += blocks[j][2]
            j += 1
        while (n := doc.count(start, blocks[j - 1][1])) > limit and j > i + 1:
            j -= 1
        if n > limit and doc.count(blocks[i][0], blocks[i][1]) > limit:  # a block right at the limit whose count rose at its edges
            blocks[i : i + 1] = _characters(doc, blocks[i][0], blocks[i][1], max(1, limit - overlap - _SLACK))
            n = doc.count(start, blocks[i][1])
        shorter = overlap
        while n > limit and start < blocks[i][0]:
            shorter = max(0, shorter - max(1, n - limit))
            start = _overlap(doc, before, blocks[i][0], shorter)[0]
            n = doc.count(start, blocks[i][1])
        end = blocks[j - 1][1]
        yield start, end, n, blocks[i][0] - start
        before = blocks[i][0]
        start, n = _overlap(doc, before, end, overlap)
        i = j


def split_documents(documents: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, doc_id: str = "doc_id", text: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Pieces of every text with more than ``limit`` tokens: doc_id, piece_ix, char_start, char_end, n_tokens, overlap_chars, piece.

    Positions count code points. A token covers at least one byte, so texts of at most ``limit`` bytes are left out before any is
    tokenized; null texts give nothing.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be below the limit")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary)
        for b in batches:
            for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                pieces = list(split_text(t, limit, overlap, own))
                if len(pieces) > 1:
                    start, end, n, over = zip(*pieces, strict=True)
                    cols = [pa.array([doc] * len(pieces), pa.int64()), pa.array(range(len(pieces)), pa.int32()), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(n, pa.int32()), pa.array(over, pa.int32()), pa.array([t[x:y] for x, y in zip(start, end, strict=True)])]
                    yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece_ix", "char_start", "char_end", "n_tokens", "overlap_chars", "piece"])

    docs = documents.filter(F.octet_length(text) > limit).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return docs.mapInArrow(split, "doc_id long, piece_ix int, char_start long, char_end long, n_tokens int, overlap_chars int, piece string")

"""Filling fixed-capacity sequences with documents, balanced by estimated cost.

A document of n tokens costs ``linear * n + quadratic * n * n`` (attention within it). Documents go in descending order to the
cheapest sequence with room for them; only a document larger than the capacity is cut. Packing runs in shards of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.common import written
from assayloom.llm.tokens import DEFAULT_VOCABULARY, counter

CAPACITY = 4096
#: Tokens and items of one shard, on average; a shard is packed by one task.
SHARD_TOKENS = 4_000_000
SHARD_ITEMS = 100_000


def token_counts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) of every document with a text; an empty text has 0 tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = counter(vocabulary).count
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n(x) for x in b.column(1).to_pylist()], pa.int64())], names=["doc_id", "n_tokens"])

    docs = documents.filter(F.col(text).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return docs.mapInArrow(count, "doc_id long, n_tokens long")


def pack(sizes: np.ndarray, capacity: int, linear: float = 1.0, quadratic: float | None = None) -> np.ndarray:
    """Sequence number of each item; ``sizes`` descend and none passes ``capacity``.

    Starts with as many sequences as the tokens need and opens another only when none has room.
    """
    quadratic = 1 / capacity if quadratic is None else quadratic
    k = max(1, math.ceil(int(sizes.sum()) / capacity))
    room = np.full(k, capacity, dtype=np.int64)
    cost = np.zeros(k)
    out = np.empty(len(sizes), dtype=np.int64)
    for i, n in enumerate(sizes.tolist()):
        j = int(np.where(room >= n, cost, np.inf).argmin())
        if room[j] < n:
            room, cost = np.append(room, capacity), np.append(cost, 0.0)
            j = len(room) - 1
        out[i] = j
        room[j] -= n
        cost[j] += linear * n + quadratic * n * n
    return out


def pack_documents(documents: DataFrame, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """One row per placed piece: container_id, position, doc_id, piece_ix, token_start, n_tokens.

    Every document with a text is placed exactly once; one larger than ``capacity`` is cut into full pieces and a rest. ``position`` orders
    the pieces of a container; token_start counts the tokens of the document before the piece.
    """
    counts = written(token_counts(documents, doc_id, text, vocabulary))
    total = counts.agg(F.sum("n_tokens").alias("t"), F.sum(F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / capacity))).alias("n")).first()
    shards = max(1, math.ceil((total["t"] or 0) / SHARD_TOKENS), math.ceil((total["n"] or 0) / SHARD_ITEMS))
    last = F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / capacity) - 1).cast("int")
    items = counts.select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0), last)).alias("piece_ix"))
    items = items.select("doc_id", "piece_ix", (F.col("piece_ix") * F.lit(capacity)).cast("long").alias("token_start"), F.least(F.lit(capacity).cast("long"), F.col("n_tokens") - F.col("piece_ix") * F.lit(capacity)).alias("n_tokens"))
    items = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece_ix"), F.lit(shards)).cast("long"))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "piece_ix"], ascending=[False, True, True], ignore_index=True)
        seq = pack(pdf["n_tokens"].to_numpy(), capacity)
        pdf["container_id"] = pdf["shard"] * (1 << 32) + seq
        pdf["position"] = pdf.groupby("container_id").cumcount().astype("int32")
        return pdf[["container_id", "position", "doc_id", "piece_ix", "token_start", "n_tokens"]]

    return items.groupBy("shard").applyInPandas(place, "container_id long, position int, doc_id long, piece_ix int, token_start long, n_tokens long")


def container_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Per container: pieces, tokens, unused tokens and estimated cost."""
    n = F.col("n_tokens").cast("double")
    return packed.groupBy("container_id").agg(F.count(F.lit(1)).alias("n_pieces"), F.sum("n_tokens").alias("n_tokens"), (F.lit(capacity) - F.sum("n_tokens")).alias("unused"), F.sum(n + n * n / capacity).alias("cost"))

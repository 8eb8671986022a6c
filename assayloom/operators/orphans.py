"""References without a valid target: a Bloom filter proves definite orphans, an exact join settles the rest.

The filter is register-blocked and built by Spark itself: a key sets four bits of one 64-bit word, words are OR-ed by a map-side
combined aggregate and gathered into blocks of 1,024 words. A probe is one lookup of a block (a join on its number) and one mask test.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.common import BROADCAST_LIMIT, hot_keys, salted_left_join

BITS_PER_KEY = 16
WORDS = 1024
#: Bytes of one block in memory.
BLOCK_BYTES = WORDS * 8 + 64


@dataclass
class Parents:
    """Target rows of one key space, one row per key: ``n_live`` and ``first_live`` describe rows without ``deleted_at``."""

    table: DataFrame
    most_keys: int


def parents(rows: DataFrame, keys: list[Column], deleted_at: str = "deleted_at", loaded_at: str = "loaded_at") -> Parents:
    """Collapse target rows to one row per key (k0, k1, ...). Rows with a null key part are no target of anything."""
    named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    names = [f"k{i}" for i in range(len(keys))]
    live = F.when(F.col("_deleted").isNull(), F.col("_loaded"))
    df = (
        rows.select(*named, F.col(deleted_at).alias("_deleted"), F.col(loaded_at).alias("_loaded"))
        .dropna(subset=names)
        .groupBy(*names)
        .agg(F.count_if(F.col("_deleted").isNull()).alias("n_live"), F.min(live).alias("first_live"))
        .withColumn("h", F.xxhash64(*names))
    )
    return Parents(df, rows.count())  # from the Parquet footers: an upper bound of the keys


def bloom_blocks(keys: DataFrame, n_blocks: int, h: str = "h") -> DataFrame:
    """(block, words): the filter as arrays of ``WORDS`` 64-bit words. Blocks without a key are absent."""
    word, mask = _word_and_mask(F.col(h))
    words = keys.select(F.pmod(h, F.lit(n_blocks)).alias("block"), word.alias("word"), mask.alias("mask")).groupBy("block", "word").agg(F.bit_or("mask").alias("mask"))
    filled = F.map_from_entries(F.collect_list(F.struct("word", "mask")))
    return words.groupBy("block").agg(filled.alias("m")).select("block", F.expr(f"transform(sequence(0, {WORDS - 1}), i -> coalesce(try_element_at(m, i), 0L))").alias("words"))


def _word_and_mask(h: Column) -> tuple[Column, Column]:
    g = F.xxhash64(h, F.lit(1))
    one = F.lit(1).cast("long")
    parts = [F.call_function("shiftleft", one, F.shiftrightunsigned(g, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(4)]
    return F.shiftrightunsigned(g, 32).bitwiseAND(F.lit(WORDS - 1)).cast("int"), reduce(lambda a, b: a.bitwiseOR(b), parts)


def probe(refs: DataFrame, blocks: DataFrame, n_blocks: int, hot: list[int], h: str = "h", row_id: str = "row_id", broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Add ``maybe``: false proves that no key with this hash was put into the filter.

    A filter of proven size within ``broadcast_limit`` is broadcast. A larger one meets the references block by block, in a join in
    which the blocks of ``hot`` hashes are repeated for the salts of their references.
    """
    word, mask = _word_and_mask(F.col(h))
    refs = refs.withColumn("block", F.pmod(h, F.lit(n_blocks)))
    if n_blocks * BLOCK_BYTES <= broadcast_limit:
        joined = refs.join(F.broadcast(blocks), "block", "left")
    else:
        hot_blocks = sorted({x % n_blocks for x in hot})
        joined = salted_left_join(refs, blocks, [], "block", row_id, hot_blocks)
    return joined.withColumn("maybe", F.coalesce(F.get("words", word).bitwiseAND(mask) == mask, F.lit(False))).drop("block", "words")


def find_orphans(refs: DataFrame, targets: Parents, n_keys: int, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Verdict per reference row: ``missing``, ``deleted`` or ``late``; valid references are left out.

    ``refs`` has src_table, row_id, k0.., loaded_at. A null key part has no target (missing); a null loaded_at is never late. The filter
    is used at any size; ``broadcast_limit`` only decides how it meets the references.
    """
    names = [f"k{i}" for i in range(n_keys)]
    refs = refs.withColumn("h", F.xxhash64(*names))
    n_blocks = max(1, -(-targets.most_keys * BITS_PER_KEY // (WORDS * 64)))
    has_key = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
    hot = hot_keys(refs.select("h"), "h")
    refs = probe(refs, bloom_blocks(targets.table, n_blocks), n_blocks, hot, broadcast_limit=broadcast_limit)
    refs = refs.withColumn("maybe", F.col("maybe") & has_key)
    cols = ["src_table", "row_id", "loaded_at"]
    proven = refs.filter(~F.col("maybe")).select(*cols, F.lit("missing").alias("kind"))
    open_refs = refs.filter("maybe").select(*cols, *names, "h")
    found = salted_left_join(open_refs, targets.table, names, "h", "row_id", hot)
    kind = F.when(F.col("n_live").isNull(), "missing").when(F.col("n_live") == 0, "deleted").when(F.col("first_live") > F.col("loaded_at"), "late")
    return proven.unionByName(found.select(*cols, kind.alias("kind")).filter("kind is not null"))


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans per source table, month of loaded_at and kind."""
    return orphans.groupBy("src_table", F.date_format("loaded_at", "yyyy-MM").alias("month"), "kind").agg(F.count(F.lit(1)).alias("n_orphans"))

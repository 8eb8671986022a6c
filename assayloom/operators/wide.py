"""Entity-attribute-value rows into one row per entity with typed columns.

Attributes and their types are discovered first, duplicates are resolved, and then each attribute's columns are filled by one conditional
aggregate. Attributes are numbered and dealt to blocks of ``BLOCK`` slots: a cell is only compared with the slots of its own block, so the work
is cells times ``BLOCK``, not cells times attributes, and no aggregation grows with the number of attributes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots of one block, the number of conditional aggregates that a cell meets.
BLOCK = 16


@dataclass(frozen=True)
class Attribute:
    ix: int
    name: str | None
    column: str
    #: for every discovered trait, whether any cell has it
    traits: tuple[str, ...]


def resolve_cells(rows: DataFrame, keys: list[str], attr: str, facts: list[str], order: list[str], carried: list[str] | None = None) -> DataFrame:
    """One row per (keys, attr): the facts of the row latest by ``order`` and ``conflict``, true if the rows state two or more
    different fact combinations (null equal to null). All aggregates combine before the shuffle, so a hot cell costs one row per task.
    """
    carried = carried or []
    combo = F.struct(*facts)
    picked = F.max_by(F.struct(*facts, *carried), F.struct(*order))
    return (
        rows.groupBy(*keys, attr)
        .agg(F.min(combo).alias("_lo"), F.max(combo).alias("_hi"), picked.alias("_v"), F.count(F.lit(1)).alias("n_rows"))
        .select(*keys, attr, "_v.*", "n_rows", (~F.col("_lo").eqNullSafe(F.col("_hi"))).alias("conflict"))
    )


def discover(rows: DataFrame, attr: str, traits: dict[str, Column]) -> list[Attribute]:
    """The attribute list in name order, with the traits that occur. Its size is that of the result's header, which a schema needs on the
    driver; the rows are combined before the shuffle.

    A name becomes lower case with ``_`` for what is no letter or digit; names that then agree are numbered.
    """
    found = rows.groupBy(attr).agg(*[F.bool_or(c).alias(f"_{k}") for k, c in traits.items()]).orderBy(F.col(attr).asc_nulls_first()).collect()
    out: list[Attribute] = []
    taken: set[str] = set()
    for i, r in enumerate(found):
        base = re.sub(r"[^a-z0-9]+", "_", (r[0] or "unnamed").lower().replace("%", "pct")).strip("_") or "unnamed"
        column, k = base, 1
        while column in taken:
            k += 1
            column = f"{base}_{k}"
        taken.add(column)
        out.append(Attribute(i, r[0], column, tuple(t for t in traits if r[f"_{t}"])))
    return out


def numbered(cells: DataFrame, attributes: list[Attribute], attr: str) -> DataFrame:
    """Cells with the number of their attribute, ``_ix``, by an equi-join with the attribute list."""
    names = cells.sparkSession.createDataFrame([(a.name, a.ix) for a in attributes], f"_name {dict(cells.dtypes)[attr]}, _ix int")
    return cells.join(names, F.col(attr).eqNullSafe(F.col("_name"))).drop("_name")


def pivot_blocks(cells: DataFrame, keys: list[str], value: Column, block: int = BLOCK) -> DataFrame:
    """(keys, _block, s0, s1, ...): one row per entity and block of attributes; slot i holds the value of attribute ``_block * block + i``.

    ``cells`` are ``numbered`` and have at most one row per (keys, attribute). Every slot is one conditional aggregate. Cells meet in narrow
    form, and an entity's blocks are rows of their own, so that even an entity with all attributes is no large group.
    """
    narrow = cells.select(*keys, F.expr(f"_ix DIV {block}").cast("int").alias("_block"), (F.col("_ix") % block).alias("_slot"), value.alias("_m"))
    # as SQL text: one call into the JVM per aggregate instead of six
    return narrow.groupBy(*keys, "_block").agg(*[F.expr(f"max(CASE WHEN _slot = {i} THEN _m END) AS s{i}") for i in range(block)])


def widen(blocks: DataFrame, keys: list[str], attributes: list[Attribute], fields: dict[str, tuple[str, str, str]], block: int = BLOCK) -> DataFrame:
    """One row per entity: for every attribute a column per field whose trait it has.

    ``fields``: column suffix -> (trait, field of the slots' struct, type). An entity's blocks are gathered (at most one per ``block``
    attributes) and every column reads its slot of its block.
    """
    slots = F.struct(*[f"s{i}" for i in range(block)])
    one = blocks.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_block", slots.alias("s")))).alias("_b"))
    per = [(a, suffix, f, t) for a in attributes for suffix, (trait, f, t) in fields.items() if trait in a.traits]
    needed = sorted({a.ix // block for a, *_ in per})
    # each block is looked up once, then its columns are plain fields
    one = one.select(*keys, *[F.expr(f"try_element_at(_b, {b}) AS _b{b}") for b in needed])
    return one.select(*keys, *[F.expr(f"CAST(_b{a.ix // block}.s{a.ix % block}.{f} AS {t}) AS `{a.column}{suffix}`") for a, suffix, f, t in per])


def unpivot_blocks(blocks: DataFrame, keys: list[str], attributes: list[Attribute], name: str, block: int = BLOCK) -> DataFrame:
    """(keys, name, value) of every filled slot: the cells again, read off the pivoted form."""
    slots = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"s{i}").alias("v")) for i in range(block)])
    long = blocks.select(*keys, "_block", F.explode(F.filter(slots, lambda x: x["v"].isNotNull())).alias("_s"))
    long = long.select(*keys, (F.col("_block") * block + F.col("_s.i")).alias("_n"), F.col("_s.v").alias("value"))
    names = blocks.sparkSession.createDataFrame([(a.ix, a.name) for a in attributes], f"_ix int, {name} string")
    return long.join(names, F.col("_n") == F.col("_ix")).select(*keys, name, "value")

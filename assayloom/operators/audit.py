"""Audits of extracted records: ten checks with one flag schema, and gap detectors over table layouts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.functions import cells as fn

POTENCY = r"(?i)(IC[ _.-]?50|EC[ _.-]?50|\bK[ _-]?[id]\b|inhibition constant|dissociation constant|half.?maximal)"
LOWEST_NM, HIGHEST_NM = 1e-3, 1e6
DISAGREE, BLOCK_ROWS, FEW = 100.0, 4, 5
# Words that name no measurable quantity.
STOP_WORDS = "ic ec gi cc ld kd ki kb mic nm um mm pm assay assays probe test value values data result results method binding inhibition inh activity potency cell cells human mouse rat htrf fret spa elisa tr glo wild type wt mut mutant at of in the and or no nd n a b c d e".split()


def usable(r: str = "") -> Column:
    """Record with id, real name, value or bound, and unit."""
    return F.size(fn.missing_fields(F.col(f"{r}cid"), F.col(f"{r}assay_name"), F.col(f"{r}value_numeric"), F.col(f"{r}range_lo"), F.col(f"{r}range_hi"), F.col(f"{r}unit"))) == 0


def is_potency() -> Column:
    return F.coalesce(F.col("assay_name").rlike(POTENCY), F.lit(False))


def _nm() -> Column:
    return fn.to_nm(F.col("value_numeric"), F.col("unit"))


def _flag(df: DataFrame, check: str, stake: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), "patent_id", stake.cast("long").alias("rows_at_stake"), detail.cast("string").alias("detail"))


def by_patent(records: DataFrame) -> DataFrame:
    """The checks that need counts of a patent only, in one pass: potency_out_of_range (usable potencies of at most 0 or outside the plausible
    range), unnamed_assay (at least ``FEW`` valued records without a real name), impossible_interval (lower bound not below the upper),
    n_runs_dropped (value texts state replicate counts that the records lack: at least ``FEW`` stated, 3 and 10 % missed)."""
    nm = _nm()
    odd = usable() & is_potency() & ((nm <= 0) | (nm < LOWEST_NM) | (nm > HIGHEST_NM))
    nameless = F.col("assay_name").isNull() | (F.col("assay_name") == "") | F.lower("assay_name").contains("unnamed")
    valued = F.col("value_numeric").isNotNull() | F.col("range_lo").isNotNull() | F.col("range_hi").isNotNull()
    g = records.groupBy("patent_id").agg(
        F.count_if(odd).alias("odd"), F.count_if(nameless & valued).alias("nameless"), F.count_if(F.col("range_lo") >= F.col("range_hi")).alias("empty"), F.count_if(F.col("value_text").rlike(r"\([0-9]{1,3}\)")).alias("stated"), F.count("n_runs").alias("kept")
    )
    missed = F.col("stated") - F.col("kept")
    checks = {
        "n_runs_dropped": (missed, (F.col("stated") >= FEW) & (missed >= F.greatest(F.lit(3.0), 0.1 * F.col("stated")))),
        "potency_out_of_range": (F.col("odd"), F.col("odd") > 0),
        "unnamed_assay": (F.col("nameless"), F.col("nameless") >= FEW),
        "impossible_interval": (F.col("empty"), F.col("empty") > 0),
    }
    flags = F.array_compact(F.array(*[F.when(holds, F.struct(F.lit(k).alias("check"), n.cast("long").alias("rows_at_stake"))) for k, (n, holds) in checks.items()]))
    return g.select("patent_id", F.explode(flags).alias("f")).select("f.check", "patent_id", "f.rows_at_stake", F.lit(None).cast("string").alias("detail"))


def unconvertible_unit(records: DataFrame) -> DataFrame:
    """Usable potencies whose unit has no molar factor, per unit."""
    bad = records.filter(usable() & is_potency() & F.col("value_numeric").isNotNull() & _nm().isNull())
    return _flag(bad.groupBy("patent_id", "unit").agg(F.count(F.lit(1)).alias("n")), "unconvertible_unit", F.col("n"), F.col("unit"))


def same_assay_disagrees(records: DataFrame) -> DataFrame:
    """Assays whose medians over tables of at least four positive potencies lie a factor of 100 apart."""
    pos = records.filter(usable() & is_potency()).withColumn("nm", _nm()).filter("nm > 0").withColumn("name", F.lower("assay_name"))
    med = pos.groupBy("patent_id", "name", "table_id").agg(F.median("nm").alias("m"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= BLOCK_ROWS)
    g = med.groupBy("patent_id", "name").agg(F.max("m").alias("hi"), F.min("m").alias("lo"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).filter(F.col("k") >= 2).filter(F.col("hi") / F.col("lo") >= DISAGREE)
    return _flag(g, "same_assay_disagrees", F.col("n"), F.col("name"))


def duplicate_facts(records: DataFrame) -> DataFrame:
    """Facts stated more than once: what is at stake are the repeats."""
    facts = ["cid", "assay_name", "table_id", "value_numeric", "letter_grade", "range_lo", "range_hi", "unit"]
    g = records.groupBy("patent_id", *facts).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").groupBy("patent_id").agg(F.sum(F.col("n") - 1).alias("n"))
    return _flag(g, "duplicate_facts", F.col("n"), F.lit(None))


def names_quantity(name: Column) -> Column:
    """Whether some word of a name, of two letters or digits at least and beginning with a letter, may name what was measured."""
    return F.exists(F.split(F.lower(name), r"[^a-z0-9_]+"), lambda w: w.rlike(r"^[a-z][a-z0-9]") & ~w.isin(STOP_WORDS))


def label_names_nothing(records: DataFrame, shown: int = 6) -> DataFrame:
    """Patents with at least ``FEW`` usable records, over all their labels, whose label names nothing measurable; detail holds the most frequent
    labels."""
    bad = records.filter(usable() & ~names_quantity(F.col("assay_name")))
    by_label = bad.groupBy("patent_id", "assay_name").agg(F.count(F.lit(1)).alias("n"))
    # distinct labels of a patent without a quantity: a short list
    labels = F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col("assay_name").alias("name")))), 1, shown), lambda x: x["name"])
    g = by_label.groupBy("patent_id").agg(F.sum("n").alias("n"), F.array_join(labels, "; ").alias("labels"))
    return _flag(g.filter(F.col("n") >= FEW), "label_names_nothing", F.col("n"), F.col("labels"))


def drawn_but_unnumbered(cells: DataFrame) -> DataFrame:
    """Tables with at least three rows that hold a drawing and no id in their first two cells."""
    rows = cells.filter("section = 'body'").groupBy("patent_id", "table_uid", "row_ix").agg(F.bool_or(F.col("chemistry_id").isNotNull()).alias("drawn"), F.bool_or((F.col("cell_ix") < 2) & fn.is_cid_shaped(F.col("text"))).alias("numbered"))
    g = rows.filter("drawn and not numbered").groupBy("patent_id", "table_uid").agg(F.count(F.lit(1)).alias("n")).filter("n >= 3")
    return _flag(g, "drawn_but_unnumbered", F.col("n"), F.col("table_uid"))


def columns_not_grouped(columns: DataFrame) -> DataFrame:
    """Groups with assay columns and two or more id columns: repeating column groups that were read as one."""
    g = columns.groupBy("patent_id", "table_uid", "tgroup_ix").agg(F.count_if(F.col("kind") == "cid").alias("ids"), F.count_if(F.col("kind") == "assay").alias("assays"))
    return _flag(g.filter("ids >= 2 and assays > 0"), "columns_not_grouped", F.col("assays"), F.concat_ws("/", "table_uid", "tgroup_ix"))


#: Passes over records, in order; table checks need cells or columns.
RECORD_CHECKS: list[Callable[[DataFrame], DataFrame]] = [by_patent, unconvertible_unit, same_assay_disagrees, duplicate_facts, label_names_nothing]


def audit(records: DataFrame, cells: DataFrame | None = None, columns: DataFrame | None = None) -> DataFrame:
    """All flags: check, patent_id, rows_at_stake, detail. Sort by rows_at_stake for display."""
    flags = [c(records) for c in RECORD_CHECKS]
    flags += [drawn_but_unnumbered(cells)] if cells is not None else []
    flags += [columns_not_grouped(columns)] if columns is not None else []
    return reduce(DataFrame.unionByName, flags)


# -- gap detectors ---------------------------------------------------------------------------------------------------------------


def usable_yield(cells: DataFrame, records: DataFrame, least: int = 10) -> DataFrame:
    """Blocks with at least ``least`` measurement-shaped body cells: shaped, usable records, yield; only poor ones (< 0.5 or 10 unread)."""
    shaped = cells.filter("section = 'body'").filter(fn.value_shape(F.col("text")).isin("num", "bin")).groupBy("table_uid").agg(F.count(F.lit(1)).alias("shaped"))
    read = records.groupBy("table_uid").agg(F.count_if("usable").alias("usable"))
    out = shaped.filter(F.col("shaped") >= least).join(read, "table_uid", "left").fillna(0, ["usable"])
    return out.withColumn("ratio", F.col("usable") / F.col("shaped")).filter("ratio < 0.5 or shaped - usable >= 10")


def duplicate_labels(columns: DataFrame, keys: list[str]) -> DataFrame:
    """Assay columns of a group that share a name."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys, "header"))
    return columns.filter("kind = 'assay' and header is not null").withColumn("n", n).filter("n > 1")


def dead_columns(cells: DataFrame, columns: DataFrame, records: DataFrame, keys: list[str], least: int = 5) -> DataFrame:
    """Assay columns with at least ``least`` stated cells and no record, in groups where another assay column has records."""
    stated = cells.filter("section = 'body'").filter(~fn.is_null_marker(F.col("text"))).groupBy(*keys, "col").agg(F.count(F.lit(1)).alias("stated"))
    read = records.groupBy(*keys, "col").agg(F.count(F.lit(1)).alias("n_records"))
    cols = columns.filter("kind = 'assay'").join(stated, [*keys, "col"], "left").join(read, [*keys, "col"], "left").fillna(0, ["stated", "n_records"])
    alive = F.max("n_records").over(Window.partitionBy(*keys))
    return cols.withColumn("alive", alive).filter((F.col("n_records") == 0) & (F.col("stated") >= least) & (F.col("alive") > 0)).drop("alive")


def coherent_unread_ids(all_ids: DataFrame, read: DataFrame, keys: list[str], least: int = 3, share: float = 0.8) -> DataFrame:
    """Per key: short ids that were not read, if there are enough, no more than read ones, and two shapes cover most of them."""
    unread = all_ids.filter(F.length("cid") <= 14).join(read.select(*keys, "cid").distinct(), [*keys, "cid"], "left_anti").select(*keys, "cid").distinct()
    shapes = unread.groupBy(*keys, fn.id_shape(F.col("cid")).alias("shape")).agg(F.count(F.lit(1)).alias("_k"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_k"), "shape"))
    per = shapes.withColumn("_r", rank).groupBy(*keys).agg(F.sum("_k").alias("unread"), F.sum(F.when(F.col("_r") <= 2, F.col("_k")).otherwise(0)).alias("_top"))
    n_read = read.groupBy(*keys).agg(F.count_distinct("cid").alias("n_read"))
    out = per.join(n_read, keys, "left").fillna(0, ["n_read"])
    return out.filter((F.col("unread") >= least) & (F.col("n_read") >= F.col("unread")) & (F.col("_top") >= share * F.col("unread"))).drop("_top")


def yield_contradictions(blocks: DataFrame, least: int = 5) -> DataFrame:
    """Blocks (table_uid, fingerprint, n_rows, n_records) without a record though a block of the same layout has some."""
    best = F.max(F.when(F.col("n_rows") >= least, F.col("n_records"))).over(Window.partitionBy("fingerprint"))
    return blocks.withColumn("twin_records", best).filter((F.col("n_records") == 0) & (F.col("n_rows") >= least) & (F.col("twin_records") > 0))


def gaps_by_precedence(detected: list[DataFrame], key: str) -> DataFrame:
    """Union of detectors (key, gap, rows, extracted), first detector first: one gap per key, severity = rows not extracted."""
    tagged = reduce(DataFrame.unionByName, [d.select(key, "gap", "rows", "extracted").withColumn("_p", F.lit(i)) for i, d in enumerate(detected)])
    one = tagged.groupBy(key).agg(F.min_by(F.struct("gap", "rows", "extracted"), F.struct("_p", "gap")).alias("g"))
    return one.select(key, "g.*").withColumn("severity", F.greatest(F.lit(0).cast("long"), (F.col("rows") - F.col("extracted")).cast("long")))

"""Delivery: one row per compound with nested assays, rollups, trails, losses and the manifest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.functions import cells as fn

TO_UM = {"pM": 1e-6, "nM": 1e-3, "uM": 1.0, "mM": 1e3, "M": 1e6}


def compounds(structures: DataFrame, records: DataFrame, keys: list[str]) -> DataFrame:
    """Identity and measurements of every key of either side (full outer): nested assays sorted by name, counts, best value, metrics.

    Measurements of one key are collected; repeated facts are folded first, so that a key's list holds distinct facts only.
    """
    um = fn.to_nm(F.col("value_numeric"), F.col("unit")) / 1000
    facts = records.select(*keys, "assay_name", "value_numeric", "qualifier", "unit", "letter_grade", "range_lo", "range_hi").withColumn("value_um", um).groupBy(*keys, "assay_name", "value_numeric", "qualifier", "unit", "letter_grade", "range_lo", "range_hi", "value_um").agg(F.count(F.lit(1)).alias("n"))
    one = F.struct(F.col("assay_name").alias("assay"), "value_numeric", "qualifier", "unit", "letter_grade", fn.band(F.col("range_lo"), F.col("range_hi"), F.col("unit")).alias("band"))
    m = facts.groupBy(*keys).agg(
        F.sum("n").alias("n_measurements"),
        F.min("value_um").alias("best_um"),
        F.array_sort(F.collect_set(fn.metric_of(F.col("assay_name")))).alias("metrics"),
        F.array_sort(F.collect_list(one)).alias("assays"),
    )
    # counted in the list at hand: a distinct count would shuffle once more
    m = m.withColumn("n_assays", F.size(F.array_distinct(F.filter(F.col("assays")["assay"], lambda x: x.isNotNull()))).cast("long"))
    out = structures.join(m, keys, "full_outer")
    return out.withColumn("metrics", F.when(F.size("metrics") > 0, F.col("metrics"))).withColumn("status", status()).withColumn("assays_json", F.to_json("assays"))


def status() -> Column:
    """Where a compound's identity comes from: resolved, drawn, named or measured only."""
    return F.when(F.col("inchikey").isNotNull(), "resolved").when(F.col("source") == "image", "drawn").when(F.col("name").isNotNull(), "named").otherwise("measured_only")


def rollup(records: DataFrame, keys: list[str], sets: list[str]) -> DataFrame:
    """Per key: rows and the sorted distinct values of some columns as text."""
    return records.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.array_join(F.array_sort(F.collect_set(s)), ",").alias(f"{s}s") for s in sets])


def trails(rows: DataFrame, buckets: list[tuple[str, Column]], rest: str) -> DataFrame:
    """Add ``trail``: the first bucket whose condition holds; null conditions do not."""
    out: Column | None = None
    for name, cond in buckets:
        c = F.coalesce(cond, F.lit(False))
        out = F.when(c, name) if out is None else out.when(c, name)
    return rows.withColumn("trail", out.otherwise(rest) if out is not None else F.lit(rest))


def losses(branches: list[tuple[str, DataFrame, list[str]]], key: str = "patent_id", cut: int = 200) -> DataFrame:
    """Loss log (loss_type, patent_id, detail): each branch is a type, its rejected rows and the columns to keep, long texts cut."""

    def one(kind: str, df: DataFrame, cols: list[str]) -> DataFrame:
        types = dict(df.dtypes)
        kept = [(F.substr(F.col(c), F.lit(1), F.lit(cut)) if types[c] == "string" else F.col(c)).alias(c) for c in sorted(cols)]
        return df.select(F.lit(kind).alias("loss_type"), F.col(key).alias("patent_id"), F.to_json(F.struct(*kept)).alias("detail"))

    return reduce(DataFrame.unionByName, [one(*b) for b in branches])


def manifest(records: DataFrame, structures: DataFrame, losses: DataFrame) -> DataFrame:
    """One row per figure of a dump: rows, patents, structures by source, losses by type."""
    count = lambda df, what: df.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("figure"), "n")
    parts = [
        count(records, "rows"),
        records.agg(F.count_distinct("patent_id").alias("n")).select(F.lit("patents").alias("figure"), "n"),
        structures.groupBy("source").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("structures:"), F.coalesce("source", F.lit("none"))).alias("figure"), "n"),
        losses.groupBy("loss_type").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("loss:"), F.col("loss_type")).alias("figure"), "n"),
    ]
    return reduce(DataFrame.unionByName, parts)


def write_partitions(df: DataFrame, path: str, by: str = "patent_id") -> None:
    """Replace the partitions that ``df`` has and keep the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_artifact(df: DataFrame, path: str) -> None:
    """Tab-separated with a header; tabs and line breaks in texts become blanks, nulls empty."""
    flat = [F.regexp_replace(F.col(c), r"[\t\r\n]", " ").alias(c) if t == "string" else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("nullValue", "").option("emptyValue", "").csv(path)


def post_batches(df: DataFrame, send, per: int = 1000) -> None:  # noqa: ANN001
    """Send rows as lists of dictionaries, ``per`` at a time, from the tasks that hold them. ``send`` must ignore repeats, as tasks may run twice."""

    def run(rows) -> None:  # noqa: ANN001
        batch = []
        for r in rows:
            batch.append(r.asDict(recursive=True))
            if len(batch) == per:
                send(batch)
                batch = []
        if batch:
            send(batch)

    df.foreachPartition(run)


def write_sheets(sheets: dict[str, DataFrame], path: str) -> None:
    """One delimited folder per sheet of a workbook."""
    for name, df in sheets.items():
        write_artifact(df, f"{path}/{name}")


def aligned_lists(records: DataFrame, keys: list[str]) -> DataFrame:
    """Measurements of a compound as lists of equal length: assays, values, units, in order of assay and value."""
    one = F.array_sort(F.collect_list(F.struct("assay_name", "value_numeric", "unit")))
    return records.groupBy(*keys).agg(one.alias("_a")).select(*keys, F.col("_a.assay_name").alias("assays"), F.col("_a.value_numeric").alias("values"), F.col("_a.unit").alias("units"))


def null_rates(df: DataFrame) -> DataFrame:
    """(column, share of nulls) of a table."""
    return df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in df.columns]).unpivot([], df.columns, "column", "share")

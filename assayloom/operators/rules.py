"""Learned extraction rules: a library keyed by layout fingerprint, grounding, application, the healing merge and spend accounting."""

from __future__ import annotations

import re
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KINDS = ["column_map", "row_regex", "value_pattern", "bin_key", "not_assay", "escalate"]
LIBRARY_SCHEMA = "fingerprint string, kind string, payload string, source string, epoch int, signature string, times_applied long, rows_yielded long"
MAX_PATTERN = 400


class NameResolver(Protocol):
    """name -> structure. The default knows none and says why."""

    def resolve(self, names: DataFrame) -> DataFrame: ...


class NullResolver:
    def resolve(self, names: DataFrame) -> DataFrame:
        return names.withColumns({"smiles": F.lit(None).cast("string"), "inchikey": F.lit(None).cast("string"), "reason": F.lit("no name parser")})


class RuleProposer(Protocol):
    """Gap -> at most one rule. The default proposes none."""

    def propose(self, gap: dict, attempts: list[dict]) -> dict | None: ...


class NullProposer:
    def propose(self, gap: dict, attempts: list[dict]) -> dict | None:
        return None


def load_library(spark: SparkSession, path: str, epoch: int) -> DataFrame:
    """Rules of a JSON-lines library; an escalation of another epoch has expired. A missing library is empty."""
    try:
        rules = spark.read.schema(LIBRARY_SCHEMA).json(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rules = spark.createDataFrame([], LIBRARY_SCHEMA)
    return rules.filter((F.col("kind") != "escalate") | (F.col("epoch") == epoch))


def ground(kind: str, payload: dict, n_cols: int, document: str) -> str | None:
    """Why a rule may not run: null if it may. Indexes lie in the table, patterns are short and not nested, units and names occur."""
    if kind not in KINDS:
        return "unknown kind"
    for ix in [payload.get("cid_index"), *[c.get("index") for c in payload.get("columns", [])]]:
        if ix is not None and not 0 <= ix < n_cols:
            return "column out of range"
    if (pattern := payload.get("pattern")) is not None:
        if len(pattern) > MAX_PATTERN or re.search(r"[+*]\)[+*{]", pattern):
            return "unsafe pattern"
        try:
            re.compile(pattern)
        except re.error:
            return "invalid pattern"
    for b in payload.get("bins", {}).values():
        if b.get("lo") is not None and b.get("hi") is not None and b["lo"] >= b["hi"]:
            return "empty interval"
        if not b.get("unit") or b["unit"] not in document:
            return "unit not in the document"
    for c in payload.get("columns", []):
        if c.get("name") and c["name"] not in document:
            return "name not in the document"
    return None


def apply_column_maps(cells: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """Records of column_map rules: (keys, row_ix, cid, assay_name, text, unit) of body cells whose group has a rule's fingerprint.

    Rules: (fingerprint, cid_index, columns array<struct<index,name,unit>>). The library is the small side; its size is left to the planner.
    """
    hit = cells.filter("section = 'body'").join(rules, "fingerprint")
    ids = hit.filter("col = cid_index").select(*keys, "row_ix", F.col("text").alias("cid"))
    vals = hit.select(*keys, "row_ix", "col", "text", F.explode("columns").alias("c")).filter("col = c.index")
    return vals.join(ids, [*keys, "row_ix"]).select(*keys, "row_ix", "cid", F.col("c.name").alias("assay_name"), "text", F.col("c.unit").alias("unit"))


def informative() -> Column:
    """How much a record says, for the healing merge."""
    from assayloom.operators.audit import usable

    return F.struct(usable().cast("int").alias("a"), (F.col("range_lo").isNotNull() | F.col("range_hi").isNotNull()).cast("int").alias("b"), F.col("value_numeric").isNotNull().cast("int").alias("c"), F.col("unit").isNotNull().cast("int").alias("d"))


def heal_merge(records: DataFrame, keys: list[str], facts: list[str]) -> DataFrame:
    """Per key all records that say the most, without repeated facts. Facts are folded before they meet, so copies of one cost nothing."""
    need = [c for c in ("cid", "assay_name", "value_numeric", "range_lo", "range_hi", "unit") if c not in [*keys, *facts]]
    distinct = records.select(*keys, *facts, *need).distinct().withColumn("_i", informative())
    top = distinct.withColumn("_m", F.max("_i").over(Window.partitionBy(*keys))).filter("_i = _m")
    return top.select(*keys, *facts).distinct()


def superset_replaces(baseline: DataFrame, healed: DataFrame, block: str, item: str) -> DataFrame:
    """(block, replaced): a healed block replaces the baseline if its items include all of the baseline's. Items are counted, not collected."""
    b = baseline.select(block, item).dropna().distinct()
    h = healed.select(block, item).dropna().distinct()
    lost = b.join(h, [block, item], "left_anti").groupBy(block).agg(F.count(F.lit(1)).alias("_lost"))
    blocks = b.select(block).distinct().join(h.groupBy(block).agg(F.count(F.lit(1)).alias("_n")), block, "left").join(lost, block, "left")
    return blocks.select(block, (F.col("_n").isNotNull() & (F.coalesce("_lost", F.lit(0)) == 0)).alias("replaced"))


def similar_layouts(wanted: DataFrame, known: DataFrame, k: int = 3, least: float = 0.4) -> DataFrame:
    """Top ``k`` known layouts per wanted one of the same width, by 0.6 positional shape overlap + 0.4 Jaccard of header words.

    Both: (fingerprint, n_cols, shapes array, words array), distinct by fingerprint. ``wanted`` is a stated set of queries, not all layouts;
    each meets the known layouts of its width.
    """
    w = wanted.select(F.col("fingerprint").alias("wanted"), "n_cols", F.col("shapes").alias("s1"), F.col("words").alias("w1"))
    x = known.select("fingerprint", "n_cols", F.col("shapes").alias("s2"), F.col("words").alias("w2"))
    same = F.aggregate(F.zip_with("s1", "s2", lambda a, b: F.when(a == b, 1.0).otherwise(0.0)), F.lit(0.0), lambda s, y: s + y) / F.greatest(F.size("s1"), F.lit(1))
    union = F.size(F.array_union("w1", "w2"))
    jac = F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect("w1", "w2")) / union)
    pairs = w.join(x, "n_cols").filter("wanted <> fingerprint").withColumn("score", F.round(0.6 * same + 0.4 * jac, 6)).filter(F.col("score") > least)
    return pairs.withColumn("rank", F.row_number().over(Window.partitionBy("wanted").orderBy(F.desc("score"), "fingerprint"))).filter(F.col("rank") <= k).select("wanted", "fingerprint", "score", "rank")


def cost(tokens_in: Column, tokens_out: Column, price_in: float, price_out: float, cache_read: Column | None = None, cache_write: Column | None = None) -> Column:
    """Spend of a call: cache reads cost a tenth, cache writes a quarter more."""
    zero = F.lit(0)
    return tokens_in * price_in + tokens_out * price_out + (cache_read if cache_read is not None else zero) * 0.1 * price_in + (cache_write if cache_write is not None else zero) * 1.25 * price_in


def running_spend(calls: DataFrame, order: list[str], amount: str, thresholds: list[float], bucket: str | None = None) -> DataFrame:
    """Calls with the running total and the thresholds each one crosses.

    With ``bucket`` (a column that sorts as ``order``, such as the day), totals run within buckets in parallel and the buckets' offsets
    are added, so that no single task sorts all calls.
    """
    if bucket:
        per = calls.groupBy(bucket).agg(F.sum(amount).alias("_sum"))
        before = F.coalesce(F.sum("_sum").over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        calls = calls.join(per.withColumn("_before", before).select(bucket, "_before"), bucket)
        w = Window.partitionBy(bucket).orderBy(*order)
    else:
        calls, w = calls.withColumn("_before", F.lit(0.0)), Window.orderBy(*order)
    own = F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = calls.withColumn("total", F.col("_before") + own)
    crossed = F.filter(F.array(*[F.lit(float(t)) for t in thresholds]), lambda t: (F.col("total") >= t) & (F.col("total") - F.col(amount) < t))
    return out.withColumn("crossed", crossed).drop("_before")


def cache_hits(calls: DataFrame, parts: list[str], order: list[str]) -> DataFrame:
    """Calls with their content key and whether an earlier call had it. The first of each key is found by a combined aggregate and joined back,
    so a key that a third of the calls share is no single group.
    """
    key = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts]), 256)
    out = calls.withColumn("cache_key", key)
    first = out.groupBy("cache_key").agg(F.min(F.struct(*order)).alias("_first"))
    return out.join(first, "cache_key").withColumn("hit", ~F.struct(*order).eqNullSafe(F.col("_first"))).drop("_first")


def coverage_join(names: DataFrame, scales: list[tuple[str, str]], name: str, out: str = "pattern") -> DataFrame:
    """Each name that a scale's pattern fits, with the pattern whose literal text is longest; different ones of one length give null.

    Scales (pattern, literal) are a list that the caller states, so they are an expression over the names and no join.
    """
    if not scales:
        return names.select(name, F.lit(None).cast("string").alias(out)).limit(0)
    fitting = F.array_compact(F.array(*[F.when(F.col(name).rlike(p), F.struct(F.lit(len(t)).alias("l"), F.lit(p).alias("p"))) for p, t in scales]))
    top = F.array_distinct(F.transform(F.filter("_f", lambda x: x["l"] == F.array_max("_f")["l"]), lambda x: x["p"]))
    hits = names.withColumn("_f", fitting).filter(F.size("_f") > 0)
    return hits.select(name, F.when(F.size(top) == 1, F.get(top, F.lit(0))).alias(out)).distinct()


def apply_row_patterns(rows: DataFrame, rules: DataFrame, keys: list[str], seconds: float = 0.25) -> DataFrame:
    """Records of row_regex rules: (keys, cid, value) where the named groups match the joined row text.

    rows (keys, fingerprint, text), rules (fingerprint, pattern). Patterns are not trusted: each search is cut off after ``seconds``.
    """
    def search(text: pd.Series, pattern: pd.Series) -> pd.DataFrame:
        import regex

        compiled: dict[str, object] = {}
        out = []
        for t, p in zip(text, pattern, strict=True):
            try:
                rx = compiled.setdefault(p, regex.compile(p))
                m = rx.search(t or "", timeout=seconds)
                g = m.groupdict() if m else {}
            except (regex.error, TimeoutError):
                g = {}
            out.append((g.get("cid"), g.get("value")))
        return pd.DataFrame(out, columns=["cid", "value"])

    hit = F.pandas_udf(search, "cid string, value string")
    return rows.join(rules, "fingerprint").withColumn("_h", hit("text", "pattern")).filter("_h.cid is not null and _h.value is not null").select(*keys, "_h.*")


def apply_value_patterns(cells: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, text, value) of cells that the value cascade rejects and a value_pattern rule of their layout reads. Patterns are grounded before."""
    from assayloom.functions import cells as fn

    v = fn.parse_value(F.col("text"))
    open_cells = cells.filter(v["value_numeric"].isNull() & v["letter_grade"].isNull() & ~fn.is_null_marker(F.col("text")))
    read = F.expr("try_cast(nullif(regexp_extract(text, pattern, 1), '') as double)")
    return open_cells.join(rules, "fingerprint").withColumn("value", read).filter("value is not null").select(*keys, "text", "value")


def suppress(blocks: DataFrame, rules: DataFrame) -> DataFrame:
    """Blocks without those whose layout a not_assay rule names."""
    return blocks.join(rules.filter("kind = 'not_assay'").select("fingerprint").distinct(), "fingerprint", "left_anti")


def record_use(library: DataFrame, used: DataFrame) -> DataFrame:
    """The library with usage counters raised: used (fingerprint, rows) of this run."""
    u = used.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("_t"), F.sum("rows").alias("_r"))
    out = library.join(u, "fingerprint", "left")
    return out.withColumns({"times_applied": F.coalesce("times_applied", F.lit(0)) + F.coalesce("_t", F.lit(0)), "rows_yielded": F.coalesce("rows_yielded", F.lit(0)) + F.coalesce("_r", F.lit(0))}).drop("_t", "_r")


def top_rules(library: DataFrame, by: str, k: int = 12) -> DataFrame:
    """The ``k`` rules that proved themselves most (a top-k digest)."""
    return library.filter(F.col(by) > 0).orderBy(F.desc(by), "fingerprint").limit(k)


def outcome(produced: DataFrame, non_assay: DataFrame, columns: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_records, n_conflicts, adopt): a rule's records are adopted if there are some, none repeats a cell that is no measurement, and no
    mapped column is of another kind.

    produced (keys, col, text), non_assay (keys, text), columns (keys, col, kind).
    """
    bad_kind = F.col("kind").isin("mw", "ms", "nmr", "rt", "structure")
    p = produced.join(columns.select(*keys, "col", "kind"), [*keys, "col"], "left").join(non_assay.select(*keys, "text").distinct().withColumn("_x", F.lit(1)), [*keys, "text"], "left")
    g = p.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"), F.count_if(F.coalesce(bad_kind, F.lit(False)) | (F.col("_x") == 1)).alias("n_conflicts"))
    return g.withColumn("adopt", (F.col("n_records") > 0) & (F.col("n_conflicts") == 0))


def heal(gaps: list[dict], proposer: RuleProposer, try_rule, attempts: int = 3) -> list[dict]:  # noqa: ANN001
    """Bounded repair: per gap at most ``attempts`` proposals, each measured by ``try_rule(rule) -> (kept, detail)``; the kept rules.

    Without a proposer nothing is proposed, and the library alone heals.
    """
    kept = []
    for gap in gaps:
        tried: list[dict] = []
        for _ in range(attempts):
            rule = proposer.propose(gap, tried)
            if rule is None:
                break
            ok, detail = try_rule(rule)
            if ok:
                kept.append(rule)
                break
            tried.append({"rule": rule, "detail": detail})
    return kept

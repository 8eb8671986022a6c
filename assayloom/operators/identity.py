"""Identity of compounds: which name, drawing or structure a compound number has, and checks against printed masses and references."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MASS_TOLERANCE = 1.5
SPREAD = 22.5


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in a total order (never an arbitrary one)."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def best_structure(structures: DataFrame, keys: list[str]) -> DataFrame:
    """Best structure per key: one with a structure key before one without, then the earliest."""
    return first_per_key(structures, keys, [F.col("inchikey").isNull().asc(), F.col("structure_id").asc()])


#: Where a name may stand by how sure it is: labelled before bracketed before the start of a line before bare.
SHAPES = ["labelled", "bracketed", "line_start", "bare"]
#: Kinds of reading in the order they are believed.
KINDS = ["raw", "dewrapped", "repaired", "recognised"]


def ranked_structures(structures: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, structure_id, inchikey, mass_check): per key the structure whose mass agrees, then one with a structure key, then the earliest.

    A combined aggregate, so that a key with very many structures costs a row per task.
    """
    rank = F.struct(F.when(F.col("mass_check") == "agree", 0).when(F.coalesce("mass_check", F.lit("")) == "contradict", 2).otherwise(1).alias("m"), F.col("inchikey").isNull().cast("int").alias("k"), F.col("structure_id").alias("s"))
    g = structures.groupBy(*keys).agg(F.min_by(F.struct("structure_id", "inchikey", "mass_check"), rank).alias("_b"))
    return g.select(*keys, "_b.*")


def best_name_text(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the reading of its name to believe: (keys, name_text, line, gap, shape, kind).

    Nearest line, then nearest in characters, then by how the number was written, the longest, and the plainest kind of reading.
    """
    place = lambda c, names: F.coalesce(*[F.when(F.col(c) == n, F.lit(i)) for i, n in enumerate(names)], F.lit(len(names)))
    rank = F.struct(F.col("line"), F.col("gap"), place("shape", SHAPES).alias("s"), (-F.length("name_text")).alias("n"), place("kind", KINDS).alias("k"), F.col("name_text").alias("t"))
    g = texts.filter("name_text is not null").groupBy(*keys).agg(F.min_by(F.struct("name_text", "line", "gap", "shape", "kind"), rank).alias("_b"))
    return g.select(*keys, "_b.*")


def reported_masses(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """(keys, mz, shift): the mass a document states for a compound; the first source that has one counts (rows, then headings, then columns)."""
    tagged = reduce(DataFrame.unionByName, [x.filter("mz is not null").select(*keys, "mz", "shift").withColumn("_p", F.lit(i)) for i, x in enumerate(sources)])
    g = tagged.groupBy(*keys).agg(F.min(F.struct("_p", "mz", "shift")).alias("_m"))
    return g.select(*keys, "_m.mz", "_m.shift")


def by_precedence(routes: list[DataFrame], keys: list[str]) -> DataFrame:
    """Union of routes, best first: a later route adds only keys that no earlier one has. Rows with a null key are kept by all."""
    out = routes[0]
    for r in routes[1:]:
        out = out.unionByName(r.join(out.select(*keys).dropna().distinct(), keys, "left_anti"), allowMissingColumns=True)
    return out


def supersede(rows: DataFrame, found: DataFrame, keys: list[str], value: str, only: Column) -> DataFrame:
    """Replace ``value`` where ``only`` holds by what was found for the key (one row per key)."""
    f = found.select(*keys, F.col(value).alias("_found"))
    return rows.join(f, keys, "left").withColumn(value, F.when(only & F.col("_found").isNotNull(), F.col("_found")).otherwise(F.col(value))).drop("_found")


def mass_verdict(theirs: Column, ours: Column, average: Column | None = None, tolerance: float = MASS_TOLERANCE) -> Column:
    """agrees, contradicts, or unchecked where a mass is missing."""
    delta = F.abs(theirs - ours) if average is None else F.least(F.abs(theirs - ours), F.abs(theirs - average))
    return F.when(delta.isNull(), "unchecked").when(delta <= tolerance, "agrees").otherwise("contradicts")


def unambiguous_mass(masses: DataFrame, keys: list[str], mass: str, order: str, spread: float = SPREAD) -> DataFrame:
    """The last mass per key if all lie within ``spread``, else null."""
    g = masses.filter(F.col(mass).isNotNull()).groupBy(*keys).agg(F.max_by(mass, order).alias("_last"), (F.max(mass) - F.min(mass)).alias("_s"))
    return g.select(*keys, F.when(F.col("_s") <= spread, F.col("_last")).alias(mass))


def tolerance_agreement(reference: DataFrame, ours: DataFrame, keys: list[str], value: str, share: float = 0.01) -> DataFrame:
    """(keys, value, agrees): a reference value agrees if any own value of the key lies within ``share`` of it; keys without own values
    are left out.

    Values are cut to the distinct ones and meet in logarithmic buckets as wide as the tolerance, so that a key with many values does not
    compare each with each.
    """
    bucket = lambda c: F.floor(F.ln(F.greatest(F.abs(c), F.lit(1e-12))) / F.lit(math.log1p(share)))
    own = ours.select(*keys, F.col(value).alias("_o")).dropna().distinct().withColumn("_b", bucket(F.col("_o")))
    ref = reference.select(*keys, value).dropna().distinct().join(own.select(*keys).distinct(), keys, "left_semi")
    near = F.abs(F.col("_o") - F.col(value)) <= share * F.greatest(F.abs(F.col(value)), F.lit(1e-12))
    wide = ref.withColumn("_b", F.explode(F.sequence(bucket(F.col(value)) - 2, bucket(F.col(value)) + 2)))
    return wide.join(own, [*keys, "_b"], "left").groupBy(*keys, value).agg(F.coalesce(F.bool_or(near), F.lit(False)).alias("agrees"))


def asof_before(events: DataFrame, states: DataFrame, keys: list[str], at: str, carried: list[str], bucket: Column | None = None) -> DataFrame:
    """Each event with the latest state of its key at or before it: one union and a running last value, no range join.

    ``bucket`` is an expression of ``at`` that never falls as ``at`` rises, such as its day. With it a key's rows spread over buckets: the last
    value runs within a bucket, and what it begins with comes from the last states of the buckets before.
    """
    e = events.withColumns({c: F.lit(None).cast(dict(states.dtypes)[c]) for c in carried}).withColumn("_e", F.lit(1))
    s = states.select(*keys, at, *carried).withColumns({c: F.lit(None).cast(t) for c, t in events.dtypes if c not in [*keys, at]}).withColumn("_e", F.lit(0))
    both = e.unionByName(s).withColumn("_bk", bucket if bucket is not None else F.lit(0))
    state = F.when(F.col("_e") == 0, F.struct(*carried))
    w = Window.partitionBy(*keys, "_bk").orderBy(at, "_e").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_s", F.last(state, ignorenulls=True).over(w)).filter("_e = 1")
    if bucket is not None:
        last = s.withColumn("_bk", bucket).groupBy(*keys, "_bk").agg(F.max_by(F.struct(*carried), at).alias("_l"))
        slots = last.unionByName(e.withColumn("_bk", bucket).select(*keys, "_bk").distinct().join(last.select(*keys, "_bk"), [*keys, "_bk"], "left_anti"), allowMissingColumns=True)
        before = F.last("_l", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1))
        both = both.join(slots.withColumn("_in", before).select(*keys, "_bk", "_in"), [*keys, "_bk"], "left").withColumn("_s", F.coalesce("_s", "_in"))
    return both.select(*events.columns, *[F.col(f"_s.{c}").alias(c) for c in carried])


def token_hits(texts: DataFrame, doc: str, text: str, kinds: dict[str, str]) -> DataFrame:
    """(doc, kind, token, start, end) of the tokens that are wholly of a kind's pattern; positions count characters, one blank between tokens.

    Tokens are found in Arrow batches within each text, and only hits leave it. The first kind that fits counts.
    """
    import pyarrow as pa

    wanted = [(k, re.compile(p, re.ASCII)) for k, p in kinds.items()]
    fields = pa.schema([("doc", pa.int64()), ("kind", pa.string()), ("token", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for key, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                at = 0
                for token in re.findall(r"\S+", t, re.ASCII):
                    kind = next((k for k, p in wanted if p.fullmatch(token)), None)
                    if kind:
                        out.append((key, kind, token, at, at + len(token)))
                    at += len(token) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), fields, strict=True)], schema=fields)

    rows = texts.filter(F.col(text).isNotNull()).select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc long, kind string, token string, start long, end long").withColumnRenamed("doc", doc)


def within_reach(names: DataFrame, ids: DataFrame, doc: str, bound: int = 25) -> DataFrame:
    """Per name occurrence (doc, name_pos, name_end) the id within ``bound`` characters before or after; two different ids clash to null.

    Positions are bucketed by ``bound``, so that only neighbours meet.
    """
    width = F.lit(bound)
    n = names.withColumn("_b", F.explode(F.sequence((F.col("name_pos") / width).cast("long") - 1, (F.col("name_end") / width).cast("long") + 1)))
    i = ids.withColumn("_b", F.explode(F.sequence((F.col("id_pos") / width).cast("long"), (F.col("id_end") / width).cast("long"))))
    gap = F.greatest(F.col("id_pos") - F.col("name_end"), F.col("name_pos") - F.col("id_end"), F.lit(0))
    hits = n.join(i, [doc, "_b"]).filter(gap <= bound)
    return hits.groupBy(doc, "name_pos").agg(F.when(F.count_distinct("id") == 1, F.min("id")).alias("id"), F.count_distinct("id").alias("n_ids"))


def positional_zip(left: DataFrame, right: DataFrame, keys: list[str], left_order: str, right_order: str) -> DataFrame:
    """n-th with n-th per key, only where both sides have as many.

    Rows are counted first, by combined aggregates; only keys whose counts agree are numbered.
    """
    counts = lambda df, c: df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(c))
    even = counts(left, "_c").join(counts(right, "_d"), keys).filter("_c = _d").select(*keys)

    def numbered(df: DataFrame, order: str) -> DataFrame:
        return df.join(even, keys, "left_semi").withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))

    return numbered(left, left_order).join(numbered(right, right_order), [*keys, "_n"]).withColumnRenamed("_n", "n")


def longest_shared_token(left: DataFrame, right: DataFrame, left_id: str, left_text: str, right_id: str, right_text: str, least: int = 4) -> DataFrame:
    """Each left row with the right row that shares its longest word; a tie between two right rows gives null."""
    toks = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"[^a-z0-9]+"), lambda w: F.length(w) >= least))
    a = left.select(left_id, F.explode(toks(left_text)).alias("_w"))
    b = right.select(right_id, F.explode(toks(right_text)).alias("_w"))
    score = a.join(b, "_w").groupBy(left_id, right_id).agg(F.max(F.length("_w")).alias("score"))
    best = score.groupBy(left_id).agg(F.max("score").alias("_top"))
    top = score.join(best, left_id).filter("score = _top").groupBy(left_id).agg(F.count(F.lit(1)).alias("_k"), F.min(right_id).alias(right_id), F.max("score").alias("score"))
    return top.select(left_id, F.when(F.col("_k") == 1, F.col(right_id)).alias(right_id), "score")


def dictionary_with_suffix(names: DataFrame, entries: DataFrame, name: str, key: str, category: str, stripped: Column) -> DataFrame:
    """Category of a name by exact lookup, else by lookup without one ending; null if neither is listed."""
    e1 = entries.select(F.col(key).alias("_k1"), F.col(category).alias("_c1"))
    e2 = entries.select(F.col(key).alias("_k2"), F.col(category).alias("_c2"))
    out = names.withColumn("_full", F.lower(F.trim(name))).withColumn("_short", stripped)
    out = out.join(e1, F.col("_full") == F.col("_k1"), "left").join(e2, F.col("_short") == F.col("_k2"), "left")
    return out.withColumn("category", F.coalesce("_c1", "_c2")).drop("_full", "_short", "_k1", "_c1", "_k2", "_c2")


def worklist(drawings: DataFrame, assayed: DataFrame, excluded: DataFrame, keys: list[str]) -> DataFrame:
    """Drawings of assayed compounds outside ``excluded``; VALIDATE where a key is known and not contradicted, else RECOVER."""
    job = F.when(F.col("inchikey").isNotNull() & (F.coalesce("mass_check", F.lit("")) != "contradict"), "VALIDATE").otherwise("RECOVER")
    return drawings.join(assayed.select(*keys).distinct(), keys, "left_semi").join(excluded.select(*keys).dropna().distinct(), keys, "left_anti").withColumn("job", job)


def score(results: DataFrame, group: list[str]) -> DataFrame:
    """Per group: agreed, disagreed, unread and accuracy = agreed / (agreed + disagreed), of rows (expected, got)."""
    agreed, read = F.col("expected") == F.col("got"), F.col("got").isNotNull()
    g = results.groupBy(*group).agg(F.count_if(agreed).alias("agreed"), F.count_if(read & ~agreed).alias("disagreed"), F.count_if(~read).alias("unread"))
    return g.withColumn("accuracy", F.try_divide(F.col("agreed").cast("double"), F.col("agreed") + F.col("disagreed")))


def stratified_sample(rows: DataFrame, strata: list[str], row_id: str, per: int, seed: int = 0, salts: int = 64) -> DataFrame:
    """At most ``per`` rows per stratum in the order of a seeded hash: a sample that repeats exactly.

    Each of ``salts`` parts of a stratum keeps its first ``per`` rows, and the stratum's first are among these: no task sees a whole stratum.
    """
    order = [F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string"))).asc(), F.col(row_id).asc()]
    parted = rows.withColumn("_salt", F.pmod(F.xxhash64(row_id), F.lit(salts)))
    first = parted.withColumn("_rn", F.row_number().over(Window.partitionBy(*strata, "_salt").orderBy(*order))).filter(F.col("_rn") <= per)
    return first.withColumn("_rn", F.row_number().over(Window.partitionBy(*strata).orderBy(*order))).filter(F.col("_rn") <= per).drop("_rn", "_salt")


def partition_accounting(ids: DataFrame, statuses: list[tuple[str, DataFrame]], keys: list[str], rest: str) -> DataFrame:
    """Each id in exactly one bucket: the first status whose frame has it, else ``rest``."""
    tagged = reduce(DataFrame.unionByName, [s.select(*keys).dropna().distinct().withColumn("_p", F.lit(i)) for i, (_, s) in enumerate(statuses)])
    first = tagged.groupBy(*keys).agg(F.min("_p").alias("_p"))
    names = F.array(*[F.lit(n) for n, _ in statuses])
    return ids.select(*keys).dropna().distinct().join(first, keys, "left").withColumn("status", F.coalesce(F.get(names, F.col("_p")), F.lit(rest))).drop("_p")


def occurrences(texts: DataFrame, ids: DataFrame, key: str, row: str, text: str, around: int = 24) -> DataFrame:
    """Where the ids of a key occur as whole tokens of its texts: (key, row, id, position, shape).

    Texts are cut to tokens once and meet the ids by an equi-join, however many ids there are. shape: ``labelled`` after a label word,
    ``bracketed``, ``line_start`` before a colon, else ``bare``.
    """
    tokens = texts.select(key, row, F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0)).alias("_t")).filter(F.size("_t") > 0)
    # each token with the one before it, paired within the text
    tokens = tokens.select(key, row, F.posexplode(F.arrays_zip(F.col("_t").alias("t"), F.concat(F.array(F.lit("")), F.slice("_t", 1, F.size("_t") - 1)).alias("b"))).alias("_n", "_z"))
    tokens = tokens.select(key, row, "_n", F.col("_z.t").alias("_tok"), F.lower(F.regexp_replace("_z.b", r"[^A-Za-z]", "")).alias("_before"))
    tokens = tokens.withColumn("id", F.regexp_replace("_tok", r"^[(\[{]+|[)\]},.;:]+$", ""))
    before = F.col("_before")
    shape = F.when(before.isin("example", "compound", "cmpd", "cpd", "ex", "no", "entry"), "labelled").when(F.col("_tok").rlike(r"^\(.*\)"), "bracketed").when((F.col("_n") == 0) & F.col("_tok").endswith(":"), "line_start").otherwise("bare")
    return tokens.withColumn("shape", shape).join(ids.select(key, "id").distinct(), [key, "id"]).select(key, row, "id", F.col("_n").alias("position"), "shape")


def ids_that_are_names(ids: DataFrame, resolved: DataFrame, keys: list[str], names: DataFrame) -> DataFrame:
    """Unresolved ids that are names themselves, with their structure: (keys + columns of ``names``, which is keyed by ``name``)."""
    open_ids = ids.select(*keys).dropna().distinct().join(resolved.select(*keys), keys, "left_anti")
    return open_ids.join(names, open_ids[keys[-1]] == names["name"])

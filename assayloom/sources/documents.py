"""Sources: patent documents with table markup, annotation pages, delimited artifacts.

The scan is native: blocks, rows and cells are cut with regular expressions and exploded with their positions. A tree parser is not an
option, as such documents mix text and markup and name entities that no DTD declares.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Character entities of the markup; the ampersand comes last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&nbsp;": " ", "&#160;": " ", "&micro;": "μ", "&mgr;": "μ", "&mu;": "μ", "&alpha;": "α", "&beta;": "β", "&gamma;": "γ", "&plusmn;": "±", "&deg;": "°", "&middot;": "·", "&copy;": "©", "&#x3bc;": "μ", "&#x2265;": "≥", "&#x2264;": "≤", "&ge;": "≥", "&le;": "≤", "&amp;": "&"}


def unescape(c: Column) -> Column:
    return reduce(lambda s, e: F.replace(s, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), c)


def markup_text(c: Column) -> Column:
    """Text of a fragment: tags cut without a blank in their place, entities resolved, white space single."""
    return F.trim(F.regexp_replace(unescape(F.regexp_replace(c, r"<[^>]+>", "")), r"[\s\x{00A0}]+", " "))


def read_documents(spark: SparkSession, path: str, pattern: str = r"([^/]+)\.xml$") -> DataFrame:
    """docs(patent_id, xml): one row per file of a folder of cached documents; files of other names are left out."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_path", pattern, 1).alias("patent_id"), F.col("value").alias("xml"))
    return files.filter("patent_id <> ''")


def requested(ids: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found documents, loss rows of requested ids without one)."""
    wanted = ids.select("patent_id").distinct()
    missing = wanted.join(docs, "patent_id", "left_anti").select(F.lit("xml_fetch_failed").alias("loss_type"), "patent_id", F.to_json(F.struct(F.lit("not cached").alias("error"))).alias("detail"))
    return docs.join(wanted, "patent_id", "left_semi"), missing


def _blocks(docs: DataFrame) -> DataFrame:
    """(patent_id, block_ix, table_id, block): every table block of each document."""
    return docs.select("patent_id", F.posexplode(F.regexp_extract_all("xml", F.lit(r"(?s)<tables\b.*?</tables>"), F.lit(0))).alias("block_ix", "block")).withColumn("table_id", F.regexp_extract("block", r'<tables[^>]*\bid="([^"]*)"', 1))


def _groups(docs: DataFrame) -> DataFrame:
    own = _blocks(docs).select("patent_id", "block_ix", "table_id", F.posexplode(F.regexp_extract_all("block", F.lit(r"(?s)<tgroup\b.*?</tgroup>"), F.lit(0))).alias("tgroup_ix", "tgroup"))
    return own.withColumn("n_cols", F.regexp_extract("tgroup", r'<tgroup[^>]*\bcols="(\d+)"', 1).try_cast("int"))


def parse_groups(docs: DataFrame) -> DataFrame:
    """tgroups(patent_id, block_ix, table_id, tgroup_ix, n_cols, col_widths)."""
    widths = F.transform(F.regexp_extract_all("tgroup", F.lit(r'<colspec[^>]*\bcolwidth="([0-9.]+)'), F.lit(1)), lambda x: x.try_cast("double"))
    return _groups(docs).select("patent_id", "block_ix", "table_id", "tgroup_ix", "n_cols", widths.alias("col_widths"))


def parse_rows(docs: DataFrame) -> DataFrame:
    """(patent_id, block_ix, table_id, tgroup_ix, section, row_ix, row): rows of head and body; a row without cells stays."""
    groups = _groups(docs)
    parts = []
    for section, tag in (("header", "thead"), ("body", "tbody")):
        inner = F.regexp_extract("tgroup", rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>", 1)
        rows = F.regexp_extract_all(inner, F.lit(r"(?s)<row\b[^>]*?/>|<row\b.*?</row>"), F.lit(0))
        parts.append(groups.select("patent_id", "block_ix", "table_id", "tgroup_ix", F.lit(section).alias("section"), F.posexplode(rows).alias("row_ix", "row")))
    return reduce(DataFrame.unionByName, parts)


def parse_cells(docs: DataFrame) -> DataFrame:
    """cells(patent_id, block_ix, table_id, tgroup_ix, section, row_ix, cell_ix, text, colspan, col_start, chemistry_id).

    A self-closed entry is an empty cell. Start column and span come from the first and last column names (col_start -1: unknown).
    """
    entries = F.regexp_extract_all("row", F.lit(r"(?s)<entry\b[^>]*?/>|<entry\b.*?</entry>"), F.lit(0))
    cells = parse_rows(docs).select("patent_id", "block_ix", "table_id", "tgroup_ix", "section", "row_ix", F.posexplode(entries).alias("cell_ix", "entry"))
    head = F.regexp_extract("entry", r"^<entry\b[^>]*>", 0)
    first, last = (F.regexp_extract(head, rf'\b{a}="[^"0-9]*(\d+)"', 1).try_cast("int") for a in ("namest", "nameend"))
    return cells.select(
        *cells.columns[:-1],
        markup_text(F.col("entry")).alias("text"),
        F.greatest(F.lit(1), F.coalesce(last - first + 1, F.lit(1))).alias("colspan"),
        F.coalesce(first - 1, F.lit(-1)).alias("col_start"),
        F.nullif(F.regexp_extract("entry", r'<chemistry\b[^>]*\bid="([^"]*)"', 1), F.lit("")).alias("chemistry_id"),
    )


def description_text(docs: DataFrame, headings: bool = False) -> DataFrame:
    """(patent_id, text): one line per paragraph of the description, table blocks removed first."""
    body = F.regexp_replace(F.regexp_extract("xml", r"(?s)<description\b.*?</description>", 0), r"(?s)<tables\b.*?</tables>", "")
    tags = r"(?s)<(?:p|heading)\b[^>]*>.*?</(?:p|heading)>" if headings else r"(?s)<p\b[^>]*>.*?</p>"
    return docs.select("patent_id", F.array_join(F.transform(F.regexp_extract_all(body, F.lit(tags), F.lit(0)), markup_text), "\n").alias("text"))


def context_of_blocks(docs: DataFrame) -> DataFrame:
    """(patent_id, block_ix, caption): the last paragraph or heading in the text before each block."""
    pieces = docs.select("patent_id", F.split("xml", r"(?s)<tables\b.*?</tables>").alias("s")).select("patent_id", F.posexplode("s").alias("block_ix", "before"))
    found = F.regexp_extract_all("before", F.lit(r"(?s)<(?:p|heading)\b[^>]*>.*?</(?:p|heading)>"), F.lit(0))
    return pieces.select("patent_id", "block_ix", markup_text(F.try_element_at(found, F.lit(-1))).alias("caption"))


def caption_belongs(caption: Column, title: Column) -> Column:
    """False where caption and title row name different table numbers."""
    n = lambda c: F.nullif(F.upper(F.regexp_extract(c, r"(?i)\btable\s+([0-9]+[a-z]?)", 1)), F.lit(""))
    return F.coalesce(n(caption) == n(title), F.lit(True))


def parse_fidelity(docs: DataFrame) -> DataFrame:
    """Blocks whose cells or rows in the markup differ in number from the parsed ones."""
    source = _blocks(docs).select("patent_id", "block_ix", "table_id", F.regexp_count("block", F.lit(r"<entry\b")).alias("source_cells"), F.regexp_count("block", F.lit(r"<row\b")).alias("source_rows"))
    cells = parse_cells(docs).groupBy("patent_id", "block_ix").agg(F.count(F.lit(1)).alias("parsed_cells"))
    rows = parse_rows(docs).groupBy("patent_id", "block_ix").agg(F.count(F.lit(1)).alias("parsed_rows"))
    out = source.join(cells, ["patent_id", "block_ix"], "left").join(rows, ["patent_id", "block_ix"], "left").fillna(0, ["parsed_cells", "parsed_rows"])
    return out.filter("source_cells <> parsed_cells or source_rows <> parsed_rows")


def annotation_blocks(pages: DataFrame) -> DataFrame:
    """(patent_id, pos, id, name, domain, smiles, inchi_key) of each match item of an annotation page (patent_id, html)."""
    items = pages.select("patent_id", F.posexplode(F.regexp_extract_all("html", F.lit(r'(?s)<li\b[^>]*itemprop="match".*?</li>'), F.lit(0))).alias("pos", "item"))
    field = lambda name: F.nullif(markup_text(F.regexp_extract("item", rf'(?s)<span\b[^>]*itemprop="{name}"[^>]*>(.*?)</span>', 1)), F.lit("")).alias(name)
    return items.select("patent_id", "pos", *[field(n) for n in ("id", "name", "domain", "smiles", "inchi_key")])


def image_urls(pages: DataFrame) -> DataFrame:
    """(patent_id, stem, url): the first picture of each file stem on a page."""
    urls = pages.select("patent_id", F.posexplode(F.regexp_extract_all("html", F.lit(r'"(https?://[^"]+\.png)"'), F.lit(1))).alias("pos", "url"))
    return urls.withColumn("stem", F.regexp_extract("url", r"([^/]+)\.png$", 1)).groupBy("patent_id", "stem").agg(F.min_by("url", "pos").alias("url"))


def headings_with_next(text: DataFrame, doc: str, body: str) -> DataFrame:
    """(doc, line_ix, heading, following): heading lines with the next line that is not blank, found within each text; only they leave it."""
    lines = F.filter(F.transform(F.split(F.regexp_replace(body, r"\r\n?", "\n"), "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: F.trim(s["x"]) != "")
    rows = text.select(doc, lines.alias("_l")).select(doc, F.arrays_zip(F.col("_l").alias("a"), F.slice("_l", 2, F.greatest(F.lit(0), F.size("_l") - 1)).alias("b")).alias("_z"))
    hits = F.filter("_z", lambda z: z["a"]["x"].rlike(r"^(?:[A-Z][A-Z ]{3,40}|(?:Example|Step|Claim) [0-9]+[a-z]?)$"))
    one = rows.filter("size(_z) > 0").select(doc, F.explode(hits).alias("h"))
    return one.select(doc, F.col("h.a.i").alias("line_ix"), F.col("h.a.x").alias("heading"), F.col("h.b.x").alias("following"))


RECORD_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [("patent_id", T.StringType()), ("cid", T.StringType()), ("assay_name", T.StringType()), ("value_numeric", T.DoubleType()), ("qualifier", T.StringType()), ("unit", T.StringType()), ("n_runs", T.IntegerType()), ("letter_grade", T.StringType()), ("range_lo", T.DoubleType()), ("range_hi", T.DoubleType()), ("table_id", T.StringType()), ("column_header", T.StringType()), ("reported_mz", T.DoubleType())]])


def read_artifact(spark: SparkSession, path: str, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """A tab-separated artifact with a header line; empty fields are null."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").option("nullValue", "").option("emptyValue", "").csv(path)


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """Reference values (patent_id, ligand, inchikey, metric, value) from a quoteless tab-separated file with one column per metric."""
    raw = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    metrics = [c for c in raw.columns if c.endswith("(nM)")]
    long = raw.unpivot([F.col("Patent Number").alias("patent_id"), F.col("BindingDB Ligand Name").alias("ligand"), F.col("Ligand InChI Key").alias("inchikey")], metrics, "metric", "value")
    return long.withColumn("value", F.regexp_replace("value", r"^[<>=~ ]+", "").try_cast("double")).filter("value is not null")


def render_xml(tables: DataFrame) -> DataFrame:
    """docs(patent_id, xml) with the markup of table objects: what the scan reads back (tests, round trips)."""
    esc = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    def entry(c: Column) -> Column:
        span = F.when(c["colspan"] > 1, F.format_string(' namest="c%d" nameend="c%d"', F.lit(1), c["colspan"])).otherwise("")
        drawing = F.when(c["chemistry_id"].isNotNull(), F.concat(F.lit('<chemistry id="'), c["chemistry_id"], F.lit('"/>'))).otherwise("")
        return F.concat(F.lit("<entry"), span, F.lit(">"), drawing, esc(c["text"]), F.lit("</entry>"))

    def rows(col: str, tag: str) -> Column:
        body = F.transform(F.coalesce(F.col(col), F.array().cast(dict(tables.dtypes)[col])), lambda r: F.concat(F.lit("<row>"), F.array_join(F.transform(r, entry), ""), F.lit("</row>")))
        return F.concat(F.lit(f"<{tag}>"), F.array_join(body, ""), F.lit(f"</{tag}>"))

    group = F.concat(F.format_string('<tgroup cols="%d">', "n_cols"), rows("header_rows", "thead"), rows("body_rows", "tbody"), F.lit("</tgroup>"))
    block = tables.withColumn("g", F.struct("tgroup_ix", group.alias("x"))).groupBy("patent_id", "table_uid").agg(F.array_sort(F.collect_list("g")).alias("g"))
    block = block.withColumn("b", F.concat(F.format_string('<tables id="%s"><table>', F.col("table_uid").cast("string")), F.array_join(F.col("g.x"), ""), F.lit("</table></tables>")))
    return block.select(F.concat_ws("-", "patent_id", "table_uid").alias("patent_id"), F.concat(F.lit("<description>"), F.col("b"), F.lit("</description>")).alias("xml"))


WORKLIST = "patent_id string, cid string, job string, chemistry_id string, image_file string, local_path string, url string, expected_inchikey string, n_assays int, assays string"


def read_worklist(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a worklist of drawings (tab-separated, with a header). Columns the file lacks are null, others are ignored."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(path)
    fields = [f.split() for f in WORKLIST.split(", ")]
    return rows.select(*[(F.col(n).try_cast(t) if n in rows.columns else F.lit(None).cast(t)).alias(n) for n, t in fields])

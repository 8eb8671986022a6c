"""What several operators share: table access, plain ids, and joins that survive hot keys."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that may be broadcast at once; every explicit broadcast in the library is behind a check against it.
BROADCAST_LIMIT = 64 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: executors need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="assayloom-")) / "assayloom.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One Parquet table of ``sf_dir``, cut to ``columns`` if any are given."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def plain_cid(c: Column) -> Column:
    """Plain form of a compound id: lower case, no outer blanks, no leading label word. Null stays null."""
    low = F.regexp_replace(F.lower(c), r"(?U)^\s+|\s+$", "")
    return F.regexp_replace(low, r"(?U)^(?:example|ex|compound|cmpd|cpd|no)(?![a-z])\.?\s*", "")


def hot_keys(keys: DataFrame, column: str, share: float = 0.002, most: int = 256) -> list[int]:
    """Values of a 64-bit hash column that hold more than about ``share`` of the rows.

    One pass with a frequent-items sketch whose partial results merge, so neither a shuffle of the keys nor an unbounded
    collect is needed. The answer only routes rows (salting); a miss or a false hit changes no result.
    """
    row = keys.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k({column}, {most}, {most * 40})").alias("top")).first()
    if not row or not row["n"]:
        return []
    return [r["item"] for r in row["top"] or [] if r["item"] is not None and r["count"] > max(1000, share * row["n"])]


def salted_left_join(left: DataFrame, right: DataFrame, on: list[str], hash_column: str, row_id: str, hot: list[int], salts: int = 32) -> DataFrame:
    """Left join in which rows of hot keys spread over ``salts`` partitions.

    ``hash_column`` is a 64-bit hash of ``on`` in both inputs. ``right`` is unique on ``on``, so that repeating its few
    hot rows ``salts`` times is cheap (at most ``len(hot) * salts`` extra rows).
    """
    if not hot:
        return left.join(right, [hash_column, *on], "left")
    is_hot = F.col(hash_column).isin(hot)
    left = left.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int")).otherwise(0))
    right = right.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return left.join(right, [hash_column, *on, "_salt"], "left").drop("_salt")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints. Only a local master may do without: its one machine has the temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return "file://" + os.path.join(tempfile.gettempdir(), "assayloom-checkpoint")


def _store(df: DataFrame) -> tuple[DataFrame, str]:
    path = f"{shared_folder(df.sparkSession)}/assayloom-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame) -> DataFrame:
    """The same rows, computed once and read back from a table in the shared folder, so that lost executors cost no recomputation."""
    return _store(df)[0]


def _is_there(spark: SparkSession, path: str) -> bool:
    """Whether a stored table is still complete: the shared folder may be cleaned between queries."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return bool(done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done))


_stored: dict[tuple, tuple[DataFrame, str]] = {}


def written_once(sources: list[DataFrame], what: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``written(build())``, reused by later queries of the session while the sources (frames with ``_metadata``) read the same files with
    the same times and sizes and the stored table is still there."""
    spark = sources[0].sparkSession
    seen = reduce(DataFrame.unionByName, sources).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").groupBy("file_path", "file_size").agg(F.max("file_modification_time").alias("t"))
    state = seen.agg(F.count(F.lit(1)), F.sum(F.xxhash64("file_path", "file_size", "t").cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, what, tuple(state))
    if key not in _stored or not _is_there(spark, _stored[key][1]):
        _stored[key] = _store(build())
    return _stored[key][0]

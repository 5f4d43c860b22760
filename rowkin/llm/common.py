"""What the operators share: scratch tables, stable columns, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local master, whose executors are this
    machine, gets a folder here where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir isn't set; executors of {master} need a folder that all share")
        found = "file:///tmp/checkpoints/rowkin"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Scratch tables of this process that are still there, in the order in which they were begun.
_begun: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    _begun.append(f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _begun[-1]


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: its lineage ends there, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def begun() -> int:
    """A mark for removed_since()."""
    return len(_begun)


def removed_since(spark: SparkSession, mark: int, *kept: DataFrame) -> None:
    """Delete the scratch tables begun since the mark, but for `kept`, once what reads them has been written."""
    stay = {df._scratch for df in kept}
    for path in [p for p in _begun[mark:] if p not in stay]:
        _delete(spark, path)


def removed(spark: SparkSession, df: DataFrame) -> None:
    """Delete a table made by written() that no later plan reads; anything else stays."""
    if getattr(df, "_scratch", None) in _begun:
        _delete(spark, df._scratch)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    _begun.remove(path)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(c, UPPER, LOWER)


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, mod n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


def sized_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """df marked for broadcast if it has at most max_rows rows, else df as it is (Spark then joins by shuffle)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


#: Edges (16 bytes each) up to which one task joins components; the same result as by rounds, with fewer jobs.
FEW_EDGES = 1_000_000


def joined(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root): the smallest node of its component, for each node that isn't it."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, low = at[: len(u)], at[len(u) :], np.arange(len(ids))
    while True:
        x, y = np.minimum(low[a], low[b]), np.maximum(low[a], low[b])
        if (x == y).all():
            other = low != np.arange(len(ids))
            return ids[other], ids[low[other]]
        np.minimum.at(low, y, x)
        while not (low == low[low]).all():
            low = low[low]


def _join_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [pa.Table.from_batches([b]) for b in batches]
    if held:
        t = pa.concat_tables(held)
        node, root = joined(t.column("u").to_numpy(), t.column("v").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["node", "root"])


def components(edges: DataFrame, name: str, most_rounds: int = 60, few: int | None = None) -> DataFrame:
    """Connected components of undirected edges (u, v: bigint): one row (node, root) for each node that is not
    the smallest of its component, by alternating large-star and small-star rounds.

    Each round is two aggregates and two equi-joins over the edges, written to the shared folder. A hub's
    edges are partial-aggregated and its join partition can be split by adaptive execution; nothing goes to
    the driver but a count and a checksum. Up to `few` edges (FEW_EDGES) are joined by one task instead. Edges that written() made stay.
    """
    spark = edges.sparkSession
    given = hasattr(edges, "_scratch")
    edges = edges if given else written(edges, name)
    if edges.count() <= (FEW_EDGES if few is None else few):
        out = written(edges.coalesce(1).mapInArrow(_join_task, "node bigint, root bigint"), name)
        if not given:
            removed(spark, edges)
        return out
    now = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    was = state(now)
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), name)
        removed(spark, now)
        now, (before, was) = after, (was, state(after))
        if was == before:
            out = written(now.select(F.col("u").alias("node"), F.col("v").alias("root")), name)
            removed(spark, now)
            if not given:
                removed(spark, edges)
            return out
    raise RuntimeError(f"components: no end after {most_rounds} rounds")

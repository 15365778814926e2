"""What the operators share: stored intermediate tables, text columns as bytes, connected components."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderweek.session import shared_dir

BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once as Parquet to the folder all executors share, and read back from there.

    It cuts the lineage: what follows survives lost executors without computing the rows again, and sees the same
    rows each time.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


WORKER = "ladderweek_worker_state"


def held(name: str, make):
    """A worker's own object of that name, made once for all tasks that ask for it; it replaces any of another name."""
    module = sys.modules.setdefault(WORKER, types.ModuleType(WORKER))
    if getattr(module, "held_name", None) != name:
        release()
        module.held_name, module.held_object = name, make()
    return module.held_object


def release() -> None:
    """Frees what the worker holds for tasks of another kind, and gives all free memory back to the machine."""
    module = sys.modules.get(WORKER)
    if module is not None:
        module.held_name = module.held_object = None
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of the edges with the smallest node it is connected with.

    Alternating stars: each node hangs its larger neighbours, then its smaller ones, on the smallest neighbour it
    has. A node's neighbours are only ever reduced to their minimum, so a node with very many of them is not
    gathered anywhere, and the number of rounds grows with the logarithm of the longest chain. Each round is stored.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs = stored(pairs, "edges")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        pairs = stored(small, "edges")
        seen = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == before:
            break
        before = tuple(seen)
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )

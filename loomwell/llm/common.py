"""Shared helpers: table access, checkpoints and fixed-size bitmaps."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the text contracts: space, tab, LF, VT, FF, CR.
WS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, a local run (tests) gets a folder of its own,
    and a cluster a ValueError, as no machine's folder is shared there."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known
    path = spark.sparkContext.getCheckpointDir()
    if path is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="loomwell-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    shared = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


_RELEASES: list[Callable[[], None]] = []


def releases(free: Callable[[], None]) -> Callable[[], None]:
    """Registers what frees the state that an operator keeps in a Python worker from task to task."""
    _RELEASES.append(free)
    return free


def release_workers_state() -> None:
    """Called in a task that needs its memory: a reused Python worker may still hold the state of an operator that ran before."""
    for free in _RELEASES:
        free()
    trim_worker()


def trim_worker() -> None:
    """Gives back what the C library and Arrow keep of freed memory; earlier tasks of a reused Python worker leave much of it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(c, UPPER, UPPER.lower())


def pair_hash(c: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes: together a 128-bit key."""
    return F.xxhash64(c), F.xxhash64(F.lit(7), c)


def bitmap(df: DataFrame, value: str, bits: int) -> np.ndarray:
    """A bitmap of 2**bits slots, set at the low bits of each long in column ``value``; ``bits`` alone fixes its size.

    Built with a JVM-side bit_or per 64-slot word, so at most 2**bits / 64 rows reach the driver.
    A full bitmap only filters less; callers always follow it with an exact join.
    """
    slot = F.col(value).bitwiseAND(F.lit((1 << bits) - 1))
    words = (
        df.select(slot.alias("slot"))
        .select(F.shiftrightunsigned("slot", 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(slot & 63 AS INT))").alias("b"))
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
        .toArrow()
    )
    out = np.zeros(max(1, (1 << bits) // 64), dtype=np.int64)
    out[words["w"].to_numpy()] = words["b"].to_numpy()
    return out


def in_bitmap(words: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Whether each slot (already reduced to the bitmap's range) is set."""
    return (words[slots >> 6] >> (slots & 63)) & 1 != 0

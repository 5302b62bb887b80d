"""What the operators of this subpackage share: scratch tables in the shared folder, key-ordered streaming, components."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: list[str] = []
#: Tables of at most this many narrow rows may be broadcast; larger ones are joined by shuffle.
SMALL_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode, where that is unset, one of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _OWN:
            own = tempfile.mkdtemp(prefix="tidemark-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            _OWN.append("file://" + own)
        folder = _OWN[0]
    return folder.rstrip("/")


def _store(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 2 MB instead of Spark's 64, unless the session asks for another size: with long texts two
    tasks of an executor otherwise hold some hundred MB of them, in the JVM and in Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:  # its default shows only without one of our own
        spark.conf.set(key, "2m")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the session's JVM ends if nothing deletes it before."""
    small_batches(spark)
    path = f"{shared_dir(spark)}/tidemark-{name}-{uuid.uuid4().hex}"
    store, at = _store(spark, path)
    store.deleteOnExit(at)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts lineage, and survives a lost executor."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    done = df.sparkSession.read.schema(df.schema).parquet(path)
    done.scratch = path
    return done


def dropped(*tables: DataFrame) -> None:
    """Delete stored tables that only tables stored since, and nothing lazy, were made from."""
    for t in tables:
        store, at = _store(t.sparkSession, t.scratch)
        store.delete(at, True)


def small(df: DataFrame) -> DataFrame:
    """df, marked for broadcast if it is counted to have few rows; beyond that a join with it shuffles."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def salted(left: DataFrame, right: DataFrame, key: str, by: str, how: str = "left", salts: int = 16) -> DataFrame:
    """left joined with right (one row a key), a hot key's rows dealt to `salts` tasks by the hash of the column `by`."""
    n = F.lit(salts)
    many = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", F.pmod(F.xxhash64(by), n).cast("int")).join(many, [key, "_salt"], how).drop("_salt")


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run, for mapInArrow; once its task is done the worker, which Spark keeps, gives its memory back to the system."""

    def own(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return own


def sliced(batch: pa.RecordBatch, column: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most about `most` bytes in one column, at least a row each."""
    start = size = 0
    for k, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        if k > start and size + n > most:
            yield batch.slice(start, k - start)
            start, size = k, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty. The cast to binary copies nothing."""
    return [x or b"" for x in column.cast(pa.string()).cast(pa.binary()).to_pylist()]


def whole_groups(batches: Iterator[pa.RecordBatch], same: Callable[[pa.Table], np.ndarray], least: int = 20_000) -> Iterator[pa.Table]:
    """Tables of at least `least` rows (but for the last) that never cut a group; rows must come ordered by group.

    `same(table)` gives a boolean per row: does it belong to the group of the row before? What is held is bounded
    by `least`, one batch and one group.
    """
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        starts = np.flatnonzero(~same(table))
        if starts[-1]:
            yield table.slice(0, starts[-1])
            table = table.slice(starts[-1])
        held, n = table.to_batches(), 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def new_group(*keys: np.ndarray) -> np.ndarray:
    """For rows ordered by the keys: is the row's group that of the row before?"""
    same = np.ones(len(keys[0]), dtype=bool)
    same[:1] = False
    for k in keys:
        same[1:] &= k[1:] == k[:-1]
    return same


def spans(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lengths 2, 3: owners 0 0 1 1 1 and offsets 0 1 0 1 2."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of 0..n-1 reaches by the links i-j."""
    root = np.arange(n)
    while len(i):
        # only roots are hooked, each to one smaller root; a link stays until its ends have one root
        a, b = root[i], root[j]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
    return root


class Union:
    """Links as they come, held as roots and never all at once."""

    def __init__(self, n: int, most: int = 1 << 20):
        self.root, self.most, self.held, self.size = np.arange(n), most, [], 0

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        i, j = self.root[i], self.root[j]
        new = i != j
        if new.any():
            self.held.append((i[new], j[new]))
            self.size += int(new.sum())
            if self.size > self.most:
                self.roots()

    def roots(self) -> np.ndarray:
        """The smallest index that each reaches."""
        if self.held:
            i, j = (np.concatenate([x[k] for x in self.held]) for k in (0, 1))
            self.root = local_roots(len(self.root), i, j)[self.root]
            self.held, self.size = [], 0
        return self.root


#: Up to so many links, some 3 MB, one task joins in memory what larger sets join by rounds.
FEW_LINKS = 200_000


def _join_few(batches):
    held = [np.stack([b.column(k).to_numpy() for k in (0, 1)]) for b in batches]
    ids, at = np.unique(np.concatenate(held, 1) if held else np.zeros((2, 0), np.int64), return_inverse=True)
    at = at.reshape(2, -1)
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[local_roots(len(ids), at[0], at[1])])], ["id", "component"])


def components(edges: DataFrame, rounds: int = 60, few: int | None = None) -> DataFrame:
    """(id, component) for every id in edges (a, b): the smallest id it reaches.

    Up to `few` links (FEW_LINKS) one task joins them. More are joined by alternating star contraction, with joins and
    partial minima only, so neither links nor components ever meet in one task or on the driver, each round written to the
    shared folder. Self-links and nulls count as no link; their ids are absent from the result. An empty table gives an
    empty result.
    """
    links = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "links")
    if links.count() <= (FEW_LINKS if few is None else few):
        return links.coalesce(1).mapInArrow(frugal(_join_few), "id long, component long")
    mark = None
    for _ in range(rounds):
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.filter("m < u").select("u", F.col("m").alias("v"))
        ).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        settled = large.join(down, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            down.select("u", F.col("m").alias("v"))
        ).distinct()
        before, links = links, stored(settled, "links")
        dropped(before)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    ends = links.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    return ends.union(links.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component")))

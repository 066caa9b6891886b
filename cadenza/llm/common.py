"""Shared plumbing: tables in the shared folder, packed arrays, hash tables and connected components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WHITESPACE = "\t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a temporary one only on a local master."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    held = getattr(spark, "_cadenza_shared", None)
    if held is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        held = spark._cadenza_shared = tempfile.mkdtemp(prefix="cadenza_")
        atexit.register(shutil.rmtree, held, True)
    return held


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: write `df` as Parquet into the shared folder and read it again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table_{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made(spark).append(path)
    return spark.read.schema(df.schema).parquet(path)


def _made(spark: SparkSession) -> list[str]:
    """Tables that this session has written into the shared folder."""
    if not hasattr(spark, "_cadenza_tables"):
        spark._cadenza_tables = []
    return spark._cadenza_tables


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession):
    """Tables written inside are deleted at the end, by which time whatever reads them must have been written itself."""
    made = _made(spark)
    before = len(made)
    try:
        yield
    finally:
        for path in made[before:]:
            delete(spark, path)
        del made[before:]


def joined(many: DataFrame, one: DataFrame, keys: list[str], n: str, total: int, parts: int = 2000) -> DataFrame:
    """`many` joined with `one` (a row for each key) on `keys`, hot keys apart, so that no task gets all rows of one.

    n: column of `one` with the number of rows of `many` that have the key; total: the number of its rows, or
    more.  Keys with over 1 / parts of them are `parts` at most, a proven bound for the broadcast; the rows of
    all others are shuffled.  Column n is left out.
    """
    hot = one.where(F.col(n) * parts > total).drop(n)
    cold = many.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(one.where(F.col(n) * parts <= total).drop(n), keys)
    return many.join(F.broadcast(hot), keys).unionByName(cold)


def steady(df: DataFrame) -> DataFrame:
    """`df` itself if a second run deals its rows to the same partitions (a plain scan), else a written copy."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return df if "FileScan" in plan and "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan else written(df)


def small_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Bound this session's Arrow batches by bytes as well: 10,000 long texts in one batch take an executor's memory twice, in the JVM and in Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key).rstrip("b")
    if held.isdigit() and int(held) > size:  # a size written with a unit is the user's own
        spark.conf.set(key, str(size))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- packed arrays


def pack(*arrays: np.ndarray) -> bytes:
    """Several arrays as one compressed blob, byte planes apart so that sorted or small numbers shrink."""
    head, body = [], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head.append(f"{a.dtype.str}:{len(a)}")
        raw = a.view(np.uint8)
        body.append((raw.reshape(len(a), a.dtype.itemsize).T if len(a) else raw).tobytes())
    top = ",".join(head).encode()
    return zstandard.ZstdCompressor(level=1).compress(len(top).to_bytes(4, "little") + top + b"".join(body))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(raw[:4], "little")
    at, out = 4 + n, []
    for part in raw[4 : 4 + n].decode().split(","):
        kind, size = part.split(":")
        dtype, size = np.dtype(kind), int(size)
        planes = np.frombuffer(raw, np.uint8, size * dtype.itemsize, at)
        out.append(np.ascontiguousarray(planes.reshape(dtype.itemsize, size).T).reshape(-1).view(dtype) if size else np.zeros(0, dtype))
        at += size * dtype.itemsize
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


class Table:
    """A read-only hash table from distinct unsigned 64-bit keys to their place in the given array."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2.5))))
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.append(keys.astype(np.uint64), np.uint64(0))
        self.slot = np.full(1 << bits, len(keys), np.int32)
        left = np.arange(len(keys), dtype=np.int64)
        at = self._first(self.keys[:-1])
        while len(left):
            free = self.slot[at] == len(keys)
            self.slot[at[free]] = left[free]
            lost = self.slot[at] != left
            left, at = left[lost], (at[lost] + 1) & self.mask
        self.n = len(keys)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; n for a key that is absent."""
        keys = keys.astype(np.uint64, copy=False)
        at = self._first(keys)
        out = self.slot[at]
        left = np.flatnonzero((self.keys[out] != keys) & (out != self.n))
        at = at[left]
        while len(left):
            at = (at + 1) & self.mask
            got = self.slot[at]
            out[left] = got
            more = (self.keys[got] != keys[left]) & (got != self.n)
            left, at = left[more], at[more]
        return out


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[start], np.add.reduceat(counts, start)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + sizes[i] - 1 of all i, in order."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)


# ---------------------------------------------------------------- byte strings of a column


def texts(column) -> list[bytes]:
    """The UTF-8 bytes of a string or binary column's rows; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


# ---------------------------------------------------------------- connected components


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each id of the pairs (u, v) to the least id connected with it."""
    ids, both = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = both[: len(u)], both[len(u) :]
    label = np.arange(len(ids))
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            break
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return ids[moved], ids[label[moved]]


def _contract(batches):
    """A spanning forest of each partition's links; holds one chunk of links and the forest so far."""
    u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        u = np.concatenate([u, batch.column(0).to_numpy(zero_copy_only=False)])
        v = np.concatenate([v, batch.column(1).to_numpy(zero_copy_only=False)])
        u, v = forest(u, v)
        if len(u) > 2_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
            u, v = u[:0], v[:0]
    if len(u):
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _stars(e: DataFrame) -> tuple[int, bool]:
    """Number of links, and whether every u has one v and no v is a u."""
    ends = e.select(F.col("u").alias("id"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(e.select(F.col("v").alias("id"), F.lit(0).alias("a"), F.lit(1).alias("b")))
    row = ends.groupBy("id").agg(F.sum("a").alias("a"), F.max("b").alias("b")).agg(F.sum("a").alias("n"), F.max("a").alias("a"), F.max(F.col("a") * F.col("b")).alias("both")).first()
    return row["n"] or 0, not row["n"] or (row["a"] == 1 and row["both"] == 0)


def components(links: DataFrame) -> DataFrame:
    """(id, component): the least id reachable over `links` (u long, v long), for each id that is in a link.

    Alternates large-star and small-star rounds, each written to the shared folder, until only stars are left.
    Links are first contracted inside their partitions, so a dense group arrives as a star.  The links of a
    hub are not gathered: its least neighbour is a partial aggregate and goes out to them.  No link goes to
    the driver; only counts do.
    """
    e = written(links.select("u", "v").mapInArrow(_contract, "u long, v long").where("u <> v"))
    n, done = _stars(e)
    while not done:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n"))
        large = written(joined(both, least, ["u"], "n", 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        small = joined(large, low, ["u"], "n", large.count()).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        e = written(small)
        n, done = _stars(e)
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def named(classes: DataFrame, comp: DataFrame, id_: str = "id") -> DataFrame:
    """`classes` (id, least, n rows) with component_id: the least `least` of the component, or its own where it has no links.

    Only classes with a link are grouped; the name of a large component goes out to its members.
    """
    linked = written(classes.join(comp.withColumnRenamed("id", id_), id_))
    names = linked.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("__members"))
    of = joined(linked.select(id_, "component"), names, ["component"], "__members", linked.count()).select(id_, "component_id", F.lit(True).alias("__linked"))
    return classes.join(of, id_, "left").withColumn("component_id", F.when(F.col("__linked"), F.col("component_id")).otherwise(F.col("least"))).drop("__linked")

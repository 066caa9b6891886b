"""Embedding near-duplicates by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its hash is the
coordinate of largest size with its sign.  A bucket joins two such hashes.  Each vector enters its own
bucket of every table and the `probes` - 1 next likeliest ones, so a pair meets where their probe sets
meet.  Inside a bucket the pairs are verified by cosine in double precision, in blocks: only link counts
and a spanning forest leave the task.  A pair that meets in several buckets counts in the first of them.

Vectors of equal label and components are one class from the start.  Edge cases: null labels; vectors
that are null, empty, zero, or hold null or non-finite components link with nothing and are returned as
their own component; vectors of different lengths never link; a null vec_id never names a component;
repeated rows are copies of each other; very long vectors are hashed whole; extra columns of any name are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, joined, named, partitions, written

TABLES, PROBES, SEED = 4, 3, 20_251


def _signs(width: int, tables: int) -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1.0, 1.0], np.float32), size=(tables, 2, 3, width))


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.float32(np.sqrt(n))


def buckets(x: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """(n, tables, probes) bucket numbers of unit vectors (n, d); a number is distinct for each table."""
    width = max(2, 1 << int(np.ceil(np.log2(max(2, x.shape[1])))))
    padded = np.zeros((len(x), width), np.float32)
    padded[:, : x.shape[1]] = x
    signs, out = _signs(width, tables), np.zeros((len(x), tables, probes), np.int64)
    rows = np.arange(len(x))[:, None]
    for t in range(tables):
        best, loss = [], []
        for part in range(2):
            y = padded
            for d in signs[t, part]:
                y = _hadamard(y * d)
            size = np.abs(y)
            k = min(probes, width)
            top = np.argpartition(-size, k - 1, axis=1)[:, :k]
            top = np.take_along_axis(top, np.argsort(-size[rows, top], axis=1, kind="stable"), axis=1)
            best.append(2 * top + (y[rows, top] < 0))
            loss.append(size[rows, top[:, :1]] - size[rows, top])
        cost = (loss[0][:, :, None] + loss[1][:, None, :]).reshape(len(x), -1)
        both = (best[0][:, :, None] * (2 * width) + best[1][:, None, :]).reshape(len(x), -1)
        pick = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        out[:, t, : pick.shape[1]] = both[rows, pick] + t * (2 * width) ** 2
    return out


def _matrix(column) -> np.ndarray:
    """Arrow lists of equal length as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow of the squares
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _hash(batches, tables: int, probes: int):
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            sizes = part.column("size").to_numpy(zero_copy_only=False)
            for n in np.unique(sizes):
                some = part.take(pa.array(np.flatnonzero(sizes == n)))
                codes = buckets(_unit(_matrix(some.column("v"))), tables, probes).reshape(some.num_rows, -1)
                flat = pa.array(codes.reshape(-1))
                yield pa.RecordBatch.from_arrays([some.column("id"), some.column("label"), some.column("size"), some.column("n"), some.column("v"), pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, codes.shape[1], dtype=np.int32)), flat)], names=["id", "label", "size", "n", "v", "codes"])


def _verify(ids, n, side, bucket, x, codes, least: float):
    """One block pair of one bucket: (places, link counts) and a forest of links (u, v)."""
    a, b = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    count, us, vs = np.zeros(len(ids), np.int64), [], []
    if len(ids) < 2 or not len(a) or not len(b):
        return count, us, vs
    single = x.astype(np.float32)
    step = max(1, (1 << 20) // len(b))
    for at in range(0, len(a), step):
        mine = a[at : at + step]
        i, j = np.nonzero(single[mine] @ single[b].T >= least - 1e-4)
        i, j = mine[i], b[j]
        twice = (side[i] == 2) & (i >= j)
        i, j = i[~twice], j[~twice]
        for cut in range(0, len(i), 1 << 14):
            p, q = i[cut : cut + (1 << 14)], j[cut : cut + (1 << 14)]
            good = np.einsum("ij,ij->i", x[p], x[q]) >= least
            p, q = p[good], q[good]
            # the first bucket that both probe: the least number they share
            first = np.ones(len(p), bool)
            cp, cq = codes[p], codes[q]
            for t in range(codes.shape[1]):
                for k in range(codes.shape[2]):
                    hit = (cp[:, t, k, None] == cq[:, t]).any(axis=1)
                    first &= ~hit | (cp[:, t, k] >= bucket)
            p, q = p[first], q[first]
            if len(p):
                np.add.at(count, p, n[q])
                np.add.at(count, q, n[p])
                u, v = forest(ids[p], ids[q])
                us.append(u)
                vs.append(v)
    return count, us, vs


def _verified(batches, least: float, tables: int):
    """Rows sorted by (label, size, bucket, lo, hi): link counts (kind 0) and links (kind 1)."""
    held, key = [], None

    def close():
        if len(held) == 1 and held[0].num_rows < 2:
            return None
        t = pa.Table.from_batches(held)
        ids = t.column("id").to_numpy()
        codes = _matrix(t.column("codes").combine_chunks()).astype(np.int64).reshape(len(ids), tables, -1)
        count, us, vs = _verify(ids, t.column("n").to_numpy(), t.column("side").to_numpy(), t.column("bucket")[0].as_py(), _unit(_matrix(t.column("v").combine_chunks())), codes, least)
        found = np.flatnonzero(count)
        if not len(found):
            return None
        u, v = forest(np.concatenate(us), np.concatenate(vs))
        kind = np.repeat(np.array([0, 1], np.int32), [len(found), len(u)])
        return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.concatenate([ids[found], u])), pa.array(np.concatenate([count[found], v]))], names=["kind", "u", "v"])

    for batch in batches:
        run = batch.column("run").to_numpy()
        cuts = np.flatnonzero(np.append(True, run[1:] != run[:-1])) if len(run) else []
        for s, e in zip(cuts, np.append(cuts[1:], len(run)) if len(run) else []):
            if held and run[s] != key:
                if out := close():
                    yield out
                held = []
            key = run[s]
            held.append(batch.slice(s, e - s))
    if held and (out := close()):
        yield out


def near_duplicates(vectors: DataFrame, least: float = 0.98, tables: int = TABLES, probes: int = PROBES, block: int = 2048) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `vectors` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    base = vectors.selectExpr("cast(vec_id as bigint) as vec_id", "cast(label as string) as label", "transform(embedding, x -> cast(x as double)) as v")
    sound = "label is not null and v is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(v, x -> x <> 0)"
    base = written(base.selectExpr("vec_id", "label", "v", f"coalesce({sound}, false) as sound", "xxhash64(label, transform(v, x -> x + 0.0D)) as h1", "xxhash64(1, label, transform(v, x -> x + 0.0D)) as h2", "monotonically_increasing_id() as row"))
    live = base.where("sound")
    # equal vectors by 128 bits of hash; a class is numbered by one of its rows
    classes = written(live.groupBy("h1", "h2").agg(F.min("row").alias("id"), F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("n"), F.min("vec_id").alias("least")))
    hashed = classes.selectExpr("id", "label", "size(v) as size", "n", "v").mapInArrow(lambda it: _hash(it, tables, probes), "id long, label string, size int, n long, v array<double>, codes array<bigint>")
    hashed = written(hashed)
    met = hashed.selectExpr("label", "size", "id", "explode(array_distinct(codes)) as bucket")
    # a bucket of one class is dropped before any vector moves; one of many is cut into blocks, its blocks paired
    crowded = met.groupBy("label", "size", "bucket").agg(F.count("*").alias("c")).where("c > 1").selectExpr("label", "size", "bucket", f"cast(ceil(c / {block}) as int) as blocks")
    met = met.join(crowded, ["label", "size", "bucket"]).withColumn("part", F.expr("cast(pmod(xxhash64(id, bucket), blocks) as int)"))
    paired = met.selectExpr("*", "explode(sequence(0, blocks - 1)) as other").selectExpr("id", "bucket", "xxhash64(label, size, bucket, least(part, other), greatest(part, other)) as run", "if(part = other, 2, if(part < other, 0, 1)) as side")
    paired = paired.join(hashed.select("id", "n", "v", "codes"), "id").repartition(partitions(spark), "run").sortWithinPartitions("run")
    out = written(paired.select("run", "bucket", "id", "n", "side", "v", "codes").mapInArrow(lambda it: _verified(it, least, tables), "kind int, u long, v long"))
    counts = out.where("kind = 0").groupBy(F.col("u").alias("id")).agg(F.sum("v").alias("others"))
    comp = components(out.where("kind = 1").select("u", "v"))
    of = named(classes.select("id", "h1", "h2", "n", "least"), comp).join(counts, "id", "left")
    of = of.select("h1", "h2", "n", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"), "component_id")
    found = joined(base.where("sound").select("vec_id", "h1", "h2"), written(of), ["h1", "h2"], "n", base.count()).select("vec_id", "links", "component_id")
    rows = found.unionByName(base.where("not sound").select("vec_id", F.lit(0).cast("long").alias("links"), F.lit(None).cast("long").alias("component_id")))
    return rows.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

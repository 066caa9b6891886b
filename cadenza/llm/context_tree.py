"""Language-model scoring by context-tree weighting over bytes.

A text becomes its lower-cased words joined by single spaces and one end byte.  Every byte is eight binary
decisions; each decision has a tree of contexts, the 0 to DEPTH preceding bytes.  A node mixes its
Krichevsky-Trofimov estimate with the product of its children, half and half, so the prediction weighs all
depths by how well they described the training text.  A context that training never saw leaves the
prediction to its parent.

Each scan task is a block: it packs its texts and the distinct (context, byte) pairs and words it holds,
with training counts.  Pairs meet by their three most recent context bytes, which holds the subtree below
that depth together; node values above are summed over the cluster (at most 256^2 contexts x 255 decisions,
which bounds the broadcast).  The pairs' log-probabilities go back to the blocks that hold them, where the
texts are scored.  What is gathered grows with the corpus; no table of it is broadcast.

Edge cases: null and empty texts are the end byte alone; a null doc_id trains (its crc32 is that of the
empty string) and is returned as null; repeated rows count as often as they occur; extra columns of any name are
ignored; a very long text is one chunk of its block; without training rows every decision is one half; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table, mix, pack, partitions, summed, texts, unpack, written

DEPTH, SPLIT = 5, 3
END = b"\n"
_CHUNK = 1 << 20
#: Parts that contexts and words are dealt to, at least; a task holds one part at a time.
BUCKETS = 512
_SCHEMA = "block int, bucket int, kind int, payload binary"
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _row(block: int, bucket: int, kind: int, payload: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), pa.array([payload], pa.binary())], names=["block", "bucket", "kind", "payload"])


def normal(raw: bytes) -> bytes:
    return b" ".join(raw.lower().split()) + END


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int):
        if len(self.up) < n:
            size = 1 << int(np.ceil(np.log2(n)))
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            step = np.full(size, _BASE, np.uint64)
            step[0] = 1
            self.up = np.cumprod(step)
            step[1:] = inverse
            self.down = np.cumprod(step)
        return self.up[:n], self.down[:n]


_powers = _Powers()
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def stream(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of normal rows, each after DEPTH end bytes; the row's first place and its length."""
    pad = END * DEPTH
    buf = np.frombuffer(pad + pad.join(rows), np.uint8)
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return buf, np.cumsum(sizes + DEPTH) - sizes, sizes


def pair_keys(buf: np.ndarray) -> np.ndarray:
    """For each byte from DEPTH on: context (most recent byte highest), then the byte itself."""
    n = len(buf) - DEPTH
    keys = buf[DEPTH:].astype(np.uint64)
    for j in range(1, DEPTH + 1):
        keys |= buf[DEPTH - j : DEPTH - j + n].astype(np.uint64) << np.uint64(8 * (DEPTH + 1 - j))
    return keys


def word_hashes(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token (words, then the end) of all rows, and the row it belongs to."""
    up, down = _powers.get(len(buf) + 1)
    prefix = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTES[buf] * up[: len(buf)], out=prefix[1:])
    inside = np.zeros(len(buf) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + sizes, -1)
    inside = np.cumsum(inside[:-1]).astype(bool)
    close = np.flatnonzero(inside & ((buf == 32) | (buf == 10)))  # the byte after each word; the end byte closes the last
    row = np.searchsorted(starts, close, side="right") - 1
    open_ = np.empty_like(close)
    open_[1:] = close[:-1] + 1
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    open_[first] = starts[row[first]]
    some = close > open_  # an empty text has no word before its end byte
    h = mix((prefix[close[some]] - prefix[open_[some]]) * down[open_[some]] + (close[some] - open_[some]).astype(np.uint64))
    h[h == 0] = 1
    ends = np.zeros(len(sizes), np.uint64)  # the end token: hash 0
    return np.concatenate([h, ends]), np.concatenate([row[some], np.arange(len(sizes))])


def _chunks(rows: list[bytes]):
    at, size = 0, 0
    for k, r in enumerate(rows):
        if size and size + len(r) > _CHUNK:
            yield at, k
            at, size = k, 0
        size += len(r) + DEPTH
    if at < len(rows):
        yield at, len(rows)


class _Counter:
    """Distinct keys with counts, merged as they come."""

    def __init__(self):
        self.keys, self.counts, self.pending = [], [], 0

    def add(self, keys: np.ndarray, train: np.ndarray):
        for some, value in ((keys[train], 1), (keys[~train], 0)):
            if len(some):
                some = np.sort(some)
                start = np.flatnonzero(np.append(True, some[1:] != some[:-1]))
                self.keys.append(some[start])
                self.counts.append(np.diff(np.append(start, len(some))) * value)
                self.pending += len(start)
        if self.pending > 1_500_000 and len(self.keys) > 4:
            self.done()

    def done(self):
        k, c = summed(np.concatenate(self.keys), np.concatenate(self.counts)) if self.keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.keys, self.counts, self.pending = [k], [c], 0
        return k, c


def _blocks(batches, buckets: int):
    """A scan task's texts (kind 0), pairs (kind 1) and tokens (kind 2), the latter two by bucket."""
    block = TaskContext.get().partitionId()
    pairs, words = _Counter(), _Counter()
    ids, null, held, rows, size = [], [], [], [], 0

    def flush():
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        train = np.array(held) == 0
        buf, starts, sizes = stream(rows)
        keys = pair_keys(buf)
        row_of = np.repeat(np.arange(len(rows)), sizes)
        places = np.arange(len(row_of)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) - DEPTH
        pairs.add(keys[places], train[row_of])
        h, of = word_hashes(buf, starts, sizes)
        words.add(h, train[of])
        return _row(block, -1, 0, pack(np.array(ids, np.int64), np.array(null, np.uint8), np.array(held, np.uint8), lengths, np.frombuffer(b"".join(rows), np.uint8)))

    for batch in batches:
        for doc_id, raw in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
            r = normal(raw)
            if rows and size + len(r) > _CHUNK:
                yield flush()
                ids, null, held, rows, size = [], [], [], [], 0
            ids.append(doc_id or 0)
            null.append(doc_id is None)
            held.append(zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1)
            rows.append(r)
            size += len(r) + DEPTH
    if rows:
        yield flush()
    for kind, counter in ((1, pairs), (2, words)):
        keys, counts = counter.done()
        near = keys >> np.uint64(8 * (DEPTH + 1 - SPLIT)) if kind == 1 else keys
        of = (mix(near) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        ends = np.cumsum(np.bincount(of, minlength=buckets))
        for b in range(buckets):
            some = order[ends[b - 1] if b else 0 : ends[b]]
            if len(some):
                yield _row(block, b, kind, pack(keys[some], counts[some]))


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0, by Stirling's series after a shift by 8."""
    product = x.copy()
    for k in range(1, 8):
        product *= x + k
    y = x + 8
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - np.log(product)


_HALF = float(np.log(0.5))


def _kt_log(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - _lgamma(zeros + ones + 1.0) - float(np.log(np.pi))


def _weigh(zeros, ones, children):
    """(log weighted probability, weight of the node's own estimate) of inner nodes."""
    own, rest = _HALF + _kt_log(zeros, ones), _HALF + children
    whole = np.logaddexp(own, rest)
    return whole, np.exp(own - whole)


def _subtree(keys: np.ndarray, counts: np.ndarray):
    """For each of 8 bit places: nodes of depths DEPTH .. SPLIT, as (node of each deepest row, zeros, ones, weight), and the top depth's (decision key, zeros, ones, log weighted)."""
    levels, level_keys, level_counts = [], keys, counts
    to_level = np.arange(len(keys))
    maps = []  # deepest row -> row of the level
    for d in range(DEPTH, SPLIT - 1, -1):
        if d < DEPTH:
            # drop the oldest byte: it lies just above the coded byte
            coded = ((level_keys >> np.uint64(16)) << np.uint64(8)) | (level_keys & np.uint64(255))
            level_keys, inverse = np.unique(coded, return_inverse=True)
            level_counts = np.bincount(inverse, level_counts, len(level_keys))
            to_level = inverse[to_level]
        levels.append((level_keys, np.asarray(level_counts, np.float64)))
        maps.append(to_level)
    for k in range(8):
        below, bits = None, []
        for (lk, lc), to in zip(levels, maps):
            prefix = lk >> np.uint64(8 - k)
            start = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
            node = np.cumsum(np.append(False, prefix[1:] != prefix[:-1]))
            one = (lk >> np.uint64(7 - k)) & np.uint64(1)
            total, ones = np.add.reduceat(lc, start), np.add.reduceat(lc * one, start)
            zeros = total - ones
            mine = node[to]  # node of each deepest row
            if below is None:
                value, weight = _kt_log(zeros, ones), np.ones(len(start))
            else:
                child_of, child_value = below
                first = np.full(len(child_value), -1, np.int64)
                first[child_of] = mine  # every row of a child lies under the same parent
                value, weight = _weigh(zeros, ones, np.bincount(first, child_value, len(start)))
            below = (mine, value)
            bits.append((mine, zeros, ones, weight))
        lk = levels[-1][0]
        start = np.flatnonzero(np.append(True, (lk >> np.uint64(8 - k))[1:] != (lk >> np.uint64(8 - k))[:-1]))
        context, decision = lk[start] >> np.uint64(8), (np.uint64(1 << k) | ((lk[start] & np.uint64(255)) >> np.uint64(8 - k)))
        yield bits, (context << np.uint64(8)) | decision, zeros, ones, value


def _gathered(batches):
    """Per bucket of a partition sorted by bucket: pairs and words, each as [(block, keys, counts)]."""
    at, pairs, words = None, [], []
    for batch in batches:
        for block, bucket, kind, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "kind", "payload"))):
            if bucket != at and at is not None:
                yield pairs, words
                pairs, words = [], []
            at = bucket
            keys, counts = unpack(payload)
            (pairs if kind == 1 else words).append((block, keys, counts))
    if at is not None:
        yield pairs, words


def _tops(batches):
    """Sums of node values at depth SPLIT, by the depth above (kind 1); token totals (kind 2)."""
    for pairs, words in _gathered(batches):
        if pairs:
            keys, counts = summed(np.concatenate([p[1] for p in pairs]), np.concatenate([p[2] for p in pairs]))
            for _, node, zeros, ones, value in _subtree(keys, counts):
                up = ((node >> np.uint64(16)) << np.uint64(8)) | (node & np.uint64(255))
                u, inv = np.unique(up, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(u), np.int32)), pa.array(u.astype(np.int64)), *[pa.array(np.bincount(inv, x, len(u))) for x in (zeros, ones, value)]], names=["kind", "node", "zeros", "ones", "value"])
        if words:
            _, counts = summed(np.concatenate([w[1] for w in words]), np.concatenate([w[2] for w in words]))
            yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.array([0], pa.int64()), pa.array([float(counts.sum())]), pa.array([float((counts > 0).sum())]), pa.array([0.0])], names=["kind", "node", "zeros", "ones", "value"])


def _upper(node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, value: np.ndarray):
    """Depths SPLIT - 1 .. 0: for each the sorted node keys, share of ones by KT, own weight, and whether seen."""
    out = []
    for _ in range(SPLIT):
        order = np.argsort(node)
        node, zeros, ones, value = node[order], zeros[order], ones[order], value[order]
        whole, weight = _weigh(zeros, ones, value)
        out.append((node, (ones + 0.5) / (zeros + ones + 1), weight, zeros + ones > 0))
        up = ((node >> np.uint64(16)) << np.uint64(8)) | (node & np.uint64(255))
        node, inv = np.unique(up, return_inverse=True)
        zeros, ones, value = (np.bincount(inv, x, len(node)) for x in (zeros, ones, whole))
    return out


def _values(batches, shared):
    """Log10 probabilities of each block's pairs (kind 1) and base terms of its tokens (kind 2)."""
    upper, n, v = shared.value
    for pairs, words in _gathered(batches):
        yield from _bucket_values(pairs, words, upper, n, v)


def _bucket_values(pairs, words, upper, n: float, v: float):
    if pairs:
        keys, counts = summed(np.concatenate([p[1] for p in pairs]), np.concatenate([p[2] for p in pairs]))
        total = np.zeros(len(keys))
        for k, (bits, top_node, _, _, _) in enumerate(_subtree(keys, counts)):
            p, unseen = None, None
            for mine, zeros, ones, weight in bits:
                kt, w, seen = ((ones + 0.5) / (zeros + ones + 1))[mine], weight[mine], (zeros + ones > 0)[mine]
                if p is None:
                    p, unseen = kt, ~seen
                else:
                    p = np.where(unseen, kt, w * kt + (1 - w) * p)
                    unseen = unseen & ~seen
            node = top_node[bits[-1][0]]
            for at, kt, w, seen in upper:
                node = ((node >> np.uint64(16)) << np.uint64(8)) | (node & np.uint64(255))
                i = np.searchsorted(at, node)
                p = np.where(unseen, kt[i], w[i] * kt[i] + (1 - w[i]) * p)
                unseen = unseen & ~seen[i]
            bit = ((keys >> np.uint64(7 - k)) & np.uint64(1)).astype(bool)
            total += np.log10(np.where(bit, p, 1 - p))
        for block, mine, _ in pairs:
            yield _row(block, -1, 1, pack(mine, total[np.searchsorted(keys, mine)]))
    if words:
        keys, counts = summed(np.concatenate([w[1] for w in words]), np.concatenate([w[2] for w in words]))
        base = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
        for block, mine, _ in words:
            i = np.searchsorted(keys, mine)
            yield _row(block, -1, 2, pack(mine, base[i], (counts[i] > 0).astype(np.uint8)))


def _score(table: pa.Table, train_tokens: int) -> pa.Table:
    kinds, payloads = table.column("kind").to_pylist(), table.column("payload")
    got = {1: [], 2: []}
    for kind, payload in zip(kinds, payloads):
        if kind:
            got[kind].append(unpack(payload.as_py()))
    keys, logs = (np.concatenate([g[i] for g in got[1]]) for i in range(2))
    tokens, base, known = (np.concatenate([g[i] for g in got[2]]) for i in range(3))
    pair_at, word_at = Table(keys), Table(tokens)
    out = {c: [] for c in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes")}
    for kind, payload in zip(kinds, payloads):
        if kind:
            continue
        ids, null, held, lengths, flat = unpack(payload.as_py())
        ends = np.cumsum(lengths)
        flat = flat.tobytes()
        rows = [flat[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist())]
        buf, starts, sizes = stream(rows)
        all_keys = pair_keys(buf)
        row_of = np.repeat(np.arange(len(rows)), sizes)
        places = np.arange(len(row_of)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) - DEPTH
        score = np.bincount(row_of, logs[pair_at.find(all_keys[places])], len(rows))
        h, of = word_hashes(buf, starts, sizes)
        i = word_at.find(h)
        out["doc_id"] += [None if gone else d for d, gone in zip(ids.tolist(), null.tolist())]
        out["held_out"] += held.astype(bool).tolist()
        out["n_tokens"].append(np.bincount(of, minlength=len(rows)))
        out["n_known"].append(np.bincount(of, known[i], len(rows)).astype(np.int64))
        out["base_score"].append(np.bincount(of, base[i], len(rows)))
        out["score"].append(score)
        out["n_bytes"].append(sizes)
    join = lambda k: pa.array(np.concatenate(out[k]))
    n = len(out["doc_id"])
    return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "held_out": pa.array(out["held_out"]), "n_tokens": join("n_tokens"), "n_known": join("n_known"), "train_tokens": pa.array(np.full(n, train_tokens, np.int64)), "base_score": join("base_score"), "score": join("score"), "n_bytes": join("n_bytes")})


def score(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for every row."""
    spark = docs.sparkSession
    n = partitions(spark)
    slim = docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string").alias("text"))
    buckets = max(n, BUCKETS)
    blocks = written(slim.mapInArrow(lambda it: _blocks(it, buckets), _SCHEMA))
    dealt = blocks.where("kind > 0").repartition(n, "bucket").sortWithinPartitions("bucket")
    tops = dealt.mapInArrow(_tops, "kind int, node long, zeros double, ones double, value double").groupBy("kind", "node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("value").alias("value"))
    # at most 256^2 contexts of two bytes x 255 decisions
    top = tops.toArrow()
    kind = top.column("kind").to_numpy()
    some = [top.column(c).to_numpy()[kind == 1] for c in ("node", "zeros", "ones", "value")]
    upper = _upper(some[0].astype(np.uint64), *some[1:]) if len(some[0]) else []
    total = [float(top.column(c).to_numpy()[kind == 2].sum()) for c in ("zeros", "ones")]
    shared = spark.sparkContext.broadcast((upper, *total))
    values = dealt.mapInArrow(lambda it: _values(it, shared), _SCHEMA)
    train = int(total[0])
    scored = blocks.where("kind = 0").unionByName(values).groupBy("block").applyInArrow(lambda t: _score(t, train), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long")
    return scored.withColumn("bits_per_byte", -F.col("score") / F.lit(float(np.log10(2))) / F.col("n_bytes"))

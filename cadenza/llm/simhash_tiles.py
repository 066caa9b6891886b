"""SimHash near-duplicates by tiled exact comparison.

Fingerprints meet by pigeonhole: of the four 16-bit quarters of two fingerprints within 2 bits at least two
are equal, so each fingerprint goes to six groups, one for every pair of quarters and their values.  Inside a
group, fingerprints are tiled by their population counts and compared exactly, tile against tile, with numpy
exclusive-or and bit counts; tile pairs whose counts differ by more than the radius are skipped.  Neither loses
a link.  A group of over `block` fingerprints is cut into blocks that meet pairwise.  Equal fingerprints are
one class from the start; only a spanning forest of the links leaves a task.

Edge cases: null texts and texts without words have fingerprint zero and link like any other; a text of
fewer words than a shingle is one shingle; a very long text is hashed piece by piece; a null doc_id takes part
but never names a component (component null if it has no other member); repeated rows are returned as often as
given; extra columns of any name are ignored by the fingerprints and kept by `keep_one` (names starting with
`__` are reserved); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, joined, mix, named, partitions, ragged, small_batches, texts, written

BITS = 64
_CHUNK = 1 << 17


#: A byte's bits as eight bytes of 0 or 1, in one number.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def _ones(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(texts, BITS) numbers of hashes with the bit, of texts with sizes[i] hashes (1 or more) each."""
    # runs of 255 hashes at most are summed as numbers of eight counts, which then cannot overflow
    runs = -(-sizes // 255)
    within = ragged(np.zeros(len(runs), np.int64), runs)
    lanes = _LANES[hashes.view(np.uint8).reshape(-1, 8)]
    part = np.add.reduceat(lanes, np.repeat(np.cumsum(sizes) - sizes, runs) + 255 * within, axis=0)
    return np.add.reduceat(part.view(np.uint8).reshape(-1, BITS), np.cumsum(runs) - runs, axis=0, dtype=np.int32)


def _majority(parts: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """Per text the fingerprint of its shingle hashes; sizes: shingles of each text."""
    out = np.zeros(len(sizes), np.uint64)
    live = np.flatnonzero(sizes)
    if not len(live):
        return out
    over = 2 * _ones(np.concatenate(parts), sizes[live]) > sizes[live][:, None]
    out[live] = np.packbits(over, axis=1, bitorder="little").view(np.uint64).reshape(-1)
    return out


def _one(words: list[bytes], size: int, seed: int) -> np.uint64:
    """The fingerprint of a very long text, piece by piece."""
    ones, n = np.zeros(BITS, np.int64), len(words) - size + 1
    for at in range(0, n, _CHUNK):
        h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), seed) for i in range(at, min(n, at + _CHUNK))), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0]


def fingerprint_bytes(rows: list[bytes], size: int = 3, seed: int = 42) -> np.ndarray:
    """SimHash fingerprints of UTF-8 texts (A-Z lower-cased)."""
    out = np.zeros(len(rows), np.uint64)
    parts: list[np.ndarray] = []
    places: list[int] = []
    sizes: list[int] = []
    held = 0
    digest = xxhash.xxh64_intdigest

    def flush():
        nonlocal parts, places, sizes, held
        if places:
            out[places] = _majority(parts or [np.zeros(0, np.uint64)], np.array(sizes))
        parts, places, sizes, held = [], [], [], 0

    for k, raw in enumerate(rows):
        words = raw.lower().split()
        n = len(words)
        if n > _CHUNK:
            out[k] = _one(words, size, seed)
            continue
        if n == 0:
            continue
        joined = b" ".join(words)
        if n < size:
            h = np.array([digest(joined, seed)], np.uint64)
        else:
            lengths = np.fromiter(map(len, words), np.int64, n)
            start = np.cumsum(lengths + 1) - lengths - 1
            end = (start + lengths)[size - 1 :].tolist()
            h = np.fromiter([digest(joined[a:b], seed) for a, b in zip(start[: n - size + 1].tolist(), end)], np.uint64, n - size + 1)
        parts.append(h)
        places.append(k)
        sizes.append(len(h))
        held += len(h)
        if held > _CHUNK:
            flush()
    flush()
    return out


def _fingerprints(batches, size: int, seed: int):
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            fp = fingerprint_bytes(texts(part.column(1)), size, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp)], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, text: str = "text", size: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp long)."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(lambda it: _fingerprints(it, size, seed), "doc_id long, fp long")


def _near(i: np.ndarray, j: np.ndarray, words: list[np.ndarray], radius: int) -> np.ndarray:
    bits = np.zeros(len(i), np.int32)
    for w in words:
        bits += np.bitwise_count(w[i] ^ w[j])
    return bits <= radius


def _small_groups(size: np.ndarray, start: np.ndarray, words, count, radius: int):
    """Links inside groups of few rows, all groups at a time: each row with the d-th after it."""
    end = np.repeat(start + size, size)
    rows = ragged(start, size)
    d, us, vs = 1, [], []
    while len(rows):
        rows, end = rows[rows + d < end], end[rows + d < end]
        close = rows[count[rows + d] - count[rows] <= radius]
        found = close[_near(close, close + d, words, radius)]
        us.append(found)
        vs.append(found + d)
        d += 1
    return np.concatenate(us), np.concatenate(vs)


def _large_group(a: np.ndarray, b: np.ndarray | None, words, count, radius: int):
    """Links inside one group (b: none) or between its two sides, rows in order of population count: tile against the tiles within the radius."""
    us, vs = [], []
    other = a if b is None else b
    low, high = np.searchsorted(count[other], count[a] - radius), np.searchsorted(count[other], count[a] + radius, side="right")
    for s in range(0, len(a), 256):
        mine = a[s : s + 256]
        reach = other[low[s] : high[min(s + 255, len(a) - 1)]]
        if not len(reach):
            continue
        near = np.bitwise_count(words[0][mine, None] ^ words[0][None, reach]) <= radius
        i, j = np.nonzero(near)
        i, j = mine[i], reach[j]
        if b is None:
            i, j = i[i < j], j[i < j]
        if len(words) > 1:
            good = _near(i, j, words, radius)
            i, j = i[good], j[good]
        us.append(i)
        vs.append(j)
    none = np.zeros(0, np.int64)
    return (np.concatenate(us), np.concatenate(vs)) if us else (none, none)


def _compare(batches, radius: int, n_words: int):
    """Rows (key, lo, hi, side, count, id, fingerprint words), sorted by all but the id and words: links within the radius as forests."""
    held = None

    def links(cols):
        key, lo, hi, side, count, ids = cols[:6]
        words = [c.view(np.uint64) for c in cols[6:]]
        new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
        size = np.diff(np.append(new, len(key)))
        cut = (lo != hi)[new]
        few = (size > 1) & (size <= 48) & ~cut
        us, vs = [], []
        if few.any():
            i, j = _small_groups(size[few], new[few], words, count, radius)
            us.append(i)
            vs.append(j)
        for s, n, two in zip(new.tolist(), size.tolist(), cut.tolist()):
            if two or n > 48:
                rows = np.arange(s, s + n)
                i, j = _large_group(rows[side[rows] == 0], rows[side[rows] == 1], words, count, radius) if two else _large_group(rows, None, words, count, radius)
                if len(i) > 4096:
                    u, v = forest(ids[i], ids[j])
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                else:
                    us.append(i)
                    vs.append(j)
        i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
        if len(i):
            u, v = forest(ids[i], ids[j])
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(6 + n_words)]
        if held:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        key, lo, hi = cols[:3]
        same = (key == key[-1]) & (lo == lo[-1]) & (hi == hi[-1])
        last = len(key) - int(same.sum())  # the last group may go on in the next batch
        if last:
            yield from links([c[:last] for c in cols])
        held = [c[last:] for c in cols]
    if held:
        yield from links(held)


def _grouped_links(rows: DataFrame, radius: int, fps: list[str], block: int) -> DataFrame:
    """Links (u, v) between rows (key, id, fps) of one key whose fingerprints are within the radius; a forest of them per task."""
    spark = rows.sparkSession
    crowded = written(rows.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > block).select("key", F.ceil(F.col("c") / F.lit(block)).cast("int").alias("blocks")))
    n = crowded.count()
    if n:
        x = rows.join(F.broadcast(crowded) if n <= 200_000 else crowded, "key", "left").withColumn("part", F.expr("cast(pmod(xxhash64(id), coalesce(blocks, 1)) as int)"))
        x = x.withColumn("j", F.explode(F.expr("sequence(0, coalesce(blocks, 1) - 1)")))
        x = x.selectExpr("key", "least(part, j) as lo", "greatest(part, j) as hi", "if(part <= j, 0, 1) as side", "id", *fps)
    else:
        x = rows.selectExpr("key", "0 as lo", "0 as hi", "0 as side", "id", *fps)
    x = x.selectExpr("key", "lo", "hi", "side", "cast(" + " + ".join(f"bit_count({f})" for f in fps) + " as int) as count", "id", *fps)
    dealt = x.repartition(partitions(spark), "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "side", "count")
    n_words = len(fps)
    return dealt.mapInArrow(lambda it: _compare(it, radius, n_words), "u long, v long")


def near_links(classes: DataFrame, radius: int = 2, block: int = 4096) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints `fp` within `radius` bits (2 at most, for the pigeonhole of quarters)."""
    if not 0 <= radius <= 2:
        raise ValueError("four quarters find links of 2 bits at most")
    part = [F.expr(f"shiftrightunsigned(fp, {16 * i}) & 65535L") for i in range(4)]
    pairs = [(a, b) for a in range(4) for b in range(a)]
    keys = F.array(*[F.lit(k << 32).cast("long") + part[a] * 65_536 + part[b] for k, (a, b) in enumerate(pairs)])
    return _grouped_links(classes.select(F.explode(keys).alias("key"), F.col("fp").alias("id"), "fp"), radius, ["fp"], block)


def group(prints: DataFrame, radius: int = 2, block: int = 4096) -> DataFrame:
    """(doc_id, fp, component_id): the least doc_id reachable over links of at most `radius` differing bits."""
    prints = written(prints)
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    of = written(named(classes, components(near_links(classes, radius, block)), "fp").select("fp", "n", "component_id"))
    return joined(prints, of, ["fp"], "n", prints.count()).select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, radius: int = 2, text: str = "text", size: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row."""
    out = group(fingerprints(docs, text, size), radius)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---------------------------------------------------------------- similarity of 0.8 on five-word shingles

#: Fingerprint words of 64 bits, and bits that may differ in all of a candidate pair: at a Jaccard similarity of 0.8
#: 38.8 of 256 are expected, with a standard deviation of 5.7, so the bound only chooses what is compared exactly.
WIDE, WIDE_ALL = 4, 66
#: Candidates share the least values of ROWS hash functions in one of BANDS bands: at a similarity of 0.8 two texts
#: share a band with probability 0.9985, at 0.85 0.9999, at 0.5 0.66, at 0.3 0.11.
BANDS, ROWS = 16, 4
_MULTIPLIERS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_FPS = [f"f{i}" for i in range(WIDE)]
_WIDE_SCHEMA = "doc_id long, text_key long, id long, bands array<bigint>, " + ", ".join(f"{f} long" for f in _FPS)
#: Texts and bytes of shingle hashes of one block of exact comparison.
_MEMBERS, _BYTES = 512, 4 << 20


def _bands(parts: list[np.ndarray]) -> np.ndarray:
    """(texts, BANDS) keys out of the least values of each text's shingle hashes; all zero for a text without any."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    out = np.zeros((len(parts), BANDS), np.uint64)
    live = np.flatnonzero(sizes)
    if not len(live):
        return out
    hashes = np.concatenate([parts[k] for k in live])
    starts = np.cumsum(sizes[live]) - sizes[live]
    for band in range(BANDS):
        key = np.full(len(live), band + 1, np.uint64)
        for m in _MULTIPLIERS[band * ROWS : (band + 1) * ROWS]:
            key = mix(key + np.minimum.reduceat(hashes * m, starts))
        out[live, band] = key
    return out


def _wide_majority(parts: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    out, hashes = np.zeros((len(sizes), WIDE), np.uint64), np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    for w in range(WIDE):
        salt = np.uint64(w * 0x9E3779B97F4A7C15 & (2**64 - 1))
        if len(sizes) == 1 and len(hashes) > _CHUNK:  # one long text: bits are counted piece by piece
            ones = np.zeros(BITS, np.int64)
            for at in range(0, len(hashes), _CHUNK):
                ones += np.unpackbits(mix(hashes[at : at + _CHUNK] + salt).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[0, w] = np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0]
        else:
            out[:, w] = _majority([mix(hashes + salt)], sizes)
    return out


def shingles(raw: bytes, size: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles (A-Z lower-cased)."""
    words = raw.lower().split()
    n, joined, digest = len(words) - size + 1, b" ".join(words), xxhash.xxh64_intdigest
    if n < 1:
        return np.array([digest(joined)] if words else [], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(lengths + 1) - 1
    start = (end - lengths)[:n].tolist()
    return np.unique(np.fromiter(map(digest, [joined[a:b] for a, b in zip(start, end[size - 1 :].tolist())]), np.uint64, n))


def _set_id(hashes: np.ndarray) -> int:
    return int(np.array(xxhash.xxh64_intdigest(hashes.tobytes()), np.uint64).view(np.int64))


def _wide(batches, size: int):
    """Rows (doc_id, text_key, text) to fingerprints and bands of their shingle sets; id: hash of the set."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            out, bands, parts, ids, held = [], [], [], [], 0

            def settle():
                if parts:
                    out.append(_wide_majority(parts, np.array([len(h) for h in parts])))
                    bands.append(_bands(parts))
                    parts.clear()

            for raw in texts(part.column(2)):
                h = shingles(raw, size)
                if len(h) > _CHUNK:
                    settle()
                ids.append(_set_id(h))
                parts.append(h)
                held += len(h)
                if held > _CHUNK:
                    settle()
                    held = 0
            settle()
            f, b = np.concatenate(out).view(np.int64), np.concatenate(bands).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, b.size + 1, BANDS, dtype=np.int32)), pa.array(b.reshape(-1)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(ids, pa.int64()), lists, *[pa.array(f[:, i].copy()) for i in range(WIDE)]], names=["doc_id", "text_key", "id", "bands", *_FPS])


def _sets(batches, size: int):
    """Rows (root, id, text) to (root, id, n, hashes)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            got = [shingles(raw, size) for raw in texts(part.column(2))]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([len(h) for h in got], pa.int64()), pa.array([h.tobytes() for h in got], pa.binary())], names=["root", "id", "n", "hashes"])


def true_links(ids: np.ndarray, side: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the pairs of Jaccard similarity 0.8 or more connect.

    Pairs of one side and the other, or all pairs if there is one side only.  A pair that is connected
    already is not compared: it cannot change a component.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(sizes) - sizes
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(int(codes.max()) + 1 if len(codes) else 0, bool)
    label, all_pairs, us, vs = np.arange(len(ids)), len(np.unique(side)) == 1, [], []
    for i in range(len(ids)) if all_pairs else np.flatnonzero(side == side[0]).tolist():
        n = sizes[i]
        other = (label != label[i]) & (5 * np.minimum(sizes, n) >= 4 * np.maximum(sizes, n)) & (sizes > 0)
        if all_pairs:
            other[: i + 1] = False
        else:
            other &= side != side[i]
        js = np.flatnonzero(other)
        if not len(js):
            continue
        mine = codes[starts[i] : starts[i] + n]
        mark[mine] = True
        shared = np.add.reduceat(mark[codes[ragged(starts[js], sizes[js])]], np.cumsum(sizes[js]) - sizes[js], dtype=np.int64)
        mark[mine] = False
        # shared / (n + m - shared) >= 4 / 5
        js = js[9 * shared >= 4 * (n + sizes[js])]
        if len(js):
            us.append(np.repeat(ids[i], len(js)))
            vs.append(ids[js])
            label[np.isin(label, label[js])] = label[i]
    return forest(np.concatenate(us), np.concatenate(vs)) if us else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _members(table: pa.Table, side: str) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(ids, sides, shingle sets) of a group, each id once a side."""
    ids, sides = table.column("id").to_numpy(), table.column(side).to_numpy()
    order = np.lexsort((ids, sides))
    keep = order[np.append(True, (ids[order][1:] != ids[order][:-1]) | (sides[order][1:] != sides[order][:-1]))] if len(ids) else order
    hashes = table.column("hashes").combine_chunks()
    return ids[keep], sides[keep], [np.frombuffer(hashes[int(k)].as_py(), np.uint64) for k in keep]


def _pivot(table: pa.Table) -> pa.Table:
    """One block of a component against its pivot: links (kind 0) and the members without one (kind 1)."""
    ids, is_pivot, sets = _members(table, "is_pivot")
    at = int(np.flatnonzero(is_pivot)[0])
    pivot, root = sets[at], table.column("root")[0].as_py()
    near = np.zeros(len(ids), bool)
    for k, h in enumerate(sets):
        if 5 * min(len(h), len(pivot)) >= 4 * max(len(h), len(pivot)) > 0:
            shared = len(np.intersect1d(h, pivot, assume_unique=True))
            near[k] = 9 * shared >= 4 * (len(h) + len(pivot))
    near[at] = False
    far = ~near & ~is_pivot.astype(bool)
    kinds = np.repeat(np.array([0, 1], np.int32), [int(near.sum()), int(far.sum())])
    return pa.table({"kind": kinds, "root": np.full(len(kinds), root, np.int64), "u": np.concatenate([ids[near], ids[far]]), "v": np.full(len(kinds), ids[at], np.int64)})


def _true_pair(table: pa.Table) -> pa.Table:
    u, v = true_links(*_members(table, "side"))
    return pa.table({"u": u, "v": v})


def _verified(slim: DataFrame, prints: DataFrame, candidates: DataFrame, size: int) -> DataFrame:
    """Links (u, v) of Jaccard similarity 0.8 or more inside the components of `candidates`, compared exactly.

    A component's shingle sets, one of each id, are cut into blocks.  All are compared with one member, the
    pivot, first; in a group of near copies that connects most of them.  The members it leaves out then meet
    every block of the component, so no pair that could add to the links goes unseen, and no pair is a row.
    """
    spark = slim.sparkSession
    held = written(candidates.withColumnRenamed("component", "root"))
    wanted = prints.join(held, "id").groupBy("root", "id").agg(F.min("text_key").alias("text_key"))
    found = slim.select("text_key", "text").join(wanted, "text_key").select("root", "id", "text")
    sets = written(found.mapInArrow(lambda it: _sets(it, size), "root long, id long, n long, hashes binary").dropDuplicates(["root", "id"]))
    blocks = F.greatest(F.ceil(F.greatest(F.sum("n") * 8 / F.lit(_BYTES), F.count("*") / F.lit(_MEMBERS))), F.lit(1)).cast("int")
    cuts = written(sets.groupBy("root").agg(blocks.alias("parts"), F.min(F.struct(F.xxhash64("id", F.lit(3)).alias("h"), "id"))["id"].alias("pivot"), F.count("*").alias("m")))
    cut = joined(sets, cuts, ["root"], "m", sets.count()).withColumn("part", F.expr("cast(pmod(xxhash64(id, 7), parts) as int)"))
    first = cut.selectExpr("root", "id", "hashes", "if(id = pivot, 1, 0) as is_pivot", "explode(if(id = pivot, sequence(0, parts - 1), array(part))) as part")
    told = written(first.repartition(partitions(spark), "root", "part").groupBy("root", "part").applyInArrow(_pivot, "kind int, root long, u long, v long"))
    links, far = told.where("kind = 0").select("u", "v"), told.where("kind = 1").select("root", F.col("u").alias("id"))
    more = written(cut.join(far, ["root", "id"], "left_semi").select("root", "id", "n", "hashes", "parts"))
    mine = written(more.groupBy("root").agg(blocks.alias("ours"), F.first("parts").alias("parts"), F.count("*").alias("m")))
    if mine.isEmpty():
        return links
    ours = joined(more.drop("parts"), mine, ["root"], "m", more.count()).selectExpr("root", "id", "hashes", "cast(pmod(xxhash64(id, 11), ours) as int) as our", "explode(sequence(0, parts - 1)) as part", "0 as side")
    every = joined(cut.drop("parts"), mine.select("root", "ours").join(cuts.select("root", "m"), "root"), ["root"], "m", sets.count()).selectExpr("root", "id", "hashes", "explode(sequence(0, ours - 1)) as our", "part", "1 as side")
    pairs = ours.unionByName(every).repartition(partitions(spark), "root", "our", "part").groupBy("root", "our", "part").applyInArrow(_true_pair, "u long, v long")
    return links.unionByName(pairs)


def similar_groups(docs: DataFrame, text: str = "text", size: int = 5, block: int = 4096) -> DataFrame:
    """(doc_id, component_id) over links of Jaccard similarity 0.8 or more of the sets of `size`-word shingles.

    Sets that share the least values of a band of hash functions are compared by fingerprints of 256 bits, tile
    against tile as above; work and shuffle grow with the texts, not with their pairs.  Pairs within WIDE_ALL
    bits are candidates.  The components of the candidates are then compared exactly, and only what that
    confirms is a link.
    """
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    prints = written(slim.mapInArrow(lambda it: _wide(it, size), _WIDE_SCHEMA))
    classes = written(prints.groupBy("id").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), F.first("bands").alias("bands"), *[F.first(f).alias(f) for f in _FPS]))
    candidates = _grouped_links(classes.select(F.explode("bands").alias("key"), "id", *_FPS), WIDE_ALL, _FPS, block)
    links = _verified(slim, prints, components(candidates), size)
    of = written(named(classes.select("id", "least", "n"), components(links)).select("id", "n", "component_id"))
    return joined(prints.select("doc_id", "id"), of, ["id"], "n", prints.count()).select("doc_id", "component_id")


def keep_one(docs: DataFrame, text: str = "text", size: int = 5) -> DataFrame:
    """`docs` with the rows of one document of each group of near copies, that of the least doc_id (rows without a doc_id stay)."""
    stay = similar_groups(docs, text, size).where("doc_id = component_id or doc_id is null").select("doc_id").distinct().withColumnRenamed("doc_id", "__id")
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["__id"]), "left_semi")

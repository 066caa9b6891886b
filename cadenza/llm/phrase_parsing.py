"""Removal of repeated byte strings by prefix-free parsing.

Every text is parsed into phrases by triggers of a rolling hash.  The trigger of a window of LENGTH bytes is
its K-byte string with the least hash (leftmost of equals), so every window has one and equal windows have
the same one at the same place; neighbouring windows with one trigger are a phrase, and a phrase's text
reaches LENGTH - 1 bytes into the next.  The parse is the list of phrases with their places; the dictionary
holds each distinct phrase text once.

Sorting the parse by (trigger, phrase, document, place) gives each phrase's occurrences in corpus order: all
but the first are repeated as a whole.  Phrases are told apart by 112 bits of hash, 64 of their text and 48 of
their trigger.  Only first occurrences whose trigger heads several phrases of the dictionary can hold windows
that also occur in another phrase.  For those a suffix array of the dictionary is built, by prefix doubling of
ranks over the phrases' bytes up to LENGTH bytes, trigger by trigger, since equal windows have equal triggers.
Suffixes of equal rank by LENGTH bytes are equal as bytes; put in corpus order by their phrase's place in the
parse, all but the first are repeated.  A phrase reaches far enough that no suffix of LENGTH bytes runs over
its end, so the order among parse suffixes beyond the phrase is never needed.  A trigger with more than 2 * SPAN
bytes of phrases (one frequent passage, its neighbours ever different) is sorted piece by piece; the firsts of its
pieces, as far as their 64-bit hash is that of another, are then sorted together.

Edge cases: a null text is empty; a null doc_id sorts first; rows of one doc_id are told apart by their
text's hash, and rows equal in both are one document (each returned with the same result); texts shorter
than LENGTH lose nothing; very long texts are parsed in overlapping pieces; extra columns of any name are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, pack, partitions, ragged, texts, unpack, written

K = 32
#: Parts that triggers are dealt to, at least (a task holds one at a time), and bytes of dictionary that are sorted at a time.
BUCKETS, SPAN = 256, 1 << 20
#: Places that a task gathers before it deals them out, and payload rows and bytes of an Arrow batch.
LOT, _ROWS, _BYTES_OUT = 1 << 20, 256, 2 << 20
_PIECE = 2 << 20
_SCHEMA = "bucket int, kind int, payload binary"
_BASE = np.uint64(0x2545F4914F6CDD1D | 1)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))
_NULL = -(2**63)
_up = _down = np.ones(1, np.uint64)


def _powers(n: int):
    global _up, _down
    if len(_up) < n:
        size = 1 << int(np.ceil(np.log2(n)))
        step = np.full(size, _BASE, np.uint64)
        step[0] = 1
        _up = np.cumprod(step)
        step[1:] = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _down = np.cumprod(step)
    return _up[:n], _down[:n]


def _prefix(buf: np.ndarray):
    up, down = _powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTES[buf] * up[: len(buf)], out=out[1:])
    return out, down


def _batched(rows):
    """Rows (bucket, kind, payload) as Arrow batches of several: parts times blocks are many rows, and a batch costs more than a row."""
    names, held, size = ["bucket", "kind", "payload"], [], 0

    def batch():
        columns = zip(zip(*held), (pa.int32(), pa.int32(), pa.binary()))
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in columns], names=names)

    for row in rows:
        held.append(row)
        size += len(row[2])
        if len(held) >= _ROWS or size > _BYTES_OUT:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def pieces(rows: list[bytes], length: int):
    """Batches of (row, offset in the row, bytes): texts in pieces that overlap by length - 1 bytes."""
    held, size = [], 0
    for k, raw in enumerate(rows):
        for at in range(0, max(1, len(raw) - length + 1), _PIECE):
            part = raw[at : at + _PIECE + length - 1]
            if len(part) < length:
                continue
            if held and size + len(part) > 2 * _PIECE:
                yield held
                held, size = [], 0
            held.append((k, at, part))
            size += len(part)
    if held:
        yield held


def phrases(held, length: int):
    """Per phrase of these pieces: piece, place in it, windows, trigger hash, phrase hash."""
    buf = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
    sizes = np.fromiter((len(p) for _, _, p in held), np.int64, len(held))
    starts = np.cumsum(sizes) - sizes
    prefix, down = _prefix(buf)
    n = len(buf)
    grams = mix((prefix[K:] - prefix[: n - K + 1]) * down[: n - K + 1])
    low = np.uint64((1 << 24) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    span, have = length - K + 1, 1
    while have * 2 <= span:  # minima over windows of have grams
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < span:
        least = np.minimum(least[: len(least) - (span - have)], least[span - have :])
    trigger = (least & low).astype(np.int64)
    valid = ragged(starts, sizes - length + 1)  # window starts that stay inside their piece
    trigger = trigger[valid]
    first = np.flatnonzero(np.append(True, trigger[1:] != trigger[:-1]))
    at, count = valid[first], np.diff(np.append(first, len(valid)))
    end = at + count + length - 1
    text = mix(mix((prefix[end] - prefix[at]) * down[at]) + (count.astype(np.uint64) << np.uint64(32)) + (trigger[first] - at).astype(np.uint64))
    piece = np.searchsorted(starts, at, side="right") - 1
    return piece, at - starts[piece], count, grams[trigger[first]] & ~np.uint64(0xFFFF), text


def _keys(batch) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    rows = texts(batch.column(1))
    ids = np.array([_NULL if d is None else d for d in batch.column(0).to_pylist()], np.int64)
    return ids, rows, np.fromiter((xxhash.xxh64_intdigest(r) for r in rows), np.uint64, len(rows))


def _parse(batches, length: int, buckets: int):
    """The parse of a scan task, dealt by trigger (kind 0)."""
    got: list[tuple] = []

    def emit():
        ids, tag, at, count, trigger, text = (np.concatenate([g[i] for g in got]) for i in range(6))
        of = (mix(trigger) % np.uint64(buckets)).astype(np.int64)
        # equal phrases side by side, in scan order: they pack well
        order = np.argsort((of.astype(np.uint64) << np.uint64(40)) | (text >> np.uint64(24)), kind="stable")
        ends = np.cumsum(np.bincount(of, minlength=buckets))
        for b in range(buckets):
            some = order[ends[b - 1] if b else 0 : ends[b]]
            if len(some):
                yield b, 0, pack(trigger[some], text[some], ids[some], tag[some], at[some].astype(np.int64), count[some].astype(np.uint8))

    size = 0
    for batch in batches:
        for cut in range(0, batch.num_rows, 4096):
            ids, rows, tags = _keys(batch.slice(cut, 4096))
            for held in pieces(rows, length):
                piece, at, count, trigger, text = phrases(held, length)
                row = np.array([k for k, _, _ in held])[piece]
                got.append((ids[row], tags[row], at + np.array([o for _, o, _ in held], np.int64)[piece], count, trigger, text))
                size += len(at)
        if size > 4_000_000:
            yield from emit()
            got, size = [], 0
    if got:
        yield from emit()


def _deal(kind: int, ids, tags, at, count, blocks: int, *more):
    """Places, with more columns, to the blocks of their documents."""
    of = (mix(ids.view(np.uint64) ^ tags) % np.uint64(blocks)).astype(np.int64)
    order = np.lexsort((at, tags, ids, of))
    ends = np.cumsum(np.bincount(of, minlength=blocks))
    for b in range(blocks):
        some = order[ends[b - 1] if b else 0 : ends[b]]
        if len(some):
            yield b, kind, pack(ids[some], tags[some], at[some], count[some], *[x[some] for x in more])


class _Lot:
    """Places on their way to `_deal`, gathered up to LOT of them."""

    def __init__(self, kind: int, blocks: int):
        self.kind, self.blocks, self.held, self.size = kind, blocks, [], 0

    def add(self, *cols):
        if len(cols[0]):
            self.held.append(cols)
            self.size += len(cols[0])
        if self.size > LOT:
            yield from self.rest()

    def rest(self):
        if self.held:
            ids, tags, at, count, *more = (np.concatenate([h[k] for h in self.held]) for k in range(len(self.held[0])))
            self.held, self.size = [], 0
            yield from _deal(self.kind, ids, tags, at, count, self.blocks, *more)


def _buckets(batches):
    """The unpacked blobs of each bucket of a partition sorted by bucket."""
    at, blobs = None, []
    for batch in batches:
        for bucket, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload").to_pylist()):
            if bucket != at and blobs:
                yield blobs
                blobs = []
            at = bucket
            blobs.append(unpack(payload))
    if blobs:
        yield blobs


def _match(batches, blocks: int):
    """Phrases by trigger: repeated ones (kind 1), and firsts that need a look at their windows (kind 2)."""
    repeated, looked = _Lot(1, blocks), _Lot(2, blocks)
    for blobs in _buckets(batches):
        trigger, text, ids, tags, at, count = (np.concatenate([b[i] for b in blobs]) for i in range(6))
        del blobs
        order = np.lexsort((at, tags, ids, text, trigger))
        trigger, text, ids, tags, at, count = (x[order] for x in (trigger, text, ids, tags, at, count))
        same = (trigger[1:] == trigger[:-1]) & (text[1:] == text[:-1])
        twin = np.append(False, same & (ids[1:] == ids[:-1]) & (tags[1:] == tags[:-1]) & (at[1:] == at[:-1]))  # a row given twice
        first = np.append(True, ~same)
        later = ~first & ~twin
        run = np.cumsum(np.append(True, trigger[1:] != trigger[:-1])) - 1
        several = np.bincount(run, first)[run] > 1
        yield from repeated.add(ids[later], tags[later], at[later], count[later])
        look = first & several
        yield from looked.add(ids[look], tags[look], at[look], count[look], trigger[look])
    yield from repeated.rest()
    yield from looked.rest()


def _texts(batches, blocks: int):
    """The texts, packed by block (kind 0)."""
    for batch in batches:
        for cut in range(0, batch.num_rows, 8192):
            ids, rows, tags = _keys(batch.slice(cut, 8192))
            of = (mix(ids.view(np.uint64) ^ tags) % np.uint64(blocks)).astype(np.int64)
            for b in np.unique(of):
                some = np.flatnonzero(of == b)
                yield int(b), 0, pack(ids[some], tags[some], np.fromiter((len(rows[k]) for k in some), np.int64, len(some)), np.frombuffer(b"".join(rows[k] for k in some), np.uint8))


def _split(table: pa.Table):
    """A block's documents and its place lists by kind, sorted by document."""
    docs, marks = [], {}
    for kind, payload in zip(table.column("kind").to_pylist(), table.column("payload")):
        got = unpack(payload.as_py())
        if kind == 0:
            ids, tags, sizes, flat = got
            ends, flat = np.cumsum(sizes), flat.tobytes()
            docs += [(i, t, flat[e - n : e]) for i, t, e, n in zip(ids.tolist(), tags.tolist(), ends.tolist(), sizes.tolist())]
        else:
            marks.setdefault(kind, []).append(got)
    return docs, {k: [np.concatenate([g[i] for g in v]) for i in range(len(v[0]))] for k, v in marks.items()}


def _by_document(mark):
    """(id, tag) -> (places, counts, ...)."""
    ids, tags, at, count, *more = mark
    order = np.lexsort((at, tags, ids))
    ids, tags, at, count, *more = (x[order] for x in (ids, tags, at, count.astype(np.int64), *more))
    start = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1]))) if len(ids) else []
    return {(int(ids[s]), int(tags[s])): tuple(x[s:e] for x in (at, count, *more)) for s, e in zip(start, np.append(start[1:], len(ids)) if len(ids) else [])}


def _phrase_texts(table: pa.Table, length: int, buckets: int) -> pa.Table:
    """The dictionary's phrases of a block that need a look, with their bytes and places, by trigger (kind 3)."""
    docs, marks = _split(table)
    look = _by_document(marks[2]) if 2 in marks else {}
    got, flat, seen = [], [], set()
    for i, t, raw in docs:
        if (i, t) not in look or (i, t) in seen:
            continue
        seen.add((i, t))
        at, count, trigger = look[i, t]
        flat += [raw[a : a + n + length - 1] for a, n in zip(at.tolist(), count.tolist())]
        got.append((trigger, np.full(len(at), i, np.int64), np.full(len(at), t, np.uint64), at, count))
    rows = []
    if got:
        cols = [np.concatenate([g[k] for g in got]) for k in range(5)]
        of = (mix(cols[0]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        ends = np.cumsum(np.bincount(of, minlength=buckets))
        for b in range(buckets):
            some = order[ends[b - 1] if b else 0 : ends[b]]
            if len(some):
                rows.append((b, 3, pack(*[c[some] for c in cols], np.frombuffer(b"".join(flat[k] for k in some), np.uint8))))
    return pa.Table.from_batches(_batched(rows), schema=pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())]))


def _dense(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """The rank of each key among the distinct ones, and the highest rank."""
    order = np.argsort(keys)
    keys = keys[order]
    step = np.zeros(len(keys), np.uint32)
    np.not_equal(keys[1:], keys[:-1], out=step[1:], casting="unsafe")
    np.cumsum(step, out=step)
    ranks = np.empty(len(keys), np.uint32)
    ranks[order] = step
    return ranks, int(step[-1]) if len(step) else 0


def suffix_ranks(buf: np.ndarray, length: int, spots: np.ndarray) -> np.ndarray:
    """Numbers in the order of the `length` bytes at each of the `spots` of `buf` (equal for equal bytes), by ranks of prefixes from 8 bytes on (length 8 or more).

    A round puts as many ranks side by side as 64 bits hold, two at least; the last is worked out for `spots` only.
    """
    n, key = len(buf), np.zeros(len(buf), np.uint64)
    padded = np.append(buf, np.zeros(8, np.uint8))
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + n]
    have = 8
    while True:
        rank, top = _dense(key)
        bits = max(1, top.bit_length())
        times = min(64 // bits, -(-length // have))
        if times * have >= length:
            key = rank[spots].astype(np.uint64)
            for k in range(1, times):
                key = (key << np.uint64(bits)) | rank[spots + min(k * have, length - have)]
            return key
        rank = np.append(rank, np.zeros(have * times, np.uint32))
        key = rank[:n].astype(np.uint64)
        for k in range(1, times):
            key = (key << np.uint64(bits)) | rank[k * have : k * have + n]
        have *= times


def _repeats(buf, start, count, places, length: int):
    """The windows of phrases buf[start[k]:] of count[k] windows: phrase, offset in it, and which are not the first of their equals in the order of `places` (ids, tags, at)."""
    size = count + length - 1
    first = np.cumsum(size) - size
    spot, phrase = ragged(first, count), np.repeat(np.arange(len(count)), count)
    rank = suffix_ranks(buf[ragged(start, size)], length, spot)
    offset = spot - np.repeat(first, count)
    order = np.argsort(rank)
    same = rank[order[1:]] == rank[order[:-1]]
    some = order[np.append(False, same) | np.append(same, False)]  # a suffix whose rank is unique has no equal
    ids, tags, at = (x[phrase[some]] for x in places)
    some = some[np.lexsort((at + offset[some], tags, ids, rank[some]))]
    return phrase, offset, some[1:][rank[some[1:]] == rank[some[:-1]]]


def _twins(buf, start, count, offset, length: int):
    """Hashes of the windows at start + offset .. + count - 1, piece by piece, and the order by hash of those whose hash occurs again."""
    got = []
    for cut in np.split(np.arange(len(start)), np.flatnonzero(np.diff(np.cumsum(count + length - 1) // SPAN)) + 1):
        size = count[cut] + length - 1
        prefix, down = _prefix(buf[ragged(start[cut] + offset[cut], size)])
        spot = ragged(np.cumsum(size) - size, count[cut])
        got.append(mix((prefix[spot + length] - prefix[spot]) * down[spot]))
    hashes = np.concatenate(got)
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    return hashes, order[np.append(False, same) | np.append(same, False)]


def _later_windows(buf, start, count, places, length: int):
    """Of phrases with equal triggers only among themselves: (phrases, offsets) of the windows that are not the first of their equals."""
    upto = np.cumsum(count + length - 1)
    if not len(upto) or upto[-1] <= 2 * SPAN:
        phrase, offset, later = _repeats(buf, start, count, places, length)
        yield phrase[later], offset[later]
        return
    firsts: list[tuple] = []
    for cut in np.split(np.arange(len(start)), np.flatnonzero(np.diff(upto // SPAN)) + 1):
        phrase, offset, later = _repeats(buf, start[cut], count[cut], [x[cut] for x in places], length)
        yield cut[phrase[later]], offset[later]
        alone = np.ones(len(phrase), bool)
        alone[later] = False
        # runs of windows that are firsts of their piece, as phrases
        new = alone & np.append(True, ~alone[:-1] | (phrase[1:] != phrase[:-1]))
        runs = np.bincount(np.cumsum(new)[alone] - 1) if alone.any() else np.zeros(0, np.int64)
        firsts.append((cut[phrase[new]], offset[new], runs.astype(np.int64)))
    of, offset, n = (np.concatenate([f[k] for f in firsts]) for k in range(3))
    hashes, order = _twins(buf, start[of], n, offset, length)
    hashes, ends = hashes[order], np.cumsum(n)
    run = np.searchsorted(ends, order, side="right")
    of, offset = of[run], offset[run] + order - (ends - n)[run]
    # some SPAN bytes of windows at a time, those of one hash (one of a piece at most) together
    edges = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    cuts = edges[1:][np.diff(edges * length // SPAN) > 0]
    for part in np.split(np.arange(len(of)), cuts) if len(of) else []:
        mine, at = of[part], offset[part]
        ids, tags, base = (x[mine] for x in places)
        phrase, _, later = _repeats(buf, start[mine] + at, np.ones(len(mine), np.int64), (ids, tags, base + at), length)
        yield mine[phrase[later]], at[phrase[later]]


def _later(batches, blocks: int, length: int):
    """Windows of the dictionary in the order of its suffix array: all but the first of equals in the corpus (kind 1)."""
    repeated = _Lot(1, blocks)
    for blobs in _buckets(batches):
        trigger, ids, tags, at, count, buf = (np.concatenate([b[i] for b in blobs]) for i in range(6))
        del blobs
        size = count + length - 1
        start = np.cumsum(size) - size
        # whole triggers at a time, of some SPAN bytes; a trigger's phrases are distinct, so it grows with the dictionary only
        order = np.argsort(trigger, kind="stable")
        run = np.cumsum(np.append(True, trigger[order][1:] != trigger[order][:-1])) - 1
        part = (np.cumsum(np.bincount(run, size[order])) // SPAN).astype(np.int64)[run]
        for cut in np.split(order, np.flatnonzero(part[1:] != part[:-1]) + 1):
            for phrase, offset in _later_windows(buf, start[cut], count[cut], (ids[cut], tags[cut], at[cut]), length):
                mine = cut[phrase]
                yield from repeated.add(ids[mine], tags[mine], at[mine] + offset, np.ones(len(mine), np.uint8))
    yield from repeated.rest()


def _remove(table: pa.Table, length: int, keep_text: bool) -> pa.Table:
    docs, marks = _split(table)
    gone = _by_document(marks[1]) if 1 in marks else {}
    out = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
    for i, t, raw in docs:
        removed = spans = 0
        kept = raw
        if (i, t) in gone:
            at, count = gone[i, t][:2]
            end = np.maximum.accumulate(at + count + length - 1)
            new = np.append(True, at[1:] > end[:-1])
            s, e = at[new], np.append(end[:-1][new[1:]], end[-1])
            removed, spans = int((e - s).sum()), len(s)
            view, last, parts = memoryview(raw), 0, []
            for a, b in zip(s.tolist(), e.tolist()):
                parts.append(view[last:a])
                last = b
            parts.append(view[last:])
            kept = b"".join(parts)
        out["doc_id"].append(None if i == _NULL else i)
        out["n_bytes"].append(len(raw))
        out["n_removed"].append(removed)
        out["n_spans"].append(spans)
        out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        out["kept"].append(kept if keep_text else None)
    cols = {k: pa.array(out[k], pa.int64()) for k in ("doc_id", "n_bytes", "n_removed", "n_spans")} | {"kept_sha256": pa.array(out["kept_sha256"], pa.string())}
    return pa.table(cols | ({"kept": pa.array(out["kept"], pa.binary())} if keep_text else {}))


def dedup(docs: DataFrame, length: int = 100, text: str = "text", keep_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept binary]) for every row of `docs`."""
    if length < 2 * K or length - K + 1 > 255:
        raise ValueError(f"length must be {2 * K} to {K + 254}")
    n = partitions(docs.sparkSession)
    buckets = max(n, BUCKETS)
    slim = docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string").alias("text"))
    parse = slim.mapInArrow(lambda it: _batched(_parse(it, length, buckets)), _SCHEMA)
    matched = written(parse.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _batched(_match(it, n)), _SCHEMA))
    packed = slim.mapInArrow(lambda it: _batched(_texts(it, n)), _SCHEMA)
    looked = packed.unionByName(matched.where("kind = 2")).groupBy("bucket").applyInArrow(lambda t: _phrase_texts(t, length, buckets), _SCHEMA)
    later = looked.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _batched(_later(it, n, length)), _SCHEMA)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_text else "")
    return packed.unionByName(matched.where("kind = 1")).unionByName(later).groupBy("bucket").applyInArrow(lambda t: _remove(t, length, keep_text), schema)

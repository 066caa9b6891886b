"""Byte-level BPE encoding and decoding over the distinct pre-tokens of a corpus.

Each scan task makes blocks of about SPAN bytes of whole texts.  A block cuts its texts into pre-tokens and keeps, per text, the sequence of places in
the block's own list of distinct words, so positions travel as packed arrays and not as rows.  The blocks'
words meet by hash, each distinct word is encoded once, and the ids go back to the blocks that hold it;
there they are reassembled by position.  Decoding looks every id up in the table of token bytes (its size is
the vocabulary's), which is broadcast.

Edge cases: null and empty texts have no tokens; a null doc_id is kept as null; repeated rows are encoded
row by row; a very long text is a block of its own and decoded piece by piece; lone surrogates cannot occur (Spark strings are UTF-8; invalid bytes are replaced as in
Python's "replace"); extra columns of any name are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pack, partitions, ragged, small_batches, steady, unpack, written

#: Characters of texts that one payload row holds (a longer text has a row of its own).
PAYLOAD = 4 << 20
#: Bytes of texts after which a scan task starts its next block; bounds what a block holds, however large the task.
SPAN = 32 << 20
#: Parts that distinct words are dealt to, at least; a task encodes one part at a time.
BUCKETS = 256
#: Pieces held at a time, beside the block's distinct words.
_HELD = 1 << 17
_SCHEMA = "block long, bucket int, kind int, payload binary"
#: White space beside a space or at an end of a text.
_BESIDE = regex.compile(r"\s |^\s| \s|\s$|[\x1c-\x1f] |^[\x1c-\x1f]| [\x1c-\x1f]|[\x1c-\x1f]$")
_encoders: dict[str, tiktoken.Encoding] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes and its id, line by line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _encoder(ranks: dict[bytes, int], pattern: str) -> tiktoken.Encoding:
    key = f"{len(ranks)}:{hash(frozenset(ranks.items()))}:{pattern}"
    if key not in _encoders:
        _encoders[key] = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def _row(block: int, bucket: int, kind: int, payload: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), pa.array([payload], pa.binary())], names=["block", "bucket", "kind", "payload"])


def _lists(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(items), np.uint8), np.fromiter(map(len, items), np.int64, len(items))


class _Pieces(dict):
    """Piece of a text between single spaces -> places of its pre-tokens; None if the piece has outer white space.

    No pre-token crosses a single space between two other characters: the space opens the next one.  So such
    pieces can be cut one by one, and each distinct piece only once.  The key is the piece without its space;
    a text's first piece, which has none, is keyed as a tuple.
    """

    def __init__(self, find):
        super().__init__()
        self.find, self.place = find, {}

    def __missing__(self, key):
        place = self.place
        body, opening = (key[0], "") if type(key) is tuple else (key, " ")
        word = body.rstrip(".,;:!?")
        if word and word.isalpha() and max(word) < "\u0250":  # letters, then perhaps marks
            first = place.setdefault(opening + word, len(place))
            got = (first, place.setdefault(body[len(word) :], len(place))) if len(word) < len(body) else (first,)
        elif not body or body[0].isspace() or body[-1].isspace():
            got = None
        else:
            got = tuple([place.setdefault(w, len(place)) for w in self.find(opening + body)])
        self[key] = got
        return got

    def cut(self, text: str) -> list:
        out = text.split(" ")
        out[0] = (out[0],)
        return out

    def places(self, text: str) -> np.ndarray:
        """The places of a text's pre-tokens, in order."""
        found = list(map(self.__getitem__, self.cut(text)))
        if None in found:  # runs of white space: cut the text as a whole
            place = self.place
            return np.array([place.setdefault(w, len(place)) for w in self.find(text)], np.int32)
        return np.array(list(chain.from_iterable(found)), np.int32)


def _sorted_words(place: dict[str, int]) -> tuple[list[bytes], np.ndarray]:
    """A block's words in order of their bytes; for each place in order of appearance its rank there.  Empties `place`."""
    raw = [w.encode() for w in place]
    place.clear()
    order = sorted(range(len(raw)), key=raw.__getitem__)
    rank = np.empty(len(raw), np.int32)
    rank[order] = np.arange(len(raw), dtype=np.int32)
    return [raw[k] for k in order], rank


def _rows(batches, span: int):
    """(block, (doc_id, text bytes)): a block ends with the row that takes it over `span` bytes, so every scan cuts alike."""
    block, held = TaskContext.get().partitionId() << 20, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            for row in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                yield block, row
                held += len(row[1] or b"")
                if held > span:
                    block, held = block + 1, 0


def _blocks(batches, span: int):
    """(block, iterator of its rows), one block after the other."""
    for block, group in groupby(_rows(batches, span), key=itemgetter(0)):
        yield block, (row for _, row in group)


def _by_bucket(block: int, raw: list[bytes], buckets: int):
    """A block's words and their ranks, by hash (kind 1)."""
    of = np.fromiter(map(xxhash.xxh64_intdigest, raw), np.uint64, len(raw)) % np.uint64(buckets)
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.append(True, of[order][1:] != of[order][:-1])) if len(raw) else []
    for s, e in zip(cuts, np.append(cuts[1:], len(order)) if len(raw) else []):
        some = order[s:e]
        yield _row(block, int(of[some[0]]), 1, pack(some.astype(np.int32), *_lists([raw[k] for k in some])))


def _parse(batches, pattern: str, span: int = SPAN, buckets: int = 0):
    """Blocks of a scan: payloads of word places (kind 0), and the rank of each place (kind 3); with `buckets` also what `_words` gives (kind 1)."""
    find = regex.compile(pattern).findall
    for block, rows in _blocks(batches, span):
        pieces = _Pieces(find)
        ids, null, sizes, lengths, held, chars = [], [], [], [], [], 0

        def flush():
            seq = np.concatenate(held) if held else np.zeros(0, np.int32)
            return _row(block, -1, 0, pack(np.array(ids, np.int64), np.array(null, np.uint8), np.array(sizes, np.int64), np.array(lengths, np.int64), seq))

        for doc_id, text in rows:
            text = (text or b"").decode("utf-8", "replace")
            seq = pieces.places(text) if text else np.zeros(0, np.int32)
            lengths.append(len(text.encode()))
            if len(pieces) > _HELD:
                pieces.clear()
            ids.append(doc_id or 0)
            null.append(doc_id is None)
            sizes.append(len(seq))
            held.append(seq)
            chars += len(text)
            if chars > PAYLOAD:
                yield flush()
                ids, null, sizes, lengths, held, chars = [], [], [], [], [], 0
        if ids:
            yield flush()
        pieces.clear()
        raw, rank = _sorted_words(pieces.place)
        yield _row(block, -1, 3, pack(rank))
        if buckets:
            yield from _by_bucket(block, raw, buckets)


def _words(batches, pattern: str, buckets: int, span: int = SPAN):
    """Blocks of a scan: the distinct words and their ranks, by hash (kind 1)."""
    find = regex.compile(pattern).findall
    for block, rows in _blocks(batches, span):
        pieces, seen = _Pieces(find), set()

        def settle():
            for key in seen:
                pieces[key]
            seen.clear()
            pieces.clear()

        for _, text in rows:
            if text:
                text = text.decode("utf-8", "replace")
                cut = pieces.cut(text)
                # outer white space of a piece: "  ", or white space beside a space, or at an end of the text
                if "" in cut or cut[0] == ("",) or _BESIDE.search(text):
                    for w in pieces.find(text):
                        pieces.place.setdefault(w, len(pieces.place))
                else:
                    seen.update(cut)
                    if len(seen) > _HELD:
                        settle()
        settle()
        yield from _by_bucket(block, _sorted_words(pieces.place)[0], buckets)


def _encode(batches, ranks, pattern: str):
    """Each distinct word of this partition's buckets once; its ids to every block that holds it (kind 2)."""
    single = _encoder(ranks.value, pattern)._core_bpe.encode_single_piece
    known: dict[bytes, list[int]] = {}
    at_bucket = None
    for batch in batches:
        for block, bucket, payload in zip(batch.column("block").to_pylist(), batch.column("bucket").to_pylist(), batch.column("payload").to_pylist()):
            if bucket != at_bucket:  # sorted by bucket: what one needs is forgotten before the next
                at_bucket, known = bucket, {}
            some, raw, sizes = unpack(payload)
            raw, out, at = raw.tobytes(), [], 0
            for n in sizes.tolist():
                w = raw[at : at + n]
                at += n
                if (got := known.get(w)) is None:
                    token = ranks.value.get(w)
                    got = known[w] = [token] if token is not None else single(w)
                out.append(got)
            yield _row(block, -1, 2, pack(some, np.fromiter(map(len, out), np.int32, len(out)), np.fromiter((t for x in out for t in x), np.uint32)))


def _assemble(table: pa.Table, ranks, ids_too: bool) -> pa.Table:
    """One block: ids of its texts by position, digests of the ids and of the decoded bytes."""
    kinds, payloads = table.column("kind").to_pylist(), table.column("payload")
    places, counts, flat = [], [], []
    for kind, payload in zip(kinds, payloads):
        if kind == 2:
            a, b, c = unpack(payload.as_py())
            places.append(a)
            counts.append(b)
            flat.append(c)
    n_words = sum(map(len, places))
    size, start, tokens = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64), np.concatenate(flat) if flat else np.zeros(0, np.uint32)
    if places:
        size[np.concatenate(places)] = np.concatenate(counts)
        ends = np.cumsum(np.concatenate(counts).astype(np.int64))
        start[np.concatenate(places)] = ends - np.concatenate(counts)
    rank = next((unpack(p.as_py())[0] for k, p in zip(kinds, payloads) if k == 3), np.zeros(0, np.int32))
    vocabulary = max(ranks.value.values()) + 1
    pieces = [b""] * vocabulary
    for piece, token in ranks.value.items():
        pieces[token] = piece
    piece_bytes, piece_size = _lists(pieces)
    piece_start = np.cumsum(piece_size) - piece_size
    out = {k: [] for k in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "ids")}
    for kind, payload in zip(kinds, payloads):
        if kind != 0:
            continue
        docs, null, sizes, lengths, seq = unpack(payload.as_py())
        at = 0
        for doc_id, gone, n, n_bytes in zip(docs.tolist(), null.tolist(), sizes.tolist(), lengths.tolist()):
            mine = seq[at : at + n]
            at += n
            ids_hash, text_hash, total, length, all_ids = hashlib.sha256(), hashlib.sha256(), 0, 0, []
            for cut in range(0, n, 1 << 16):
                w = rank[mine[cut : cut + (1 << 16)]]
                ids = tokens[ragged(start[w], size[w])]
                ids_hash.update(ids.astype("<u4").tobytes())
                decoded = piece_bytes[ragged(piece_start[ids], piece_size[ids])]
                text_hash.update(decoded.tobytes())
                total += len(ids)
                length += len(decoded)
                if ids_too:
                    all_ids.append(ids.astype(np.int32))
            if length != n_bytes:  # a scan that deals its rows anew would lose words
                raise ValueError(f"a text of {n_bytes} bytes came back as {length}")
            out["doc_id"].append(None if gone else doc_id)
            out["n_tokens"].append(total)
            out["ids_sha256"].append(ids_hash.hexdigest())
            out["decoded_sha256"].append(text_hash.hexdigest())
            out["n_bytes"].append(length)
            out["ids"].append(np.concatenate(all_ids) if all_ids else np.zeros(0, np.int32))
    cols = [pa.array(out["doc_id"], pa.int64()), pa.array(out["n_tokens"], pa.int64()), pa.array(out["ids_sha256"], pa.string()), pa.array(out["decoded_sha256"], pa.string()), pa.array(out["n_bytes"], pa.int64())]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"]
    if ids_too:
        cols, names = cols + [pa.array(out["ids"], pa.list_(pa.int32()))], names + ["ids"]
    return pa.Table.from_arrays(cols, names=names)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: bool = False, span: int = SPAN, once: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes[, ids array<int>]) for every row of `docs`.

    once: the texts are cut in one scan, whose parse is written to the shared folder; otherwise two scans cut them,
    one for places and one for words, which takes more time and less disk.
    pattern: one of the GPT family, in which a single space between two other characters opens the next pre-token.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(ranks)
    slim = docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string").alias("text"))
    n = partitions(spark)
    buckets = max(n, BUCKETS)
    if once:
        made = written(slim.mapInArrow(lambda it: _parse(it, pattern, span, buckets), _SCHEMA))
        parsed, words = made.where("kind <> 1"), made.where("kind = 1")
    else:
        slim = steady(slim)
        parsed = slim.mapInArrow(lambda it: _parse(it, pattern, span), _SCHEMA)
        words = slim.mapInArrow(lambda it: _words(it, pattern, buckets, span), _SCHEMA)
    encoded = words.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _encode(it, shared, pattern), _SCHEMA)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long" + (", ids array<int>" if ids else "")
    return parsed.unionByName(encoded).groupBy("block").applyInArrow(lambda t: _assemble(t, shared, ids), schema)


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, decoded binary) from (doc_id, ids): every id joins the token-byte table."""
    shared = encoded.sparkSession.sparkContext.broadcast({v: k for k, v in ranks.items()})

    def run(batches):
        for batch in batches:
            rows = [None if x is None else b"".join(shared.value[i] for i in x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, decoded binary")

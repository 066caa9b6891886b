"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's score is a logistic function of its words; a document's
score is the noisy-or of its sentences, 1 - prod(1 - s).  The weights are trained on document labels only,
through the noisy-or, and then point at the sentences that carry the label.  A sentence's bias falls by a
learned multiple, 1 at least, of the log of its document's number of sentences, so that no text is toxic by
its length alone.

The fit takes at most `max_docs` labelled documents, in the order of a hash of doc_id, up to the one whose
text reaches `max_bytes` in all (a documented bound); texts of any length are learned from, and whole.  Words that stand out in labelled documents (at most `MAX_WORDS`, so the
broadcast model has a fixed bound) get weights; scoring covers every sentence of every text.  Only the text
is an input.

Edge cases: a very long text is scored whole; null and empty texts have one empty sentence and so a score; a null doc_id is scored and not
held out; labels that are null, or whose document is missing, are not learned from; repeated rows are
scored row by row; extra columns of any name are ignored; without labels of both kinds every score is below 0.5.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import texts

MAX_WORDS = 2048
_SENTENCE = re.compile(rb"(?:[.!?]+[\x20\x09-\x0D]+|\n+)")
_STRIP = b".,;:!?\"'()[]{}|#*$%&<>-"
#: Word weights, sentence bias, multiple of the log of the number of sentences, cut.
Model = tuple[dict[bytes, float], float, float, float]


def sentences(raw: bytes) -> list[bytes]:
    """Cut after marks that end a sentence, and at line ends."""
    return [s for s in _SENTENCE.split(raw.lower()) if s.strip()] or [b""]


class _Weights(dict):
    """Weight of a raw word; forgets when it has grown to its bound."""

    def __init__(self, weights: dict[bytes, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) > 400_000:
            self.clear()
        known = self.weights
        got = self[word] = sum(known.get(x, 0.0) for x in traits(word.strip(_STRIP)))
        return got


def traits(word: bytes) -> tuple[bytes, ...]:
    """What a word shows: itself, and its first four characters."""
    start = word.decode("utf-8", "replace")
    return (word, b"^" + start[:4].encode()) if len(start) > 4 else (word,)


def noisy_or(logits: np.ndarray, row_of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: the score, and the log of 1 - score."""
    none = np.bincount(row_of, -np.logaddexp(0.0, logits), n)
    return -np.expm1(none), none


def _logit(p: np.ndarray, none: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(p, 1e-300)) - none


def fit(rows: list[bytes], labels: np.ndarray, rounds: int = 200, rate: float = 0.1, decay: float = 2e-3) -> Model:
    """Word weights, sentence bias and its fall with length, and the logit at which predicting 1 is best, by Adam on the noisy-or likelihood."""
    y = labels.astype(np.float64)
    if not len(rows) or y.min() == y.max():
        return {}, -6.0, 1.0, 0.0
    bags = [[{x for w in s.split() for x in traits(w.strip(_STRIP))} for s in sentences(r)] for r in rows]
    shown: dict[bytes, tuple[list[int], list[int]]] = {}
    for r, (bag, label) in enumerate(zip(bags, labels.tolist())):
        for w in {w for s in bag for w in s}:
            shown.setdefault(w, ([], []))[label].append(r)
    share = y.mean()
    likely = {}
    for w, (n0, n1) in shown.items():
        n = len(n0) + len(n1)
        if w and len(n1) >= 3 and len(n1) - n * share > 3.5 * np.sqrt(n * share * (1 - share)):
            likely[w] = (len(n0), set(n1))
    # greedy cover: a word must stand out among the documents that no chosen word explains yet
    chosen: dict[bytes, int] = {}
    while likely and len(chosen) < MAX_WORDS:
        z, w = max((((k := len(d)) - (n0 + k) * share) / np.sqrt((n0 + k) * share * (1 - share)) if d else -1.0, w) for w, (n0, d) in likely.items())
        if z < 3.5:
            break
        chosen[w] = len(chosen)
        covered = set(shown[w][1])
        n0 = likely.pop(w)[0]
        if n0 * 4 <= len(covered):
            likely = {x: (m, left) for x, (m, d) in likely.items() if len(left := d - covered) >= 3}
    del shown, likely
    ids, sentence_of, row_of, count = [], [], [], 0
    for r, bag in enumerate(bags):
        for s in bag:
            for w in s:
                if (k := chosen.get(w)) is not None:
                    ids.append(k)
                    sentence_of.append(count)
            row_of.append(r)
            count += 1
    ids, sentence_of, row_of = np.array(ids, np.int64), np.array(sentence_of, np.int64), np.array(row_of, np.int64)
    bias, mb, vb = -6.0, 0.0, 0.0
    # from zero, a word in one sentence of many would get too little of its document's gradient to outweigh the decay
    w, m, v = np.full(len(chosen), -bias), np.zeros(len(chosen)), np.zeros(len(chosen))
    slope, ms, vs = 1.0, 0.0, 0.0
    length = np.log(np.bincount(row_of, minlength=len(rows)))[row_of]
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    for step in range(1, rounds + 1):
        z = bias - slope * length + np.bincount(sentence_of, w[ids], count)
        p, none = noisy_or(z, row_of, len(rows))
        g = weight * np.where(y == 1, -np.exp(none) / np.maximum(p, 1e-9), 1.0)
        gz = g[row_of] / (1.0 + np.exp(-np.clip(z, -50, 50)))
        gw = np.bincount(ids, gz[sentence_of], len(chosen)) + decay * np.sign(w)
        gb, gs = gz.sum(), -(gz * length).sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        ms, vs = 0.9 * ms + 0.1 * gs, 0.999 * vs + 0.001 * gs * gs
        scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w -= scale * m / (np.sqrt(v) + 1e-9)
        bias -= scale * mb / (np.sqrt(vb) + 1e-9)
        slope = max(1.0, slope - scale * ms / (np.sqrt(vs) + 1e-9))
    p, none = noisy_or(bias - slope * length + np.bincount(sentence_of, w[ids], count), row_of, len(rows))
    logit = _logit(p, none)
    order = np.argsort(-logit, kind="stable")
    hit, said = np.cumsum(y[order]), np.arange(1, len(y) + 1)
    ends = np.append(logit[order][1:] < logit[order][:-1], True)  # equal scores are cut together
    best = int(np.argmax(np.where(ends, 2 * hit / (said + y.sum()), -1)))
    cut = (logit[order[best]] + logit[order[min(best + 1, len(order) - 1)]]) / 2
    return {word: float(w[k]) for word, k in chosen.items()}, float(bias), float(slope), float(cut)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", max_docs: int = 8_000, max_bytes: int = 8 << 20) -> Model:
    """Fit on labelled rows whose crc32(doc_id) mod 5 is not 0, within the bound."""
    lab = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = lab.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    rows = chosen.join(docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(text), F.lit("")).alias("text")), "doc_id")
    # the text that reaches max_bytes is the last one taken, so a long text neither drops out nor empties the fit
    rows = rows.withColumn("n", F.octet_length("text"))
    chosen = rows.select("text", "toxic", "n", F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "text")).alias("upto")).where(F.col("upto") - F.col("n") < max_bytes)
    got = chosen.select("text", "toxic").toArrow()
    return fit(texts(got.column("text")), got.column("toxic").to_numpy())


def score(docs: DataFrame, model: Model, text: str = "text", locate: bool = False) -> DataFrame:
    """(doc_id, held_out, score, predicted, top_sentence, n_flagged[, flagged array<struct<start,length,score>>])."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def squash(x):
        return 1 / (1 + np.exp(-np.clip(x, -50, 50)))

    def run(batches):
        words, bias, slope, cut = shared.value
        weight_of = _Weights(words).__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = texts(part.column(1))
                cutup = [sentences(r) for r in rows]
                sizes = np.fromiter(map(len, cutup), np.int64, len(rows))
                z = np.array([sum(map(weight_of, s.split())) for c in cutup for s in c]) + np.repeat(bias - slope * np.log(sizes), sizes)
                row_of, starts = np.repeat(np.arange(len(rows)), sizes), np.cumsum(sizes) - sizes
                p, none = noisy_or(z, row_of, len(rows))
                s = squash(_logit(p, none) - cut)
                top, flagged = np.maximum.reduceat(z, starts) - cut, np.add.reduceat((z > cut).astype(np.int64), starts)
                cols = [part.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array(squash(top)), pa.array(flagged)]
                names = ["doc_id", "score", "predicted", "top_sentence", "n_flagged"]
                if locate:
                    found = []
                    for k, raw in enumerate(rows):
                        here, spot, low = [], 0, raw.lower()
                        for j, sent in enumerate(cutup[k]):
                            spot = low.find(sent, spot)
                            if z[starts[k] + j] > cut:
                                here.append({"start": spot, "length": len(sent), "score": float(squash(z[starts[k] + j] - cut))})
                            spot += len(sent)
                        found.append(here)
                    cols.append(pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64())]))))
                    names.append("flagged")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, score double, predicted int, top_sentence double, n_flagged long" + (", flagged array<struct<start:int,length:int,score:double>>" if locate else "")
    slim = docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string").alias("text"))
    out = slim.mapInArrow(run, schema)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), *out.columns[1:])

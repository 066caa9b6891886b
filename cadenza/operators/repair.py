"""Sentence repair: missing and spurious boundaries, cutting and sharing a cue's time."""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cues import inner_silence, wrapped

# Capitals and lower-case letters of sentence starts.
_CAP, _LOW = "A-ZÀ-ÂÄ-ÏÑ-ÖÙ-Ý", "a-zà-ÿ"
_OPENING = re.compile(rf"(?<![.!?:;… \t])[ \t]+([{_CAP}][{_LOW}'’]+)")
_NUMERAL = re.compile(r"[IVXLC]+(?:er|re|e|ème)?")
_ENDS_LOW = re.compile(rf"[{_LOW}0-9]")
_BEFORE = re.compile(rf"[{_CAP}{_LOW}'’-]+$")
_MARK = re.compile(rf"(?<!\.)[.!?]\s+([{_LOW}]|[{_CAP}][{_LOW}'’]+)|(?<=\.)[!?]\s+([{_LOW}]|[{_CAP}][{_LOW}'’]+)")
_MARKS = re.compile(rf"[.!?][.!?\s]*(?:(?<=\s)([{_LOW}]|[{_CAP}][{_LOW}'’]+))?")
_NAME = re.compile(rf"[{_CAP}][{_LOW}'’-]*$")
# Words that cannot end a sentence.
NON_FINAL = frozenset(
    "le la les l' un une des du de au aux ce cet cette ces mon ma mes ton ta tes son sa ses notre nos votre vos leur leurs et ou mais donc or ni car que qu' qui dont où à en dans sur sous par pour avec sans chez vers depuis grand grande petit petite monsieur madame capitaine gouverneur chef général roi reine père mère the a an of to and".split()
)
_LONGEST = max(map(len, NON_FINAL))


def _missing(text: str, names: frozenset[str]):
    for hit in _OPENING.finditer(text):
        end = hit.start()
        while end and text[end - 1].isspace():
            end -= 1
        word = hit.group(1)
        if not end or not _ENDS_LOW.match(text, end - 1) or word in names or _NUMERAL.fullmatch(word):
            continue
        # a longer word than any in the list needs no look at its beginning
        last = _BEFORE.search(text, max(0, end - _LONGEST - 1), end)
        if last is None or last.group().lower() not in NON_FINAL:
            yield hit.start(), word


def missing(text: str, names: frozenset[str] = frozenset()) -> list[tuple[int, str]]:
    """(offset, word) where a capital opens a sentence that no mark closes before.

    The word before must end in a lower-case letter or digit and be able to end a sentence, in any case.
    """
    return list(_missing(text, names))


def _parts_name(text: str, at: int, word: str, names: frozenset[str], longest: int) -> bool:
    """Do the word before `at` and `word` make one of the names?  No more of the text is looked at than the longest name."""
    name = longest and _NAME.search(text, max(0, at - longest), at)
    return bool(name) and f"{name.group()} {word}" in names


def spurious(text: str, names: frozenset[str] = frozenset()) -> list[int]:
    """Offsets of . ! ? before a lower-case letter, or inside a name of several words; the second dot of .. is exempt."""
    found, longest = [], max(map(len, names), default=0)
    for hit in _MARK.finditer(text):
        word = hit.group(1) or hit.group(2)
        if word[0].islower() or _parts_name(text, hit.start(), word, names, longest):
            found.append(hit.start())
    return found


def without_spurious(text: str, names: frozenset[str] = frozenset()) -> tuple[str, int]:
    """The text less its spurious marks, until none is left, and how many went.

    Whether a mark goes depends on what follows it, and what stands before it never changes: of marks with only
    white space between them the last goes first, and one that stays keeps those before it.  So one pass does.
    """
    kept, done, n, longest = [], 0, 0, max(map(len, names), default=0)
    for hit in _MARKS.finditer(text):
        word, gone = hit.group(1), []
        if word is None:
            continue
        for at in range(hit.start(1) - 1, hit.start() - 1, -1):
            if text[at] in ".!?":
                if text[at] == "." and at and text[at - 1] == "." or not (word[0].islower() or _parts_name(text, at, word, names, longest)):
                    break
                gone.append(at)
        for at in reversed(gone):
            kept.append(text[done:at])
            done, n = at + 1, n + 1
    return "".join([*kept, text[done:]]), n


def pieces(text: str, names: frozenset[str] = frozenset()) -> list[tuple[str, bool]]:
    """The text cut at every missing boundary and line break; True: a full stop belongs before this piece.  A line break needs none."""
    out = []
    for line in text.split("\n"):
        ends = [offset for offset, _ in missing(line, names)]
        mine = [" ".join(line[a:b].split()) for a, b in zip([0, *ends], [*ends, len(line)])]
        mine = [p for p in mine if p]
        out += [(p, k > 0) for k, p in enumerate(mine)]
    return out


def packed(parts: list[tuple[str, bool]], alone: int = 45) -> list[list[tuple[str, bool]]]:
    """Neighbours two by two, a line each; a piece over `alone` characters has a cue of its own."""
    out: list[list[tuple[str, bool]]] = []
    open_ = False
    for p in parts:
        short = len(p[0]) <= alone
        if short and open_:
            out[-1].append(p)
        else:
            out.append([p])
        open_ = short and not (short and open_)
    return out


def joined(parts: list[tuple[str, bool]], song: bool) -> str:
    """Pieces of one cue: lines in a song; otherwise a full stop where one is missing, a space elsewhere."""
    if song:
        return "\n".join(p for p, _ in parts)
    return parts[0][0] + "".join((". " if stop else " ") + p for p, stop in parts[1:])


def shares(start: int, end: int, sizes: list[int]) -> list[tuple[int, int]]:
    """The span shared by length; the last takes the end; an empty share lasts 300 ms at most."""
    out, at, total = [], float(start), sum(sizes) or 1
    for k, n in enumerate(sizes):
        stop = float(end) if k + 1 == len(sizes) else min(at + (end - start) * n / total, end)
        if stop <= at:
            stop = min(at + 300, end)
        out.append((round(at), round(stop)))
        at = stop
    return out


def mended(start: int, end: int, text: str, song: bool, names: frozenset[str]) -> list[tuple]:
    """The cues that one cue becomes, as start_ms, end_ms, text, n_stops, n_breaks, n_removed.  Without a missing boundary it keeps its lines and times."""
    clean, marks = without_spurious(text, names)
    if next(_missing(clean, names), None) is None:
        return [(start, end, clean, 0, 0, marks)]
    groups = packed(pieces(clean, names))
    times = shares(start, end, [len(" ".join(p for p, _ in g)) for g in groups]) if len(groups) > 1 else [(start, end)]
    stops = [0 if song else sum(stop for _, stop in g[1:]) for g in groups]
    breaks = len(groups[0]) - 1 if song and len(groups) == 1 else 0
    return [(a, b, joined(g, song), n, breaks, 0 if k else marks) for k, ((a, b), g, n) in enumerate(zip(times, groups, stops))]


_SCHEMA = "array<struct<start_ms:bigint,end_ms:bigint,text:string,n_stops:int,n_breaks:int,n_removed:int>>"
_TYPES = {"start_ms": pa.int64(), "end_ms": pa.int64(), "text": pa.string(), "n_stops": pa.int32(), "n_breaks": pa.int32(), "n_removed": pa.int32()}


def repaired(cues: DataFrame, names: list[str] = (), songs: str = "false") -> DataFrame:
    """Spurious marks removed, missing sentence ends mended, one-line texts wrapped to two lines of 42 (and 3) characters.

    A cue with a missing boundary is cut there and at its line breaks, and packed two pieces a cue; several
    cues share its time by length.  songs: SQL test of cues that only get line breaks, never a full stop.
    Adds part (from 1), n_stops, n_breaks and n_removed.  Every start and end of the input survives.
    """
    known = frozenset(names)

    @F.arrow_udf(_SCHEMA)
    def fix(start: pa.Array, end: pa.Array, text: pa.Array, song: pa.Array) -> pa.Array:
        rows, ends = [], [0]
        for s, e, t, is_song in zip(start.to_pylist(), end.to_pylist(), text.to_pylist(), song.to_pylist()):
            rows += mended(int(s), int(e), t or "", bool(is_song), known)
            ends.append(len(rows))
        columns = zip(*rows) if rows else [()] * len(_TYPES)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES.values())], list(_TYPES)))

    x = cues.withColumn("__song", F.expr(songs)).select("*", F.posexplode(fix("start_ms", "end_ms", "text", "__song")).alias("__part", "__new"))
    wrapped = F.when(F.contains("__new.text", F.lit("\n")), F.col("__new.text")).otherwise(cues_wrapped(F.col("__new.text")))
    return x.select(*[c for c in cues.columns if c not in ("start_ms", "end_ms", "text")], "__new.start_ms", "__new.end_ms", wrapped.alias("text"), (F.col("__part") + 1).alias("part"), "__new.n_stops", "__new.n_breaks", "__new.n_removed")


def cues_wrapped(text):
    """The repair's own wrap: no preference for sentence starts, 3 characters over are borne, and one line stays if no split fits."""
    return wrapped(text, tolerance=3, marks="[.!?:;,]$", starts=False, fallback=False)


def summary(before: DataFrame, after: DataFrame, keys=("film_id",)) -> DataFrame:
    """Per film: cues before and after, splits, line breaks, full stops put in, marks removed."""
    x = before.groupBy(*keys).agg(F.count("*").alias("n_before"))
    y = after.groupBy(*keys).agg(F.count("*").alias("n_after"), F.count_if(F.col("part") > 1).alias("n_split"), F.sum("n_breaks").alias("n_breaks"), F.sum("n_stops").alias("n_stops"), F.sum("n_removed").alias("n_removed"))
    return x.join(y, list(keys))


def boundary_report(cues: DataFrame, names: list[str] = ()) -> DataFrame:
    """Cues with `missing` (words that open a sentence unmarked), n_missing and n_spurious."""
    known = frozenset(names)

    @F.pandas_udf("struct<missing:array<string>,n_spurious:int>")
    def look(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"missing": [[w for _, w in missing(t or "", known)] for t in text], "n_spurious": [len(spurious(t or "", known)) for t in text]})

    x = cues.withColumn("__x", look("text"))
    return x.select(*cues.columns, "__x.missing", F.size("__x.missing").alias("n_missing"), "__x.n_spurious")


def planned(cues: DataFrame, words: DataFrame, names: list[str] = (), gap_ms: int = 350, keys=("film_id",)) -> DataFrame:
    """Cues with a missing boundary: its first word, the largest pause inside the cue and its middle (null for none), and `plan`: SPLIT if the pause reaches gap_ms."""
    x = boundary_report(cues, names).where("n_missing > 0").select(*keys, "cue_id", "start_ms", "end_ms", F.get("missing", F.lit(0)).alias("word"))
    quiet = inner_silence(x, words, keys)
    return x.join(quiet, [*keys, "cue_id"], "left").withColumn("plan", F.when(F.col("gap_ms") >= gap_ms, "SPLIT").otherwise("break/punct"))

"""Hand-derived cases and invariants of the engine's operators."""

import time

from pyspark.sql import functions as F

from cadenza.functions import stamps
from cadenza.functions import text as T
from cadenza.operators import corrections, cues, intervals, matching, repair, review
from cadenza.sources import bitmap, cuefiles, timings


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


def test_stamps(spark):
    assert one(spark, "01:01:01,500", stamps.to_ms) == 3_661_500
    assert one(spark, "00:00:01.250", stamps.to_ms) == 1250
    assert one(spark, "later", stamps.to_ms) is None
    assert one(spark, "1.9996", lambda c: stamps.from_ms(stamps.seconds_to_ms(c.cast("double")))) == "00:00:02,000"
    assert one(spark, "11:55", stamps.clock_to_ms) == 715_000
    assert one(spark, "01:02:03", stamps.clock_to_ms) == 3_723_000


def test_text_rules(spark):
    assert one(spark, "Quoi?", lambda c: T.spacing(c, "fr")) == "Quoi ?"
    assert one(spark, "Quoi ?", lambda c: T.spacing(c, "en")) == "Quoi?"
    assert one(spark, "Oui , non .", lambda c: T.spacing(c, "fr")) == "Oui, non."
    assert one(spark, "12:30", lambda c: T.spacing(c, "fr")) == "12 :30"
    for bad, good in (("Viens I!", "Viens !"), ("{u viens", "tu viens"), ("On y va I", "On y va !"), ("maïitre", "maître"), ("OUI!", "OU !")):
        assert one(spark, bad, lambda c: T.ocr_line(c, "fr")) == good
    assert one(spark, "OUI!", lambda c: T.ocr_line(c, "fr", guard_capitals=True)) == "OUI !"
    assert one(spark, "Huns,", T.normal) == "huns" and one(spark, "cœur", T.normal) == "cur"
    assert [one(spark, x, T.is_sign) for x in ("SORTIE", "Sortie", "123")] == [True, False, False]
    assert [one(spark, "x" * n, T.duration_cap) for n in (3, 11, 38)] == [1200, 1320, 4500]
    assert one(spark, "you know the truth", lambda c: T.foreign_share(c, T.FOREIGN_DROP)) == 0.75
    assert one(spark, "On a vu", T.foreign_share) == 0


def test_wrap(spark):
    text = "qui es-tu Je suis un ami que tu ne connais pas"
    assert one(spark, text, cues.wrapped) == "qui es-tu Je suis un ami\nque tu ne connais pas"
    assert one(spark, "court", cues.wrapped) == "court"


def _words(spark, rows):
    return spark.createDataFrame([(1, i, w, s, e) for i, (w, s, e) in enumerate(rows)], "film_id int, pos int, word string, start_ms long, end_ms long")


def test_wrap_of_many_cues(spark):
    """Words of a cue are split and measured once, not anew for every place it may break at."""
    text = "Une phrase, puis rien que des mots sans fin ni but et puis encore un de plus"
    x = spark.range(40_000).select(F.concat(F.lit(text + " "), (F.col("id") % 10).cast("string")).alias("x"))
    cut = cues.wrapped(F.col("x"))
    assert [r.y for r in x.where("x like '% 3'").limit(1).select(cut.alias("y")).collect()] == ["Une phrase, puis rien que des mots sans\nfin ni but et puis encore un de plus 3"]
    start = time.time()
    assert x.agg(F.count_if(F.length(cut) == F.length("x"))).first()[0] == 40_000
    assert time.time() - start < 10
    for line in ("  deux   espaces\tet une tabulation qui font plus de quarante deux  ", "x" * 60, " " * 60, None):
        got = one(spark, line, cues.wrapped)
        assert (got or "").split() == (line or "").split() and (line is None) == (got is None)


def test_grouping_and_extension(spark):
    made = cues.group_words(_words(spark, [("Bonjour", 0, 400), ("Marie.", 500, 900), ("Oui", 2000, 2300)]))
    assert [(r.text, r.start_ms, r.end_ms) for r in made.orderBy("cue_id").collect()] == [("Bonjour Marie.", 0, 900), ("Oui", 2000, 2300)]
    assert [(r.start_ms, r.end_ms) for r in cues.extend(made).orderBy("cue_id").collect()] == [(0, 900), (2000, 2900)]
    two = spark.createDataFrame([(1, 1, 0, 900, "x" * 40), (1, 2, 1500, 4000, "y")], "film_id int, cue_id int, start_ms long, end_ms long, text string")
    assert cues.extend(two).orderBy("cue_id").first().end_ms == 1420


def test_cut_plan(spark):
    films = spark.createDataFrame([(1, 20_000), (2, 20_000), (3, 20_000)], "film_id int, duration_ms long")
    quiet = spark.createDataFrame([(1, 7500), (1, 15_200), (3, 7000), (3, 9000)], "film_id int, at_ms long")
    got = {}
    for r in cues.cut_points(films, quiet, 8000).orderBy("chunk_no").collect():
        got.setdefault(r.film_id, []).append(r.cut_ms)
    assert got[1] == [0, 7500, 15_200, 20_000] and got[2] == [0, 8000, 16_000, 20_000] and got[3][1] == 7000


def test_overlap_matches_nested_loop(spark):
    import random

    rnd = random.Random(5)
    a = [(rnd.randint(0, 2), i, s := rnd.randint(0, 5_000_00), s + rnd.randint(0, 90_000)) for i in range(200)]
    b = [(rnd.randint(0, 2), i, s := rnd.randint(0, 5_000_00), s + rnd.randint(0, 90_000)) for i in range(200)]
    schema = "film_id int, cue_id int, start_ms long, end_ms long"
    for inclusive, pad in ((False, 0), (False, 1200), (True, 10_000)):
        got = {(r.l_cue_id, r.r_cue_id) for r in intervals.overlaps(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), pad, inclusive, bucket_ms=30_000).collect()}
        hit = (lambda x, y: y[3] >= x[2] - pad and y[2] <= x[3] + pad) if inclusive else (lambda x, y: y[3] > x[2] - pad and y[2] < x[3] + pad)
        assert got == {(x[1], y[1]) for x in a for y in b if x[0] == y[0] and hit(x, y)}


def test_coverage_and_runs(spark):
    schema = "film_id int, cue_id int, start_ms long, end_ms long"
    out = spark.createDataFrame([(1, 1, 0, 1000), (1, 2, 5000, 6000)], schema)
    ref = spark.createDataFrame([(1, 1, 500, 2000), (1, 2, 6400, 7000), (1, 3, 6500, 7000), (1, 4, 9000, 10_000)], schema)
    missed = intervals.uncovered(ref, out)
    assert sorted(r.cue_id for r in missed.collect()) == [3, 4]
    run = cues.runs(missed).collect()
    assert [(r.start_ms, r.end_ms, r.n_cues) for r in run] == [(6500, 10_000, 2)] and cues.top_gaps(cues.runs(missed)).count() == 0


def test_review(spark):
    assert review.unsupported(["les", "uns", "arrivent"], ["les", "huns", "arrivent"]) == [1]
    assert review.unsupported("a b a".split(), "a x b".split()) == [2]
    rows = [(1, "les uns", "les huns", "les huns"), (2, "les uns", "des uns", "les huns"), (3, "les uns", "les uns", "les uns"), (4, "les uns", None, "les huns"), (5, "les uns", None, None)]
    got = {r.cue_id: (r.tier, r.marked) for r in review.tiers(spark.createDataFrame(rows, "cue_id int, text string, can string, qwn string"), ["can", "qwn"]).collect()}
    assert [got[i][0] for i in range(1, 6)] == ["both", "one", "none", "one", "none"] and got[4][1] == "les [[uns]]"
    spans = spark.createDataFrame([(20, 41), (20, 40)], "own_chars int, other_chars int")
    assert [r.swallowed for r in review.swallowed(spans).orderBy("other_chars").collect()] == [False, True]


def test_corrections(spark):
    x = spark.createDataFrame([(1, 0, 10, "les\nuns"), (2, 0, 10, "quelques-uns"), (3, 0, 10, "gone")], "film_id int, start_ms long, end_ms long, text string")
    got = corrections.apply_rules(x, [(r"\bles\s+uns\b", "les Huns"), ("gone", "")])
    assert sorted((r.text, r.changed) for r in got.collect()) == [("", True), ("les Huns", True), ("quelques-uns", False)]
    assert corrections.residual(got, ["les uns", "les Huns"]).collect()[0].pattern == "les Huns"
    assert corrections.lost_stamps(x, got).count() == 0


def test_repair(spark):
    assert [w for _, w in repair.missing("Aide-moi à retourner le canot Mais que faisais-tu là-haut ?")] == ["Mais"]
    assert [w for _, w in repair.missing("c'est John Smith", frozenset(["John", "Smith"]))] == []
    assert repair.missing("le roi Jacques Ier") == [] and repair.missing("où est le Capitaine Smith") == []
    assert repair.without_spurious("j'ignore. comment") == ("j'ignore comment", 1)
    assert repair.without_spurious("Attends... quoi")[1] == 0 and repair.without_spurious("Ah ! mais oui")[0] == "Ah  mais oui"
    assert repair.without_spurious("Grand-mère. Feuillage", frozenset(["Grand-mère Feuillage"]))[1] == 1


def test_marks_one_pass():
    # of marks with only white space between them the last goes first; one that stays keeps those before it
    assert repair.without_spurious("a. ! b") == ("a  b", 2) and repair.without_spurious("a.! b") == ("a b", 2)
    assert repair.without_spurious("a. .. b") == ("a. .. b", 0) and repair.without_spurious("a? ... b. C. d") == ("a? ... b. C d", 1)
    names = frozenset(["Grand-mère Feuillage"])
    assert repair.without_spurious("Grand-mère. ! Feuillage", names) == ("Grand-mère. ! Feuillage", 0)
    assert repair.without_spurious("Grand-mère\n. Feuillage", names) == ("Grand-mère\n Feuillage", 1)
    assert [o for o, _ in repair.missing("il va \t Elle.  Oui le gouverneur Tout")] == [5]


def test_repair_of_a_long_line():
    """Work grows with the length of a line, not with the square or cube of it."""
    start = time.process_time()
    text = "alors. il vient Mais non " * 800
    assert repair.without_spurious(text) == (text.replace(".", ""), 800)
    assert len(repair.missing(text)) == len(repair.spurious(text)) == 800
    assert len(repair.mended(0, 9000, text, False, frozenset())) == 401
    for x in (". " * 20_000, "." * 40_000, " " * 40_000, "a " * 20_000, "." * 40_000 + " b"):
        assert repair.without_spurious(x) == (x, 0) and repair.missing(x) == []
    assert time.process_time() - start < 2


CUE = "film_id int, cue_id int, start_ms long, end_ms long, text string"


def mend(spark, text, end=5000, **options):
    x = spark.createDataFrame([(1, 1, 0, end, text)], CUE)
    out = repair.repaired(x, **options)
    assert corrections.stamps_survive(x, out).count() == 0
    return [(r.start_ms, r.end_ms, r.text) for r in out.orderBy("part").collect()]


def test_repaired_cues(spark):
    assert mend(spark, "Aide le canot Mais viens", 4000) == [(0, 4000, "Aide le canot. Mais viens")]
    assert mend(spark, "Aide le canot Mais viens", 4000, songs="true") == [(0, 4000, "Aide le canot\nMais viens")]
    # shares by the pieces' own length, without the full stop put in: 17 and 9 of 26 characters
    assert mend(spark, "Il va Elle vient Tout part") == [(0, round(5000 * 16 / 25), "Il va. Elle vient"), (round(5000 * 16 / 25), 5000, "Tout part")]
    # sound cues keep their lines and times
    assert mend(spark, "Une ligne.\nUne autre.") == [(0, 5000, "Une ligne.\nUne autre.")]
    assert mend(spark, "a b c\nd e f\ng h i") == [(0, 5000, "a b c\nd e f\ng h i")]
    # pieces over 45 characters have cues of their own, wrapped to two lines
    long = "voici une phrase qui va tout de suite bien au dela de la limite"
    got = mend(spark, f"{long} Encore {long}")
    assert len(got) == 2 and all("\n" in t and len(t.split("\n")) == 2 for _, _, t in got) and got[0][1] == got[1][0]
    # a song of four pieces takes two cues of two lines
    assert [t for _, _, t in mend(spark, "un mot Deux mots Trois mots Quatre mots", songs="true")] == ["un mot\nDeux mots", "Trois mots\nQuatre mots"]
    # a cut at a line break takes no full stop
    assert [t for _, _, t in mend(spark, "il va Elle vient\net tout part")] == ["il va. Elle vient", "et tout part"]
    # one-line texts are wrapped; one that no split fits stays whole
    assert mend(spark, "qui es-tu donc, mon ami que je ne connais pas encore")[0][2].count("\n") == 1
    assert mend(spark, "mot " * 40)[0][2] == ("mot " * 40).strip()
    assert mend(spark, "j'ignore. comment") == [(0, 5000, "j'ignore comment")]
    x = spark.createDataFrame([(1, 1, 0, 5000, "Il va Elle vient Tout part"), (1, 2, 6000, 7000, "bien. sûr")], CUE)
    r = repair.summary(x, repair.repaired(x)).first()
    assert (r.n_before, r.n_after, r.n_split, r.n_breaks, r.n_stops, r.n_removed) == (2, 3, 1, 0, 1, 1)


def test_repair_checks_of_a_long_line(spark):
    x = spark.createDataFrame([(1, 1, 0, 9000, "alors. il vient Mais non " * 800)], CUE)
    start = time.time()
    out = repair.repaired(x)
    r = repair.summary(x, out).first()
    assert (r.n_before, r.n_after, r.n_removed) == (1, 401, 800) and corrections.stamps_survive(x, out).count() == 0
    assert time.time() - start < 30


def test_lost_stamps_query_of_a_long_line(spark, tmp_path):
    """The query itself, on a line of 1,600 marks; a cue that goes is reported."""
    from cadenza.plans import queries

    rows = [(1, "fr", "alors. il vient Mais non " * 1600), (2, "fr", "bien. sûr\n \n\nIl va Elle vient Tout part"), (3, "fr", None)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    start = time.time()
    assert queries.repair_lost_stamps(spark, str(tmp_path)).count() == 0
    assert time.time() - start < 30
    x = queries._line_cues(spark, str(tmp_path))
    gone = corrections.stamps_survive(x, repair.repaired(x).where("part < 801 and (film_id = 1 or cue_id > 0)"))
    assert sorted((r.film_id, r.at_ms) for r in gone.collect()) == [(1, 9000), (2, 0), (2, 9000)]


def test_summary_query_of_a_long_line(spark, tmp_path):
    """The query itself, on a line of 1,600 marks; blank lines are no cues, and a film without a text has no row."""
    from cadenza.plans import queries

    rows = [(1, "fr", "alors. il vient Mais non " * 1600), (2, "fr", "bien. sûr\n \n\nIl va Elle vient Tout part"), (3, "fr", None)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    start = time.time()
    got = {tuple(r) for r in queries.repair_summary(spark, str(tmp_path)).collect()}
    assert time.time() - start < 30
    assert got == {(1, 1, 801, 800, 0, 800, 1600), (2, 2, 3, 1, 0, 1, 1)}


def test_words_dealt_as_texts(spark):
    """Whole texts are shuffled, and cut into words afterwards; words are not shuffled again."""
    from cadenza.plans import queries

    x = spark.createDataFrame([(1, "un deux")], "doc_id long, text string")
    was, queries._t = queries._t, lambda *a: x
    try:
        plan = queries.wrap_two_lines(spark, "")._jdf.queryExecution().executedPlan().toString()
    finally:
        queries._t = was
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Generate") < plan.index("Exchange hashpartitioning")


def test_repair_plan(spark):
    x = spark.createDataFrame([(1, 1, 0, 4000, "il va Elle vient"), (1, 2, 5000, 9000, "il va Elle vient")], CUE)
    w = spark.createDataFrame([(1, 0, "il", 0, 300), (1, 1, "va", 400, 800), (1, 2, "Elle", 1200, 1500), (1, 3, "il", 5000, 5300), (1, 4, "va", 5400, 5900)], "film_id int, pos int, word string, start_ms long, end_ms long")
    got = {r.cue_id: (r.word, r.gap_ms, r.middle_ms, r.plan) for r in repair.planned(x, w).collect()}
    assert got == {1: ("Elle", 400, 1000.0, "SPLIT"), 2: ("Elle", 100, 5350.0, "break/punct")}


def test_two_chunks(spark):
    """Words of several chunks come in film order, whatever their place in their chunk."""
    files = spark.createDataFrame([("f", '{"c01": [{"word": "c", "start": 0.0, "end": 0.2}, {"word": "d", "start": 0.3, "end": 0.5}], "c00": [{"word": "a", "start": 0.0, "end": 0.2}, {"word": "b", "start": 0.3, "end": 0.5}]}')], "film_id string, content string")
    w = timings.on_film_time(timings.words(files), timings.cuts(spark.createDataFrame([("f", "0\n1.0\n2.0")], "film_id string, content string")))
    assert [r.word for r in timings.film_order(w).orderBy("n").collect()] == ["a", "b", "c", "d"]
    assert [r.text for r in cues.group_words(w).collect()] == ["a b c d"]
    assert [r.gap_ms for r in cues.word_gaps(w).orderBy("start_ms").collect()] == [None, 100, 500, 100]


def test_bad_rows_in_interval_joins(spark):
    schema = "film_id int, source string, seq int, cue_id int, start_ms long, end_ms long, text string"
    ref = spark.createDataFrame([(1, "R", 0, 5, 0, 1000, "un"), (1, "R", 1, 5, 50_000, 51_000, "deux"), (1, "R", 2, 6, 100_000, 100_000, "trois"), (1, "R", 3, 7, 200_000, None, "sans fin")], schema)
    # one cue over all films by a corrupt end, and one whose end lies before its start
    out = spark.createDataFrame([(1, "O", 0, 1, 200, 900, "un"), (1, "O", 1, 2, 100_400, 99_700, "trois"), (2, "O", 2, 3, 0, 10**12, "x")], schema)
    assert [r.seq for r in intervals.uncovered(ref, out).orderBy("seq").collect()] == [1, 3]
    assert {r.seq: r.window for r in intervals.windows(ref, out, 500).collect()} == {0: "un", 1: "", 2: "trois", 3: ""}
    wide = spark.createDataFrame([(1, "O", 0, 1, -5, 10**12, "tout")], schema)
    assert intervals.overlaps(ref, wide).count() == 3 and intervals.overlaps(wide, ref).count() == 3
    assert intervals.starts_within(ref, wide).count() == 4
    assert {r.seq: r.tag for r in matching.corroborated(ref, out).collect()} == {0: "corroborated", 1: "unconfirmed", 2: "corroborated", 3: "unconfirmed"}
    assert [(r.seq, r.other_id) for r in matching.start_deltas(ref, out).orderBy("seq").collect()] == [(0, 1), (2, 2)]


def segment(seconds, kind, body):
    import struct

    return b"PG" + struct.pack(">IIBH", int(seconds * 90_000), 0, kind, len(body)) + body


def composition(seconds, refs, palette=0):
    import struct

    body = bytes(9) + bytes([palette, len(refs)])
    return segment(seconds, 0x16, body + b"".join(struct.pack(">HBBHH", number, 0, 0x40 if cropped else 0, 0, 0) + (bytes(8) if cropped else b"") for number, cropped in refs))


def drawn(seconds, number, pixels, flag=0xC0):
    import struct

    return segment(seconds, 0x15, struct.pack(">H", number) + bytes([0, flag]) + bytes(3) + struct.pack(">HH", len(pixels[0]), len(pixels)) + b"".join(bytes(row) + b"\0\0" for row in pixels))


def test_bitmap_streams(spark):
    palette = segment(0, 0x14, bytes([0, 0]) + bytes([1, 50, 0, 0, 255, 2, 200, 0, 0, 255]))
    data = b"junk" + composition(1, [(0, False)]) + palette + drawn(1, 0, [[1] * 8] * 8) + b"\xffnoise" + composition(2, [(0, False)]) + drawn(2, 0, [[2] * 8] * 8)
    got = bitmap.events(data)
    # object 0 is drawn anew; the last event has no end
    assert [(e["start"], e["end"], int(e["image"][48, 48])) for e in got] == [(1.0, 2.0, 205), (2.0, 5.0, 55)]
    assert got[0]["image"].shape == (96, 96) and got[0]["image"][0, 0] == 255
    # a cropped reference has 16 bytes; two images are stacked 10 rows apart, the narrower one centred
    two = composition(1, [(3, True), (4, False)]) + palette + drawn(1, 3, [[1] * 12] * 4) + drawn(1, 4, [[1] * 4] * 4) + composition(4, [])
    (e,) = bitmap.events(two)
    assert e["end"] == 4.0 and e["image"].shape == (2 * (4 + 10 + 4 + 40), 2 * (12 + 40))
    assert bitmap.shown(bytes(9) + bytes([0, 2]) + b"\0\3\0\x40" + bytes(12) + b"\0\4\0\0" + bytes(4)) == [3, 4]
    low = e["image"][2 * (20 + 4 + 10) + 2 : 2 * (20 + 4 + 10 + 4) - 2]
    assert (low[:, 2 * (20 + 4) + 2 : 2 * (20 + 8) - 2] < 230).all() and (low[:, : 2 * 22] > 240).all()
    # a fragment that is continued is drawn once it is whole
    cut = composition(1, [(0, False)]) + palette + drawn(1, 0, [[1] * 8] * 4, 0x80) + segment(1, 0x15, b"\0\0\0\x40" + (b"\1" * 8 + b"\0\0") * 4)
    assert len(bitmap.events(cut)) == 1
    df = spark.createDataFrame([("f", bytearray(data))], "film_id string, content binary")
    rows = bitmap.decode(df).orderBy("n").collect()
    assert [(r.n, r.start_ms, r.end_ms, r.width) for r in rows] == [(1, 1000, 2000, 96), (2, 2000, 5000, 96)]
    texts = bitmap.read_images(bitmap.decode(df), lambda p, w, h: f"{w} x {h}\n\n a  b ")
    assert [(r.cue_id, r.lines) for r in bitmap.read_cues(bitmap.decode(df), texts).orderBy("n").collect()] == [(1, ["96 x 96", "a b"]), (2, ["96 x 96", "a b"])]


def test_sources(spark, tmp_path):
    import pytest

    (tmp_path / "a.srt").write_text("x1\n00:00:01,000 --> 00:00:02,000\nun\n\n2\n00:00:03,000 --> 00:00:04,000\ndeux\n")
    got = cuefiles.bind(spark, [f"canary={tmp_path}/a.srt", f"ref={tmp_path}/a.srt"])
    assert sorted((r.source, r.cue_no, r.cue_id) for r in got.collect()) == [("CAN", "2", 2), ("CAN", "x1", None), ("REF", "2", 2), ("REF", "x1", None)]
    for bad, kind in ((f"{tmp_path}/a.srt", ValueError), (f"x={tmp_path}/none.srt", FileNotFoundError)):
        with pytest.raises(kind):
            cuefiles.bind(spark, [bad])
    with pytest.raises(ValueError):
        cuefiles.bind(spark, [f"refa={tmp_path}/a.srt", f"refb={tmp_path}/a.srt"])
    assert review.request(["d.srt", "r.srt", "1", "150"]) == {"asr": ["CAN", "QWN"], "tier": "all", "rank": False, "draft": "d.srt", "lo": 1, "hi": 150, "sources": ["REF=r.srt"]}
    assert review.request("d.srt 1 9 CAN=c.srt --asr can,whisper --tier both --rank".split())["asr"] == ["CAN", "WHI"]
    (tmp_path / "chunks").mkdir()
    for name in ("c00.wav", "c11.wav", "x.txt"):
        (tmp_path / "chunks" / name).write_bytes(b"1")
    assert sorted((r.film_id, r.chunk_no) for r in timings.read_chunks(spark, str(tmp_path / "chunks")).collect()) == [("chunks", 0), ("chunks", 11)]
    (tmp_path / "windows").mkdir()
    (tmp_path / "windows" / "0003.txt").write_text(" bonjour ")
    assert [(r.window_no, r.text) for r in timings.window_texts(spark, str(tmp_path / "windows")).collect()] == [(3, "bonjour")]
    (tmp_path / "found.json").write_text('{"cue": 1, "timestamp": "00:01", "verdict": "fix"}\n{"cue": 2, "verdict": "fix"}\n')
    assert [r.cue for r in timings.findings(spark, str(tmp_path / "found.json")).collect()] == [1]
    cuefiles.write(got.where("source = 'REF'"), str(tmp_path / "out"))
    text = spark.read.text(str(tmp_path / "out"), wholetext=True).first().value
    assert text == "1\n00:00:01,000 --> 00:00:02,000\nun\n\n2\n00:00:03,000 --> 00:00:04,000\ndeux\n\n"


def test_streams(spark, tmp_path):
    from cadenza.streaming import live

    schema = "film_id int, chunk_no int, text string"
    spark.createDataFrame([(1, 0, "bonjour"), (1, 1, " ")], schema).write.json(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).json(str(tmp_path / "in"))
    live.ingest(source, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    spark.createDataFrame([(1, 1, "encore")], schema).write.mode("append").json(str(tmp_path / "in"))
    live.ingest(source, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    expected = spark.createDataFrame([(1, k) for k in range(3)], "film_id int, chunk_no int")
    got = live.ingested(spark, str(tmp_path / "out"), expected)
    assert {(r.chunk_no, r.status) for r in got.collect()} == {(0, "ok"), (1, "ok"), (2, "missing")}
    assert sorted(r.chunk_no for r in timings.pending(expected, got).collect()) == [2]
    spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:05"), (1, "2024-01-01 00:01:00")], "film_id int, ts string").write.json(str(tmp_path / "ev"))
    events = spark.readStream.schema("film_id int, ts timestamp").json(str(tmp_path / "ev"))
    q = live.sessions(events).writeStream.format("memory").queryName("runs").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.n_cues for r in spark.table("runs").collect()) == [1, 2]


def test_review_order_and_consensus(spark):
    rows = [(1, 1, 300, "one", [1]), (1, 2, 200, "both", [1]), (1, 3, 100, "both", [1, 2]), (1, 4, 50, "none", []), (1, 5, 10, "one", [])]
    x = spark.createDataFrame(rows, "film_id int, cue_id int, start_ms long, tier string, agreed array<int>")
    assert {r.cue_id: r["rank"] for r in review.ranked(x).collect()} == {3: 1, 2: 2, 1: 3, 5: 4, 4: 5}
    truth = spark.createDataFrame([(1, 2), (1, 4), (1, 9)], "film_id int, cue_id int")
    r = review.recall(review.selected(review.ranked(x), tier="both"), truth).first()
    assert (r.n_known, r.n_caught, r.best_rank) == (3, 1, 2)
    votes = spark.createDataFrame([(3, 3), (2, 3), (1, 3), (0, 3), (1, 1), (2, 4)], "n_agree int, n_sources int")
    assert [v[0] for v in votes.select(review.consensus()).collect()] == ["dismiss", "fix", "ask", "ask", "ask", "ask"]


def test_spaces(spark):
    assert one(spark, "Quoi\u2009?", lambda c: T.spacing(c, "fr")) == "Quoi ?" and one(spark, "a\u3000, b", lambda c: T.spacing(c, "en")) == "a, b"


def test_cue_files(spark):
    srt = "1\n00:00:01,000 --> 00:00:02,500\nBonjour\nMarie\n\n2\nbroken\nx\n\n3\n00:00:03.000 --> 00:00:04.000\nOui  là\n\n4\n00:00:05,000 --> 00:00:06,000"
    got = cuefiles.parse(spark.createDataFrame([("f", "ASR", srt)], "film_id string, source string, content string"))
    assert [(r.cue_id, r.start_ms, r.end_ms, r.text) for r in got.orderBy("seq").collect()] == [(1, 1000, 2500, "Bonjour Marie"), (3, 3000, 4000, "Oui là")]
    assert cuefiles.rendered(got).first().content == "1\n00:00:01,000 --> 00:00:02,500\nBonjour\nMarie\n\n2\n00:00:03,000 --> 00:00:04,000\nOui là\n\n"


def test_timings(spark):
    files = spark.createDataFrame([("f", '{"c01": [{"word": "a", "start": 0.5, "end": 0.9}, {"word": "b"}]}'), ("g", '[{"words": [{"word": "c", "start": 1, "end": 2}]}]')], "film_id string, content string")
    w = timings.words(files)
    assert sorted((r.film_id, r.chunk_no, r.word, r.start_ms) for r in w.collect()) == [("f", 1, "a", 500), ("g", 0, "c", 1000)]
    c = timings.cuts(spark.createDataFrame([("f", "0.000\n10.0\n\n20.0\n")], "film_id string, content string"))
    assert [(r.start_ms, r.end_ms) for r in c.orderBy("chunk_no").collect()] == [(0, 10_000), (10_000, 20_000)]
    assert timings.on_film_time(w, c).where("film_id = 'f'").first().start_ms == 10_500
    assert timings.silences(spark.createDataFrame([("f", "x silence_start: 1.5\nsilence_start: 7")], "film_id string, content string")).count() == 2


def test_bitmap_run_lengths():
    data = bytes([1, 2, 0, 0, 0, 3, 0, 0, 0, 0x82, 7])
    got = bitmap.run_lengths(data, 4, 3)
    assert got.tolist() == [[1, 2, 0, 0], [0, 0, 0, 0], [7, 7, 0, 0]]


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_matching(spark):
    schema = "film_id int, cue_id int, start_ms long, end_ms long, text string"
    ref = spark.createDataFrame([(1, 1, 0, 1000, "Les Huns!"), (1, 2, 9000, 9500, "rien")], schema)
    ours = spark.createDataFrame([(1, 7, 300, 900, "les"), (1, 8, 500, 1500, "les huns"), (1, 9, 9100, 9300, "...")], schema)
    assert [(r.cue_id, r.other_id, r.shared, r.delta_ms) for r in matching.start_deltas(ref, ours).collect()] == [(1, 8, 2, 500)]
    assert {r.cue_id: r.tag for r in matching.corroborated(ref, ours).collect()} == {1: "corroborated", 2: "unconfirmed"}
    assert {r.start_ms: r.priority for r in matching.prioritised(ref, ours.where("cue_id = 9")).collect()} == {0: False, 9000: True}
    status = matching.chunk_status(ref, ours.where("cue_id = 7"), ("film_id", "start_ms"))
    assert matching.failed(status).first().n_failed == 2

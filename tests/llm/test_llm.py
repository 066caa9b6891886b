"""The training-data operators against brute force, and their edge cases."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cadenza.llm import bpe_words, context_tree, cross_polytope, line_suffixes, phrase_parsing, quality_ledger, simhash_tiles, slot_sharding, temperature_mix, toxic_sentences

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(3)
    words = ["alpha", "beta", "gamma", "Delta", "eps", "zeta,", "éta", "theta."] + [f"w{i}" for i in range(60)]
    text = lambda n: "".join(rnd.choice(words) + rnd.choice("   \n") for _ in range(n))
    rows = [(i, text(rnd.choice([3, 30, 80])), f"s{i % 3}") for i in range(60)]
    rows += [(100, rows[1][1], "s0"), (101, rows[1][1] + " more", "s0"), (102, "x" * 700, "s1"), (103, None, None), (104, "", "s2"), (None, "a b c", "s1"), (60, rows[2][1], "s1"), (60, rows[2][1], "s1"), (105, rows[4][1] * 3, "s0")]
    return table(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(spark, empty):
    assert context_tree.score(empty).count() == 0
    assert line_suffixes.dedup(empty).count() == 0
    assert simhash_tiles.near_duplicates(empty).count() == 0 and simhash_tiles.keep_one(empty).count() == 0
    assert quality_ledger.ledger(empty).count() == 0
    assert temperature_mix.plan(empty).count() == 0
    assert phrase_parsing.dedup(empty).count() == 0
    assert slot_sharding.place(empty, "doc_id", ["a", "b"]).count() == 0
    assert bpe_words.encode(empty, {bytes([b]): b for b in range(256)}, r"\S+|\s+").count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxic_sentences.score(empty, toxic_sentences.train(empty, labels)).count() == 0
    assert cross_polytope.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_context_tree(docs):
    rows = docs.collect()
    got = context_tree.score(docs).collect()
    assert len(got) == len(rows)
    # token counts and base scores by hand
    import re
    import zlib

    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 5 == 1
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) + ["\n"]
    c = Counter(w for r in rows if not held(r.doc_id) for w in tokens(r.text))
    n, v = sum(c.values()), len(c)
    want = sorted((r.doc_id or -1, len(tokens(r.text)), sum(c[w] > 0 for w in tokens(r.text)), round(sum(np.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(r.text)), 6)) for r in rows)
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert all(r.train_tokens == n and r.held_out == held(r.doc_id) and r.score < 0 for r in got)


def test_context_tree_against_recursion():
    """Weights of one small tree, by the defining recursion."""
    text = b"abracadabra abracadabra\n"
    buf, starts, sizes = context_tree.stream([text])
    keys = np.sort(context_tree.pair_keys(buf))
    u, c = np.unique(keys, return_counts=True)
    from math import lgamma, log

    kt = lambda a, b: lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - log(np.pi)
    events = [(buf[i - context_tree.DEPTH : i].tobytes(), buf[i]) for i in range(context_tree.DEPTH, len(buf))]

    def weighted(context, k, prefix, depth):
        mine = [s for ctx, s in events if ctx.endswith(context) and s >> (8 - k) == prefix]
        ones = sum((s >> (7 - k)) & 1 for s in mine)
        own = kt(len(mine) - ones, ones)
        if depth == context_tree.DEPTH:
            return own
        before = {ctx[-depth - 1 : -depth or None] + context for ctx, _ in events if ctx.endswith(context)}
        return np.logaddexp(log(0.5) + own, log(0.5) + sum(weighted(b, k, prefix, depth + 1) for b in before))

    k, (_, node, zeros, ones, value) = next((k, x) for k, x in enumerate(context_tree._subtree(u, c)) if k == 3)
    for at, got in list(zip(node.tolist(), value.tolist()))[:8]:
        context = bytes((at >> 8 * (j + 1)) & 255 for j in range(context_tree.SPLIT))
        assert got == pytest.approx(weighted(context, k, (at & 255) - (1 << k), context_tree.SPLIT), abs=1e-6)


def test_lines(docs, spark):
    rows = [(1, "a b c\nlong line " + "w " * 20 + "\nend", "s"), (2, "x\nlong line " + "w " * 20 + "\ny", "s"), (3, "p q r s t\nu v w x y\nz z z z z\nk k k k k\nother", "s"), (4, "p q r s t\nu v w x y\nz z z z z\nk k k k k\nnew", "s"), (5, "short\nshort", "s"), (6, None, "s")]
    got = {r.doc_id: (r.text, r["__removed"]) for r in line_suffixes.dedup(table(spark, rows)).collect()}
    assert got[1][1] == 0 and got[2] == ("x\ny", 1) and got[3][1] == 0 and got[4] == ("new", 4) and got[5][1] == 0 and got[6] == (None, 0)
    # a run of three lines that no window of one or two lines reaches; a repeat inside one document; blank lines at the edge
    run = "a1 a2 a3 a4 a5 a6 a7\nb1 b2 b3 b4 b5 b6 b7\nc1 c2 c3 c4 c5 c6 c7\n"
    odd = table(spark, [(1, "u\n" + run + "\nv", "s"), (2, "x\n" + run + "\ny", "s"), (3, "k " * 25 + "\n" + "k " * 25 + "\nz", "s"), (4, "b1 b2 b3 b4 b5 b6 b7\nother", "s")])
    got = {r.doc_id: (r.text, r["__removed"], r["__longest"]) for r in line_suffixes.dedup(odd).collect()}
    assert got[1][1] == 0 and got[2] == ("x\ny", 4, 4) and got[3] == ("k " * 25 + "\nz", 1, 1) and got[4][1] == 0
    lined = table(spark, [(1000 + i, "\n".join(" ".join(["p", "q"][: 1 + i * j % 2] * (j * i % 3)) for j in range(14)), "s") for i in range(24)])
    for x, least in ((docs, 5), (lined, 4), (lined, 9)):
        seen, want = set(), {}
        for r in sorted({(r.doc_id if r.doc_id is not None else -1, r.text or "") for r in x.collect()}):
            lines, gone = r[1].split("\n"), set()
            words = [len(k.split()) for k in lines]
            for i in range(len(lines)):
                for n in range(1, len(lines) - i + 1):
                    w = tuple(lines[i : i + n])
                    if sum(words[i : i + n]) >= least:
                        if w in seen:
                            gone.update(range(i, i + n))
                        seen.add(w)
            want[r] = len(gone)
        kept = line_suffixes.dedup(x, least).select("doc_id", "__removed").collect()
        assert Counter((r[0] if r[0] is not None else -1, r[1]) for r in kept) == Counter((r.doc_id if r.doc_id is not None else -1, want[r.doc_id if r.doc_id is not None else -1, r.text or ""]) for r in x.collect())


def test_simhash(docs):
    import xxhash

    def fp(t):
        w = (t or "").encode().lower().split()
        g = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in g]
        return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))

    rows = docs.collect()
    prints = [fp(r.text) for r in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(i):
                if bin(prints[i] ^ prints[j]).count("1") <= 2:
                    group[i] = group[j] = min(group[i], group[j])
    least = {}
    for g, r in zip(group, rows):
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    got = simhash_tiles.near_duplicates(docs).collect()
    key = lambda x: (x[0] if x[0] is not None else -1, x[1], x[2] if x[2] is not None else -1)
    assert sorted(map(key, got)) == sorted(key((r.doc_id, f"{p:016x}", least.get(g))) for r, p, g in zip(rows, prints, group))


def test_similar_groups(spark):
    rnd = random.Random(8)
    base = [" ".join(f"v{rnd.randint(0, 5000)}" for _ in range(300)) for _ in range(6)]
    near = base[0].split()
    near[150] = "changed"
    got = simhash_tiles.keep_one(table(spark, [(i, t, "s") for i, t in enumerate(base)] + [(10, " ".join(near), "s"), (11, base[1], "s")]))
    assert sorted(r.doc_id for r in got.collect()) == [0, 1, 2, 3, 4, 5]


def graded(rnd, graded_by=(0.5, 0.6, 0.65, 0.7, 0.75, 0.79, 0.8, 0.81, 0.85, 0.9, 0.95), each=4, n=124):
    """Texts, and for each a partner of about the given similarity of five-word shingles: the end is replaced."""
    rows = []
    for k, j in enumerate(graded_by):
        for e in range(each):
            words = [f"v{rnd.randint(0, 5000)}" for _ in range(n)]
            keep = round(2 * j / (1 + j) * (n - 4)) + 4
            rows += [(100 * k + 2 * e, " ".join(words), "s"), (100 * k + 2 * e + 1, " ".join(words[:keep] + [f"x{rnd.randint(0, 5000)}" for _ in range(n - keep)]), "s")]
    return rows


def exact_groups(rows, size=5):
    """Per row the place of the first row of its group: links of Jaccard similarity 0.8 or more of shingle sets."""
    sets = []
    for t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b) > 0:
                lo, hi = sorted((group[i], group[j]))
                group = [lo if g == hi else g for g in group]
    return group


def test_similar_groups_exact(spark):
    rnd = random.Random(12)
    rows = graded(rnd)
    # a chain of links, one text's passage many times over (the same set of shingles), short texts, no words
    words = [f"c{rnd.randint(0, 5000)}" for _ in range(124)]
    rows += [(2000 + k, " ".join([f"y{k}_{i}" for i in range(6 * k)] + words[6 * k :]), "s") for k in range(8)]
    rows += [(2100, " ".join(words[::-1]), "s"), (2101, " ".join(words[::-1] + (words[::-1][:40] + words[::-1]) * 6), "s"), (2102, " ".join(words[::-1][20:64] * 4 + words[::-1]), "s")]
    rows += [(2200 + k, " ".join(f"z{i}" for i in range(k)), "s") for k in range(12)] + [(2300, None, "s"), (2301, " ", "s")]
    rows.sort(key=lambda r: r[0])
    want = [rows[g][0] for g in exact_groups([t for _, t, _ in rows])]
    assert len(set(want)) < len(rows) - 20
    got = {r.doc_id: r.component_id for r in simhash_tiles.similar_groups(table(spark, rows)).collect()}
    assert got == {r[0]: g for r, g in zip(rows, want)}
    assert sorted(r.doc_id for r in simhash_tiles.keep_one(table(spark, rows)).collect()) == sorted(set(want))


def test_true_links_blocks(spark, monkeypatch):
    """The same groups where a candidate component is cut into blocks."""
    monkeypatch.setattr(simhash_tiles, "_MEMBERS", 3)
    rnd = random.Random(13)
    words = [f"c{rnd.randint(0, 5000)}" for _ in range(124)]
    rows = [(k, " ".join([f"y{k}_{i}" for i in range(5 * k)] + words[5 * k :]), "s") for k in range(14)]
    want = [rows[g][0] for g in exact_groups([t for _, t, _ in rows])]
    got = {r.doc_id: r.component_id for r in simhash_tiles.similar_groups(table(spark, rows)).collect()}
    assert got == {r[0]: g for r, g in zip(rows, want)} and len(set(want)) > 1


def test_quality(docs):
    for r in quality_ledger.ledger(docs).collect():
        w = (r.text or "").split()
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        c = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if c[g] > 1 for k in range(3)}
        assert (r.n_words, r.n_repeat_words, r.word_chars) == (len(w), len(covered), sum(map(len, w)))
        assert bool(r.fail_bits & 3) == (len(w) < 50 or 2 * len(covered) > len(w))
    x = {(r.policy, r.rule): r for r in quality_ledger.ablation(quality_ledger.ledger(docs)).collect()}
    assert x["base", "few_words"].n_docs == docs.count() and x["v2", "few_words"].n_kept <= x["base", "few_words"].n_kept


def test_mixing(docs, spark):
    got = temperature_mix.plan(docs, repeats=2.0).collect()
    assert len(got) == docs.count() and min(r.copies for r in got) >= 1 and max(r.copies for r in got) <= 3
    rows = [(i, "a " * 10, "big" if i < 900 else "small") for i in range(1000)]
    sums = Counter()
    for r in temperature_mix.plan(table(spark, rows), repeats=3.0).collect():
        sums[r.source] += r.copies * 10
    assert sums["big"] == 9000 and abs(sums["small"] - 3000) <= 10
    half = temperature_mix.plan(table(spark, rows), entropy=1.0, budget=4000, block_tokens=500).collect()
    assert abs(sum(r.copies * 10 for r in half if r.source == "big") - 2000) <= 10
    assert temperature_mix.realise(table(spark, rows), repeats=3.0).count() == 1200


def test_sharding(docs):
    shards = [f"n{i}" for i in range(7)]
    owner = slot_sharding.lookup(shards, 251)
    assert max(Counter(owner).values()) - min(Counter(owner).values()) <= 1
    fewer = slot_sharding.lookup(shards[:-1], 251)
    assert sum(a != b for a, b in zip(owner, fewer) if a != 6) < 251 * 0.3
    for r in slot_sharding.place(docs, "doc_id", shards, 251).collect():
        slot = int(hashlib.md5(("null" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % 251
        assert (r.slot, r.shard) == (slot, shards[owner[slot]])


def test_cross_polytope(spark):
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(120, 16))
    rows = [(i, (base[i % 40] + rnd.normal(size=16) * 0.05).tolist(), i % 2) for i in range(120)]
    rows += [(200, rows[0][1], 0), (201, [0.0] * 16, 0), (202, None, 0), (203, rows[0][1], None), (204, [float("nan")] * 16, 1), (205, [2 * x for x in rows[0][1]], 0), (206, [None] + [1.0] * 15, 1)]
    got = {r.vec_id: r for r in cross_polytope.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), tables=8, probes=6).collect()}
    live = [(i, np.array(v) / np.linalg.norm(v), lab) for i, v, lab in rows if v and lab is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: sum(1 for j, y, m in live if j != i and m == lab and x @ y >= 0.98) for i, x, lab in live}
    assert sum(got[i].n_links for i in links) >= 0.97 * sum(links.values()) and all(got[i].n_links <= n for i, n in links.items())
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in (201, 202, 203, 204, 206)) and got[200].n_links == links[200] and got[205].component_id == got[0].component_id


def test_cross_polytope_defaults(spark):
    """Recall with the tables and probes of the registered query."""
    for d in (16, 64):
        rnd = np.random.default_rng(d)
        base = rnd.normal(size=(80, d))
        x = np.concatenate([base, base + rnd.normal(size=base.shape) * 0.1, base + rnd.normal(size=base.shape) * 0.15])
        rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        links = (unit @ unit.T >= 0.98).sum(axis=1) - 1
        got = {r.vec_id: r.n_links for r in cross_polytope.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
        assert links.sum() >= 100 and all(got[i] <= n for i, n in enumerate(links))
        assert sum(got.values()) >= 0.97 * links.sum()


def test_phrases(docs):
    seen, want = set(), Counter()
    memo = {}
    for d, t in sorted({(r.doc_id if r.doc_id is not None else -(2**63), r.text or "") for r in docs.collect()}, key=lambda x: x[0]):
        raw = t.encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            w = raw[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        memo[d, t] = (len(raw), sum(gone), sum(gone[k] and not (k and gone[k - 1]) for k in range(len(gone))), hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest())
    for r in docs.collect():
        d = r.doc_id if r.doc_id is not None else -(2**63)
        want[(r.doc_id, *memo[d, r.text or ""])] += 1
    assert Counter(tuple(r) for r in phrase_parsing.dedup(docs).collect()) == want


def test_bpe(docs, spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import tiktoken

    ranks = bpe_words.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = ["  two  spaces ", "\nx", "a \n b", "it's 12 ok!!", "é́中\x1f x\x85", " ", "tail "]
    x = docs.unionByName(table(spark, [(500 + i, t, "s") for i, t in enumerate(odd)]))
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_words.encode(x, ranks, public_tokenizers.PATTERN).collect())
    want = Counter()
    for r in x.collect():
        ids = enc.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert got == want
    # blocks that end within a scan task
    small = bpe_words.encode(x, ranks, public_tokenizers.PATTERN, span=100)
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in small.collect()) == want
    back = bpe_words.decode(bpe_words.encode(x, ranks, public_tokenizers.PATTERN, ids=True), ranks)
    assert Counter((r.doc_id, bytes(r.decoded).decode()) for r in back.collect()) == Counter((r.doc_id, r.text or "") for r in x.collect())


def test_toxicity(spark):
    rnd = random.Random(2)
    text = lambda bad: ". ".join(" ".join(rnd.choice(["sun", "rain", "tree", "road", "cat"]) for _ in range(8)) + (" vileword" if bad and k == 1 else "") for k in range(4))
    rows = [(i, text(i % 3 == 0), "s") for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    x = table(spark, rows + [(900, None, "s"), (901, "", "s")])
    model = toxic_sentences.train(x, labels)
    got = {r.doc_id: r for r in toxic_sentences.score(x, model, locate=True).collect()}
    assert all(got[i].predicted == int(i % 3 == 0) for i in range(300)) and got[900].predicted == 0 and 0 <= got[901].score <= 1
    flag = got[0].flagged
    assert len(flag) == 1 and "vileword" in rows[0][1].lower()[flag[0].start : flag[0].start + flag[0].length]


def test_toxicity_of_long_texts(spark):
    """Toxic texts over 20,000 bytes are learned from, and no text is toxic by its length."""
    rnd = random.Random(6)
    text = lambda n, bad: ". ".join(" ".join(rnd.choice(["sun", "rain", "tree", "road", "cat"]) for _ in range(8)) + (" vileword" if bad and k == n // 2 else "") for k in range(n))
    rows = [(i, text(600 if i % 5 == 0 else 4, i % 5 == 0), "s") for i in range(150)]
    rows += [(1000 + i, text(600, False), "s") for i in range(20)]
    assert all(len(t) > 20_000 for i, t, _ in rows if i % 5 == 0 and i < 1000)
    labels = spark.createDataFrame([(i, int(i % 5 == 0 and i < 1000)) for i, _, _ in rows], "doc_id long, toxic int")
    x = table(spark, rows + [(2000, text(3000, False), "s"), (2001, text(4, True), "s"), (2002, text(2000, True), "s")])
    model = toxic_sentences.train(x, labels)
    got = {r.doc_id: r.predicted for r in toxic_sentences.score(x, model).collect()}
    assert all(got[i] == int(i % 5 == 0 and i < 1000) for i, _, _ in rows) and (got[2000], got[2001], got[2002]) == (0, 1, 1)
    # no labels of both kinds: below 0.5 at any length
    none = toxic_sentences.train(x, labels.where("toxic = 0"))
    assert all(r.score < 0.5 for r in toxic_sentences.score(x, none).collect())
    # a text longer than the bound does not empty the fit
    assert toxic_sentences.train(x, labels, max_bytes=100)[0] == {} and b"vileword" in toxic_sentences.train(x, labels, max_bytes=1 << 20)[0]


def test_pipeline(spark):
    import corpus_pipeline

    rnd = random.Random(9)
    good = lambda: "\n".join(" ".join(f"g{rnd.randint(0, 900)}" for _ in range(30)) for _ in range(4))
    rows = [(i, good(), "big" if i < 12 else "small") for i in range(16)]
    rows += [(50, rows[0][1], "big"), (51, "too short", "big"), (52, rows[1][1] + "\n" + good(), "big")]
    docs = table(spark, rows)
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert sorted(r.doc_id for r in docs.collect()) == list(range(16)) + [52]
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, "")
    assert {r.doc_id for r in mixed.collect()} == set(range(16)) | {52} and mixed.count() > 17
    assert corpus_pipeline.STAGES[4][1](spark, mixed, "").count() == mixed.count()


def test_pipeline_exact(spark, tmp_path):
    """run() as a whole against exact groups in Python, on pairs of similarity 0.5 to 0.95."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import tiktoken

    import corpus_pipeline

    rows = graded(random.Random(21), each=2)
    short = [(5000, "too short", "s"), (5001, None, "s")]
    copies = [(6000 + i, rows[i][1], "t") for i in (0, 5)]
    table(spark, rows + short + copies).write.parquet(f"{tmp_path}/documents.parquet")
    kept = {rows[g][0]: rows[g][1] for g in exact_groups([t for _, t, _ in rows])}
    assert len(rows) // 2 < len(kept) < len(rows)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ranks = bpe_words.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for d, t in kept.items():
        ids = enc.encode_ordinary(t)
        want[d] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in got} == want


def test_clashing_names(spark, docs):
    """Extra columns may have any name that does not start with two underscores."""
    names = ["d", "h", "gone", "pos", "run", "id", "fp", "key", "root", "component_id", "n", "u", "v", "block", "bucket", "kind", "slot", "shard", "n_words", "fail_bits", "copies", "label", "flagged"]
    x = docs.select("*", *[docs["n_chars"].alias(c) for c in names])
    assert line_suffixes.dedup(x).columns == [*x.columns, "__lines", "__removed", "__longest"] and line_suffixes.keep(x).columns == x.columns
    assert simhash_tiles.near_duplicates(x).count() == x.count() and simhash_tiles.keep_one(x).columns == x.columns
    assert quality_ledger.keep(x, "base").columns == x.columns and quality_ledger.ledger(x).count() == x.count()
    assert temperature_mix.realise(x).columns == x.columns
    assert context_tree.score(x).count() == phrase_parsing.dedup(x).count() == x.count()
    public_tokenizers = pytest.importorskip("public_tokenizers")
    assert bpe_words.encode(x, {bytes([b]): b for b in range(256)}, public_tokenizers.PATTERN).count() == x.count()
    assert toxic_sentences.score(x, ({}, -6.0, 1.0, 0.0), locate=True).count() == x.count()
    for key in ("slot", "shard", "doc_id"):
        assert slot_sharding.place(x, key, ["a", "b"], 251).count() == x.count()
    vectors = spark.createDataFrame([(1, [1.0, 0.0], 0, 5, 6), (2, [1.0, 0.0], 0, 5, 6)], "vec_id long, embedding array<double>, label int, id int, row int")
    assert [r.n_links for r in cross_polytope.near_duplicates(vectors).collect()] == [1, 1]


def test_very_long_texts(spark):
    """Texts of over 4 MB, with a passage in common."""
    import tiktoken
    import xxhash

    rnd = random.Random(31)
    words = [f"w{k}" for k in range(3000)]
    make = lambda n: " ".join(rnd.choices(words, k=n))
    first, passage = make(800_000), make(60_000)
    long = {1: first + "\n" + passage, 2: passage + "\n" + make(20), 3: "kurz"}
    x = table(spark, [(i, t, "s") for i, t in long.items()])
    assert len(long[1]) > 4 << 20
    got = {r.doc_id: r for r in phrase_parsing.dedup(x).collect()}
    assert got[1].n_removed == 0 and len(passage) <= got[2].n_removed <= len(passage) + 2 and got[2].n_spans == 1
    lines = {r.doc_id: r["__removed"] for r in line_suffixes.dedup(x).collect()}
    assert lines == {1: 0, 2: 1, 3: 0}
    led = {r.doc_id: r for r in quality_ledger.ledger(x).collect()}
    for i, t in long.items():
        w = t.split()
        grams = Counter(zip(w, w[1:], w[2:]))
        again = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
        assert (led[i].n_words, led[i].n_repeat_words) == (len(w), len(again))
    prints = {r.doc_id: r.fingerprint for r in simhash_tiles.near_duplicates(x).collect()}
    w = long[1].encode().split()
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(len(w) - 2)], np.uint64)
    assert prints[1] == f"{sum(1 << k for k in range(64) if 2 * int(((hashes >> np.uint64(k)) & np.uint64(1)).sum()) > len(hashes)):016x}"
    assert {r.doc_id: r.component_id for r in simhash_tiles.similar_groups(x).collect()} == {1: 1, 2: 2, 3: 3}
    assert {r.doc_id: r["__tokens"] for r in temperature_mix.plan(x).collect()} == {i: len(t.split()) for i, t in long.items()}
    ranks = {bytes([b]): b for b in range(256)} | {b"w1": 256}
    pattern = pytest.importorskip("public_tokenizers").PATTERN
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    coded = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in bpe_words.encode(x, ranks, pattern).collect()}
    assert coded == {i: (len(enc.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t in long.items()}
    scored = {r.doc_id: r for r in context_tree.score(x).collect()}
    assert scored[1].n_tokens == len(long[1].split()) + 1 and scored[1].score < scored[3].score < 0
    assert {r.doc_id: r.predicted for r in toxic_sentences.score(x, ({b"w7": 20.0}, -6.0, 1.0, 0.0)).collect()} == {1: 1, 2: 1, 3: 0}


def test_context_tree_scores(spark):
    """score, from the contexts of all depths, by the defining recursion."""
    import zlib
    from functools import cache
    from math import exp, lgamma, log, log10, pi

    rows = [(i, t, "s") for i, t in enumerate(["abra cadabra", "abracadabra", "Cad bra", "", None, "zebra abra", "abra abra cad", "xyz", "bracad"])]
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 1
    assert len({held(i) for i, _, _ in rows}) == 2
    padded = {i: b"\n" * 5 + b" ".join((t or "").lower().encode().split()) + b"\n" for i, t, _ in rows}
    events = [(raw[k - 5 : k], raw[k]) for i, raw in padded.items() if not held(i) for k in range(5, len(raw))]

    @cache
    def counts(context, k, prefix):
        bits = [(s >> (7 - k)) & 1 for c, s in events if c.endswith(context) and s >> (8 - k) == prefix]
        return len(bits) - sum(bits), sum(bits)

    def kt(a, b):
        return lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - log(pi)

    @cache
    def weighted(context, k, prefix):
        own = kt(*counts(context, k, prefix))
        if len(context) == 5:
            return own, 0.0
        children = {c[4 - len(context) :] for c, s in events if c.endswith(context)}
        return own, sum(np.logaddexp(log(0.5) + weighted(c, k, prefix)[0], log(0.5) + weighted(c, k, prefix)[1]) if len(c) < 5 else weighted(c, k, prefix)[0] for c in children)

    def score(raw):
        total = 0.0
        for at in range(5, len(raw)):
            for k in range(8):
                prefix, p, unseen = raw[at] >> (8 - k), None, True
                for depth in range(5, -1, -1):
                    context = raw[at - depth : at]
                    a, b = counts(context, k, prefix)
                    mine = (b + 0.5) / (a + b + 1)
                    own, below = weighted(context, k, prefix)
                    w = exp(own - np.logaddexp(own, below))
                    p = mine if depth == 5 or unseen else w * mine + (1 - w) * p
                    unseen = unseen and a + b == 0 if depth < 5 else a + b == 0
                total += log10(p if (raw[at] >> (7 - k)) & 1 else 1 - p)
        return total

    got = {r.doc_id: r.score for r in context_tree.score(table(spark, rows)).collect()}
    for i, raw in padded.items():
        assert got[i] == pytest.approx(score(raw), abs=1e-7), rows[i]


def test_blocks_of_fingerprints(spark, docs):
    """Groups cut into blocks give the groups that whole ones give."""
    prints = simhash_tiles.fingerprints(docs)
    rnd = random.Random(5)
    near = spark.createDataFrame([(1000 + i, sum(1 << b for b in rnd.sample(range(64), 2)) - (1 << 63)) for i in range(150)], "doc_id long, fp long")
    x = prints.unionByName(near)
    key = lambda r: (str(r.doc_id), r.fp, str(r.component_id))
    whole, cut = (sorted(map(key, simhash_tiles.group(x, 2, block).collect())) for block in (4096, 7))
    assert whole == cut and len({k[2] for k in whole if int(k[0]) >= 1000} if "None" not in {k[0] for k in whole} else {k[2] for k in whole if k[0] != "None" and int(k[0]) >= 1000}) < 150


def test_hot_components(spark):
    """A hub, a long chain and many pairs."""
    from cadenza.llm.common import components

    pairs = [(0, k) for k in range(1, 3000)] + [(10_000 + k, 10_001 + k) for k in range(200)] + [(20_000 + 2 * k, 20_001 + 2 * k) for k in range(500)]
    random.Random(1).shuffle(pairs)
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "u long, v long").repartition(7)).collect()))
    assert all(got[k] == 0 for k in range(3000)) and all(got[10_000 + k] == 10_000 for k in range(201)) and all(got[20_001 + 2 * k] == 20_000 + 2 * k for k in range(500))


def test_sharding_fill():
    """The table filled by plain turns over written-out permutations."""
    shards, size = ["x", "y", "z"], 31
    order = []
    for s in shards:
        d = hashlib.sha256(s.encode()).digest()
        offset, stride = int.from_bytes(d[:8], "big") % size, int.from_bytes(d[8:16], "big") % (size - 1) + 1
        order.append([(offset + k * stride) % size for k in range(size)])
    taken: dict[int, int] = {}
    turn = 0
    while len(taken) < size:
        taken[next(slot for slot in order[turn % 3] if slot not in taken)] = turn % 3
        turn += 1
    assert slot_sharding.lookup(shards, size) == [taken[k] for k in range(size)]


def test_noisy_or(spark):
    """Scores and flagged sentences against a plain noisy-or, ties and repeated rows among them."""
    from math import exp, log

    model = ({b"bad": 5.0, b"^wors": 3.0}, -4.0, 1.5, 0.25)
    texts = ["bad day. good day", "worst thing\nworse bad thing! fine", "all good", "", None, "bad day. good day", "Bad! bad! BAD?"]
    x = table(spark, [(i if i != 5 else 0, t, "s") for i, t in enumerate(texts)])
    rows = sorted(toxic_sentences.score(x, model, locate=True).collect(), key=lambda r: (r.doc_id, r.score))
    for r in rows:
        t = texts[r.doc_id] or ""
        sents = [s for s in __import__("re").split(r"[.!?]+\s+|\n+", t.lower()) if s.strip()] or [""]
        z = []
        for s in sents:
            w = [k.strip(".,;:!?") for k in s.split()]
            z.append(-4.0 - 1.5 * log(len(sents)) + sum(5.0 * (k == "bad") + 3.0 * (k.startswith("wors") and len(k) > 4) for k in w))
        none = 1.0
        for v in z:
            none *= 1 - 1 / (1 + exp(-v))
        want = 1 / (1 + exp(-(log((1 - none) / none) - 0.25)))
        assert r.score == pytest.approx(want, rel=1e-9) and len(r.flagged) == r.n_flagged == sum(v > 0.25 for v in z)
        assert all("bad" in t.lower()[f.start : f.start + f.length] or "wors" in t.lower()[f.start : f.start + f.length] for f in r.flagged)
    assert len(rows) == len(texts) and len({r.score for r in rows if r.doc_id == 0}) == 1


def test_mixing_ties_and_null_sources(spark):
    rows = [(1, "a b c", None), (1, "a b c", None), (None, "a b", None), (2, "", "s"), (3, None, "s"), (4, "x " * 50, "s")]
    got = temperature_mix.plan(table(spark, rows), repeats=2.0, block_tokens=3).collect()
    assert len(got) == 6 and len({r.copies for r in got if r.doc_id == 1}) == 1 and min(r.copies for r in got) >= 1
    # any number of blocks: a budget below one pass is met to the token
    many = temperature_mix.plan(table(spark, [(i, "t", "s") for i in range(6000)]), entropy=0.0, budget=2500, block_tokens=1).collect()
    assert sum(r.copies for r in many) == 2500 and len({r["__block"] for r in many}) > 3500
    assert temperature_mix.realise(table(spark, [(i, "t", None) for i in range(60)]), entropy=0.0, budget=25, block_tokens=4).count() == 25


def test_empty_pipeline(spark, empty, tmp_path):
    import corpus_pipeline

    from cadenza.llm.common import _made

    empty.write.parquet(f"{tmp_path}/documents.parquet")
    before = len(_made(spark))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.count() == 0 and "ids" in got.columns and len(_made(spark)) == before


def test_sql_of_runs_vectors_and_strings(spark, tmp_path):
    """The registered SQL of op2, op6 and op7 on planted runs, links and strings."""
    duckdb = pytest.importorskip("duckdb")
    from cadenza.llm import queries

    rnd = random.Random(41)
    line = lambda: " ".join(f"w{rnd.randrange(500)}é" for _ in range(rnd.choice([0, 1, 6, 25])))
    shared = [[line() for _ in range(rnd.choice([2, 9]))] for _ in range(6)]
    texts = ["\n".join(x for part in rnd.choices(shared, k=rnd.randrange(3)) + [[line()], [line(), ""]] for x in part) for _ in range(80)]
    texts += [texts[3], texts[3] + "\n" + texts[3], "ab" * 300, "", None]
    table(spark, [(i, t, "s") for i, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    gen = np.random.default_rng(41)
    base = gen.normal(size=(20, 16)).astype("float32")
    near = [(base[i % 20] + (i % 3) * 0.04 * gen.normal(size=16)).astype("float32").tolist() for i in range(120)]
    rows = [(1000 - i, v, i % 20 if i % 7 else None) for i, v in enumerate(near)] + [(1, [0.0] * 16, 1), (2, None, 1), (3, [float("nan")] + [1.0] * 15, 1), (4, [], 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    for name in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for name, told in (("op2_line_suffixes", "n_removed"), ("op6_cross_polytope", "n_links"), ("op7_phrase_parsing", "n_removed")):
        got = queries.QUERIES[name](spark, str(tmp_path))
        found = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES[name]})").fetchall()
        assert sorted(map(tuple, got.collect())) == sorted(found), name
        assert sum(r[got.columns.index(told)] for r in found) > 100, name


def test_pipeline_cuts_texts_once(docs, spark, tmp_path):
    """The pipeline's encoding reads its input in one scan, and gives what two scans give."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    x = docs.unionByName(table(spark, [(500 + i, t, "s") for i, t in enumerate(["  two  spaces ", "\nx", "a \n b", " ", "é\x1f x"])]))
    x.write.parquet(f"{tmp_path}/documents.parquet")
    source = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.encode(spark, source, str(tmp_path))
    assert not [f for f in got.inputFiles() if "documents.parquet" in f]
    rows = lambda df: Counter((r.doc_id, r.ids_sha256, r.decoded_sha256, r.n_bytes, tuple(r.ids)) for r in df.collect())
    ranks = bpe_words.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    two = rows(bpe_words.encode(x, ranks, public_tokenizers.PATTERN, ids=True))
    assert rows(got) == two and sum(two.values()) == x.count()
    assert rows(bpe_words.encode(source, ranks, public_tokenizers.PATTERN, ids=True, span=100, once=True)) == two


def test_bit_counts_and_shingles():
    """Bits counted eight at a time over long runs, and shingles cut from the joined words, by their definitions."""
    import xxhash

    gen = np.random.default_rng(8)
    sizes = np.array([1, 254, 255, 256, 510, 511, 70_000, 2])
    parts = [gen.integers(0, 2**64, n, np.uint64) for n in sizes]
    parts[4][:] = 2**64 - 1
    parts[6][:40_000] |= np.uint64(1 << 63)
    bits = lambda p: np.unpackbits(p.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    assert (simhash_tiles._ones(np.concatenate(parts), sizes) == np.stack([bits(p) for p in parts])).all()
    for raw in [b"", b" \n", b"One", b"a b  C\td", b"a b c d E", b"a b c d e f", "é a b c d é a b c d é".encode()]:
        words = raw.lower().split()
        want = {xxhash.xxh64_intdigest(b" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4) if words else 0)}
        got = simhash_tiles.shingles(raw, 5)
        assert got.dtype == np.uint64 and got.tolist() == sorted(want)


def test_frequent_trigger_is_sorted_in_pieces():
    """One trigger with 4 MB of distinct phrases: right windows, and memory of a few times the phrases."""
    import tracemalloc

    import pyarrow as pa

    from cadenza.llm.common import pack, unpack

    m, gen = 30_000, np.random.default_rng(12)
    letters = lambda *shape: gen.integers(97, 123, shape).astype(np.uint8)
    sides = letters(40, 51), letters(3000, 51)
    text = np.concatenate([sides[0][gen.integers(0, 40, m)], np.repeat(letters(1, 32), m, 0), sides[1][gen.integers(0, 3000, m)]], axis=1)
    text[::2, 100:] = letters(m // 2, 34)
    ids, at, none = gen.permutation(m).astype(np.int64), gen.integers(0, 99, m), np.zeros(m, np.uint64)
    payload = pack(none + np.uint64(7 << 20), ids, none, at, np.full(m, 35), text.reshape(-1))
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([3], pa.int32()), pa.array([payload], pa.binary())], names=["bucket", "kind", "payload"])
    tracemalloc.start()
    rows = [payload for _, _, payload in phrase_parsing._later([batch], 3, 100)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = Counter((int(i), int(a)) for row in rows for i, a in zip(*(unpack(row)[k] for k in (0, 2))))
    first, want = {}, Counter()
    for k in np.argsort(ids).tolist():
        raw = text[k].tobytes()
        for o in range(35):
            if first.setdefault(raw[o : o + 100], (k, o)) != (k, o):
                want[int(ids[k]), int(at[k]) + o] += 1
    assert got == want and sum(want.values()) > 30_000
    assert peak < 45 * text.size

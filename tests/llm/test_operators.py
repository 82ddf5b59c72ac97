import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann, common, decontaminate, lm_score, minhash, mixing, pii, quality, sharding, substring, warc
from tessera.llm.common import materialize, running_base
from tessera.llm.graph import connected_components

from . import brute

DOC = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = [a + b for a in ("ba", "ne", "ti", "lo", "mur", "sel", "dra", "ko") for b in ("", "na", "li", "to", "rem", "sa", "vi", "gu")]


def prose(r, n):
    return " ".join(r.choice(VOCAB) for _ in range(n))


def edited(r, text, n):
    w = text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = r.choice(VOCAB) + "x"
    return " ".join(w)


def docs_frame(spark, texts, extra=True):
    """(id, text) with clashing extra columns, null language and sources."""
    rows = [(d, t, None, None if d is None or d % 5 == 0 else f"s{d % 3}", None) for d, t in texts]
    df = spark.createDataFrame(rows, DOC)
    return df.withColumns({c: F.lit("clash") for c in ("id", "t", "h", "tile", "rid", "size", "n", "key")}) if extra else df


@pytest.fixture(scope="module")
def corpus():
    """Exact and near copies, shared passages, short, empty, null and very long texts."""
    r = random.Random(7)
    base = [prose(r, r.randrange(60, 200)) for _ in range(30)]
    passage = prose(r, 80)
    out = [*base, base[0], base[0], base[1].upper(), "", None, "one", "one two", " \n\t", "two one", prose(r, 20_000)]
    out += [edited(r, base[2], n) for n in (1, 2, 3, 5, 8, 13, 21)] + [edited(r, base[3], 2) for _ in range(12)]
    out += [f"{prose(r, 30)} {passage} {prose(r, 40)}" for _ in range(8)] + [base[4] + "\n" + base[5], base[5] + " " + base[4][:200]]
    ids = list(range(len(out)))
    r.shuffle(ids)
    return list(zip(ids, out, strict=True))


@pytest.mark.parametrize("group", [[], ["g"]])
def test_running_base(spark, group):
    r = random.Random(3)
    rows = [(g, t, r.randrange(9)) for g in (("a", "b", None) if group else (None,)) for t in r.sample(range(90), 40)]
    got = running_base(spark.createDataFrame(rows, "g string, tile long, n long"), group, "tile", "n", "base", per_block=8).collect()
    assert {(x["g"], x["tile"], x["n"], x["base"]) for x in got} == {(g, t, n, sum(m for h, u, m in rows if h == g and u < t)) for g, t, n in rows}
    assert len(got) == len(rows)


def test_shards_are_even_and_mixed(spark, corpus):
    df = docs_frame(spark, corpus * 8)
    got = sharding.stratified_shards(df, 7, rows_per_tile=16).collect()
    assert len(got) == len(corpus) * 8 and set(df.columns) < set(got[0].asDict())
    shards = brute.group((r["shard"], r["slot"]) for r in got)
    assert sorted(shards) == list(range(7)) and all(sorted(v) == list(range(len(v))) for v in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    for counts in brute.group((r["source"], r["shard"]) for r in got).values():
        assert max(counts.count(k) for k in range(7)) - min(counts.count(k) for k in range(7)) <= 2
    again = sharding.stratified_shards(df.repartition(3), 7, rows_per_tile=16)
    key = lambda rows: sorted((str(r["doc_id"]), r["shard"], r["slot"]) for r in rows)
    assert [x[1:] for x in key(again.collect())] == [x[1:] for x in key(got)]


def test_shards_of_nothing_and_of_nulls(spark):
    assert sharding.stratified_shards(docs_frame(spark, []), 3).count() == 0
    got = sharding.stratified_shards(docs_frame(spark, [(None, None), (None, None), (1, "a"), (1, "a")]), 3).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(0, 0), (0, 1), (1, 0), (2, 0)]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 100, 5], [0, 7], [1000, 1, 1, 1, 1, 1]])
def test_water_filling(spark, sizes):
    df = spark.createDataFrame([(i, s, i % 3 + 1) for i, s in enumerate(sizes)], "sid int, size long, weight int")
    got = {r["sid"]: r["target"] for r in mixing.water_fill(df, 3.0).collect()}
    want = brute.targets(dict(enumerate(sizes)), {i: i % 3 + 1 for i in range(len(sizes))})
    assert got == pytest.approx(want)


def test_mixture(spark, corpus):
    texts = corpus + corpus[:3] + [(None, "a b c"), (None, "a b c"), (None, None)]
    df = docs_frame(spark, texts)
    mix = mixing.mix_sources(df, block_words=8, slots_per_shard=32, rows_per_tile=8)
    rows = mix.taken().collect()
    assert len(rows) == df.count() and sorted(r["size"] for r in rows) == sorted(len(brute.WORD.findall(t or "")) for _, t in texts)
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    sources = {r["sid"]: r for r in mix.sources.collect()}
    assert [sources[i]["src"] for i in range(len(sources))] == sorted({r["source"] for r in df.select("source").collect() if r["source"]}) + [None]
    want = brute.targets({i: r["size"] for i, r in sources.items()}, {i: i % 3 + 1 for i in sources})
    assert {i: r["target"] for i, r in sources.items()} == pytest.approx(want)
    taken = {s: sum(v) for s, v in brute.group((r["sid"], r["taken"]) for r in rows).items()}
    for s, r in sources.items():
        assert abs(taken[s] - r["target"]) <= 16
    slots = mix.slots.collect()
    by_shard = brute.group((r["shard"], r["slot"]) for r in slots)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values()) and all(len(v) == 32 for k, v in by_shard.items() if k < max(by_shard))
    # a source's passes use each block once: copies differ by one at most
    used = brute.group(((r["sid"], r["block"]), 1) for r in slots)
    for s, copies in brute.group((k[0], len(v)) for k, v in used.items()).items():
        assert max(copies) - (min(copies) if len(copies) == sources[s]["blocks"] else 0) <= 1 and sum(copies) == sources[s]["quota"]
    # what each row gives, from the blocks by hand: rows in the order of their hash, one stream for each source
    for s in sources:
        at = 0
        for r in sorted((r for r in rows if r["sid"] == s), key=lambda r: (r["h"], r["id"] is not None, r["id"] or 0, r["rid"])):
            assert r["taken"] == sum(len(used.get((s, w // 8), [])) for w in range(at, at + r["size"]))
            at += r["size"]
    plain = lambda rows: sorted((str(r["id"]), r["size"], r["taken"]) for r in rows)
    assert plain(rows) == plain(mixing.mix_sources(df.repartition(5), block_words=8, slots_per_shard=32, rows_per_tile=8).taken().collect())


def test_mixture_draws_at_random(spark):
    """Permutations are whole, and shards' counts scatter as a draw without replacement does."""
    for n in (1, 2, 3, 100, 1000):
        got = [r[0] for r in spark.range(n).select(F.expr(mixing.permuted("id", f"{n}L", mixing.fixed_keys("t", n)))).collect()]
        keyed = spark.range(n).select("id", F.lit(n).cast("long").alias("n")).withColumn("keys", mixing.keys_of(F.lit("t"), "n"))
        assert sorted(got) == list(range(n)) and got == [r[0] for r in keyed.select(F.expr(mixing.permuted("id", "n", "keys"))).collect()]
    n, rows = 40_000, 100
    got = np.array([r[0] for r in spark.range(n).select(F.expr(mixing.permuted("id", f"{n}L", mixing.fixed_keys("u", n)))).collect()])
    hits = (got < n // 4).reshape(rows, -1).sum(1)
    want = n / rows * 0.25 * 0.75
    assert 0.6 * want < hits.var() < 1.5 * want and abs(np.corrcoef(got[1:], got[:-1])[0, 1]) < 0.02
    assert np.bincount((got[1:] - got[:-1]) % n).max() <= 12


def test_mixture_of_many_sources(spark):
    """100,000 sources of one row, beside one that holds a third of all rows."""
    one = spark.range(100_000).select("id", F.concat(F.lit("s"), F.col("id")).alias("source"))
    df = one.unionAll(spark.range(100_000, 150_000).select("id", F.lit("hot"))).select(F.col("id").alias("doc_id"), "source", F.lit("a b c d e").alias("text"))
    mix = mixing.mix_sources(df, block_words=4, slots_per_shard=1024)
    got = mix.taken().join(mix.sources.select("sid", "target", F.col("size").alias("all")), "sid")
    by = got.groupBy("sid", "target", "all").agg(F.sum("taken").alias("taken"), F.max(F.col("taken") / F.col("size")).alias("most"))
    far = by.select(F.count("*").alias("n"), F.sum("target").alias("target"), F.sum("all").alias("all"), F.max(F.abs(F.col("taken") - F.col("target"))).alias("off"), F.max("most").alias("most")).first()
    assert far["n"] == 100_001 and far["target"] == pytest.approx(far["all"]) == 750_000 and far["off"] <= 8 and far["most"] <= 3
    assert mix.sources.agg(F.sum("quota")).first()[0] == mix.slots.count()


def test_mixture_block_texts(spark):
    df = docs_frame(spark, [(1, "a b c d e"), (2, "f g h"), (3, None), (4, "i j k l")], extra=False).withColumn("source", F.lit("s"))
    mix = mixing.mix_sources(df, block_words=4, slots_per_shard=2, keep=["text"])
    texts = sorted(r["text"] for r in mix.block_texts().collect())
    assert sorted(" ".join(texts).split()) == list("abcdefghijkl") and all(len(t.split()) == 4 for t in texts)
    assert mixing.mix_sources(docs_frame(spark, [])).taken().count() == 0
    assert mixing.mixed_documents(docs_frame(spark, [(1, None)], extra=False)).count() == 0


def test_mixed_rows_with_null_and_repeated_ids(spark):
    """One source: every row with words is taken once, whatever its id and other columns."""
    rows = [(None, "a b c"), (None, "a b c"), (None, "d e"), (3, "x y"), (3, "x y"), (3, "z"), (4, None), (5, "")]
    df = docs_frame(spark, rows).withColumn("source", F.lit("s")).withColumns({c: F.lit("clash") for c in ("copies", "row", "taken", "mix_id")})
    out = mixing.mixed_documents(df, block_words=1)
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in out.collect()))) == sorted(map(str, rows[:6])) and out.columns == df.columns


@pytest.mark.parametrize(("k", "num"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, corpus, k, num):
    want = brute.components(corpus, k, num, 100)
    got = minhash.near_duplicates(docs_frame(spark, corpus), shingle_words=k, num=num).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_in_tiles(spark, monkeypatch):
    r = random.Random(5)
    base = prose(r, 150)
    texts = [(i, edited(r, base, r.randrange(1, 12))) for i in range(120)]
    monkeypatch.setattr(minhash, "TILE", 16)
    got = minhash.near_duplicates(docs_frame(spark, texts), shingle_words=3, num=85).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got} == brute.components(texts, 3, 85, 100)


@pytest.mark.parametrize("tile", [2, 8, 64])
def test_near_duplicates_across_components(spark, monkeypatch, tile):
    """A family of a large group, chains whose ends aren't alike, and texts that only share candidates."""
    r = random.Random(11)
    base = prose(r, 200)
    texts = [edited(r, base, 1) for _ in range(60)] + [edited(r, base, r.randrange(8, 30)) for _ in range(30)]
    for _ in range(3):
        step = edited(r, base, 12)
        for _ in range(12):
            step = edited(r, step, 4)
            texts.append(step)
    ids = list(range(len(texts)))
    r.shuffle(ids)
    rows = list(zip(ids, texts, strict=True))
    monkeypatch.setattr(minhash, "TILE", tile)
    met = []
    plain = minhash._apart
    monkeypatch.setattr(minhash, "_apart", lambda *a: met.append(plain(*a)) or met[-1])
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in minhash.near_duplicates(docs_frame(spark, rows), shingle_words=3, num=85).collect()}
    assert got == brute.components(rows, 3, 85, 100) and len({c for _, c in got.values()}) > 3
    # tiles meet both ways, and never those of their own component
    at = met[0].collect()
    assert {(x["family"], x["tile"], o) for x in at for o in x["others"]} >= {(x["family"], o, x["tile"]) for x in at for o in x["others"] if any(y["tile"] == o for y in at)}


def test_near_duplicates_of_nulls_and_repeats(spark):
    rows = [(None, "a b c"), (None, None), (3, "a b c"), (3, "a b c"), (7, "A B C"), (9, None)]
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs_frame(spark, rows), shingle_words=3, num=85).collect())
    assert got == [("3", 1, 3, True), ("3", 1, 3, True), ("7", 1, 3, False), ("9", 0, 9, True), ("None", 0, None, True), ("None", 1, None, True)]
    assert minhash.near_duplicates(docs_frame(spark, [])).count() == 0


def test_bayes_bounds():
    for t in (0.8, 0.85):
        bands, rows = minhash.choose_bands(t)
        assert bands <= 64 and minhash.miss_chance(t, bands, rows) <= 1e-6
    least = minhash.fewest_matches(0.85, 1e-6)
    assert least == sorted(least) and least[-1] < 0.85 * minhash.HASHES
    # the posterior just under the bound is below the miss probability, by simulation of its upper tail
    m, n = least[0] - 1, minhash.BATCH
    assert (np.random.default_rng(0).beta(m + 1, n - m + 1, 200_000) >= 0.85).mean() < 1e-4


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    got = {x["id"]: x["root"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}


@pytest.mark.parametrize("block", [3 << 20, 2000])
def test_substring_factors(spark, corpus, monkeypatch, block):
    monkeypatch.setattr(substring, "BLOCK_BYTES", block)
    want = brute.removed(corpus)
    got = substring.factor_documents(docs_frame(spark, corpus)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == want
    words = {d: brute.WORD.findall(t or "") for d, t in corpus}
    for r in got:
        for f in r["factors"]:
            a, b, n = words[r["doc_id"]][f["start"] :], words[f["ref_id"]][f["ref_start"] :], f["n_words"]
            # each factor is a copy that can't be made longer at its place
            assert n >= 50 and f["ref_id"] < r["doc_id"] and a[:n] == b[:n] and (len(a) == n or len(b) == n or a[n] != b[n])


def test_parse_is_greedy(monkeypatch):
    """Factors against a plain parser that tries every place of every reference, also where all hashes collide."""
    r = random.Random(4)
    texts = [" ".join(r.choice("ab") for _ in range(r.randrange(4, 60))) for _ in range(30)]
    texts += [texts[3] + " " + texts[9] + " b " + texts[9], "", "a"]
    ids = np.array(r.sample(range(100), len(texts)))
    is_ref = np.array([i % 2 == 0 for i in range(len(texts))])
    want = {}
    for i, t in enumerate(texts):
        w, s = t.split(), 0
        while not is_ref[i] and s + 6 <= len(w):
            best = (0, 0, 0)
            for j in sorted(np.flatnonzero(is_ref), key=lambda j: ids[j]):
                v = texts[j].split()
                for p in range(len(v) if ids[j] < ids[i] else 0):
                    n = 0
                    while s + n < len(w) and p + n < len(v) and w[s + n] == v[p + n]:
                        n += 1
                    best = max(best, (n, -int(ids[j]), -p))
            if best[0] >= 6:
                want.setdefault(i, []).append((s, best[0], -best[1], -best[2]))
                s += best[0] - 6
            s += 1
    raw = "".join(texts).encode()
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for weak in (False, True):
        if weak:
            monkeypatch.setattr(common, "word_hashes", lambda data, start, end: np.ones(len(start), np.uint64))
        assert substring.parse(common.Words(np.frombuffer(raw, np.uint8), off), ids, is_ref, 6) == want


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_unlike_words_are_never_equal(spark):
    """Two words that collide under every polynomial hash modulo 2 ** 64."""
    one = thue_morse(1024)
    two = one.translate(str.maketrans("ab", "ba"))
    rest = prose(random.Random(8), 49)
    got = {r["doc_id"]: r["n_removed"] for r in substring.factor_documents(docs_frame(spark, [(1, f"{one} {rest}"), (2, f"{two} {rest}")])).collect()}
    assert got == {1: 0, 2: 0}
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_frame(spark, [(1, one), (2, two)]), shingle_words=3, num=85).collect()}
    assert got == {1: 1, 2: 2}


def test_substring_edges(spark):
    r = random.Random(1)
    t = prose(r, 49)
    rows = [(1, t), (2, t), (3, t + " z"), (3, t + " z"), (4, t + " z"), (None, t + " z"), (5, None), (6, "")]
    got = sorted((str(x["doc_id"]), x["n_words"], x["n_removed"]) for x in substring.factor_documents(docs_frame(spark, rows)).collect())
    assert got == [("1", 49, 0), ("2", 49, 0), ("3", 50, 0), ("3", 50, 0), ("4", 50, 50), ("5", 0, 0), ("6", 0, 0), ("None", 50, 0)]
    assert substring.factor_documents(docs_frame(spark, [])).count() == 0


PII = [
    "mail a.b@c-d.org, x@y.zz_q@r.ss; a@b a@b.c.", "ip 1.2.3.4.5.6.7.8 and 256.1.1.1, 0010.0.0.1 v1.2.3", "card 4465758382889437 4465-7583-8288-9437 4465758382889438 12 34",
    "call +1 (743) 555-3824 or +44.20.7946.0958 +1 2", "é😀 +1 (743) 555-3824 190.1 x@é.de ü@a.de", "a" * 5000 + "@b." + "c" * 3000, "1" * 4000, "", None, "+" * 50 + "1 2",
    "(743) 555-3824 and name [at] host [dot] org", "4465 7583 8288 9437 " * 40, "9.9.9.9" * 30, "no data here",
]


def test_personal_data(spark):
    texts = list(enumerate(PII * 4))
    rows, spans = pii.find_personal_data(docs_frame(spark, texts))
    found = brute.group((r["rid"], (pii.KINDS[r["kind"]], r["start"], r["end"])) for r in spans.where("base").collect())
    order = {k: i for i, k in enumerate(pii.KINDS)}
    for r in rows.collect():
        assert sorted(found.get(r["rid"], []), key=lambda s: (order[s[0]], s[1])) == brute.base_spans(texts[r["id"]][1]), texts[r["id"]][1]
    assert pii.find_personal_data(docs_frame(spark, []))[1].count() == 0


def test_personal_data_in_very_long_texts(spark):
    """One text may hold a domain of very many parts, very many spans, or endless digits."""
    # counts are known by construction: the plain patterns would need the square of a text without an @
    texts = ["x@a" + ".b" * 60_000, "x(at)a" + ".b" * 60_000, "1.2.3.4." * 20_000, "7" * 200_000 + " 1" * 50_000, "+1" + " 2" * 50_000, "a@b.c_" * 10_000]
    rows, spans = pii.find_personal_data(docs_frame(spark, list(enumerate(texts))))
    found = spans.where("base").join(rows, "rid").groupBy("id", "kind").agg(F.count(F.lit(1)).alias("n"), F.max("end").alias("end")).collect()
    assert sorted(tuple(r) for r in found) == [(0, 0, 1, 120_003), (2, 1, 20_000, 159_999), (5, 0, 10_000, 59_999)]


@pytest.mark.parametrize("free", [3, 60, 300])
def test_personal_data_learns_formats(spark, free):
    """What the base misses is added whether it is rare or as common as the base; look-alikes that fail their check are not."""
    r = random.Random(0)
    local = lambda: f"({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}"

    def card(good):
        digits = [r.randrange(10) for _ in range(15)]
        total = sum(d if i % 2 else (d * 2 if d < 5 else d * 2 - 9) for i, d in enumerate(digits))
        digits.append((-total + (0 if good else 3)) % 10)
        return ".".join("".join(map(str, digits[i : i + 4])) for i in range(0, 16, 4))

    name = lambda: r.choice(VOCAB)
    planted = {"base": lambda: r.choice([f"+1 {local()}", f"{name()}.{name()}@{name()}.org"]), "phone": local, "email": lambda: f"{name()} [at] {name()}.org"}
    planted |= {"card": lambda: card(True), "no card": lambda: card(False).replace(".", r.choice(". ")), "date": lambda: f"2021-{r.randrange(10, 13)}-{r.randrange(10, 29)}"}
    texts, kinds = [], {}
    for what, n in (("base", 300), ("phone", free), ("email", free), ("card", free), ("no card", 100), ("date", 200)):
        for _ in range(n):
            kinds[len(texts)] = what
            texts.append((len(texts), f"{prose(r, 10)} {r.choice(['tel', 'see', 'mail', 'and'])} {planted[what]()} {prose(r, 10)}"))
    rows, spans = pii.find_personal_data(docs_frame(spark, texts))
    found = brute.group((kinds[x["id"]], (x["base"], x["kind"])) for x in spans.join(rows, "rid").collect())
    assert set(found["base"]) <= {(True, 0), (True, 3)} and len(found["base"]) == 300
    assert found["phone"] == [(False, 3)] * free and found["email"] == [(False, 0)] * free and found["card"] == [(False, 2)] * free
    assert "no card" not in found and "date" not in found


def test_trees_and_calibration():
    patterns = [(c, 50, 45 if c & 1 and c & 4 else 2) for c in range(8)]
    trees = pii.fit_trees(patterns, 3)
    assert min(trees.score(c) for c in (5, 7)) > max(trees.score(c) for c in (0, 1, 2, 3, 4, 6))
    assert pii.calibrated_bar([(trees.score(c), n, p) for c, n, p in patterns], 0.8, 10) == min(trees.score(5), trees.score(7))
    assert pii.calibrated_bar([(0.0, 5, 5)], 0.8, 10) == float("inf")


def test_redaction(spark):
    df = docs_frame(spark, [(1, "é a@b.cc, +1 (743) 555-3824!"), (2, "none"), (3, None)], extra=False)
    rows, spans = pii.find_personal_data(df)
    named = spans.join(rows.withColumnRenamed("id", "doc_id"), "rid")
    df = df.withColumns({c: F.lit("clash") for c in ("s", "start", "e", "kind", "a", "x")})
    assert {r["doc_id"]: r["text"] for r in pii.redact(df, named).collect()} == {1: "é [email], [phone]!", 2: "none", 3: None}


def page_frame(spark, pages):
    return spark.createDataFrame(pages, "page_id long, url string, html string")


def test_warc_round_trip(spark, tmp_path):
    long = "".join(random.Random(3).choice("aé\n <😀") for _ in range(30_000))
    pages = [(1, "http://a/", "x"), (2, "http://b/", "x"), (3, None, None), (4, "u", ""), (5, "u", long), (6, "u\r\nX: y", long), (7, "u", "WARC/1.1\r\n\r\n0\r\n\r\n"), (8, "v", "x" * 2048)]
    path = warc.write_warc(page_frame(spark, pages).withColumn("body", F.lit("clash")), str(tmp_path / "w"), segment_chars=1000, chunk_chars=300)
    assert list((tmp_path / "w").glob("*.gz"))
    got = {r["page_id"]: r for r in warc.read_warc(spark, path).collect()}
    assert {k: r["record_type"] for k, r in got.items()} == {1: "response", 2: "revisit", 3: "response", 4: "revisit", 5: "response", 6: "revisit", 7: "response", 8: "response"}
    for k, _, html in pages:
        assert got[k]["problem"] is None
        if got[k]["record_type"] == "response":
            assert bytes(got[k]["payload"]).decode() == (html or "")
    assert got[2]["refers_to_id"] == got[1]["record_id"]
    few = warc.write_warc(page_frame(spark, pages), str(tmp_path / "m"), min_bytes=2)
    assert sorted(r["page_id"] for r in warc.read_warc(spark, few).where("record_type = 'revisit'").collect()) == [6]


def test_warc_segments_in_any_file_and_broken_ones(spark, tmp_path):
    pages = page_frame(spark, [(1, "u", "a" * 5000), (2, "v", "b" * 5000)])
    records = warc.warc_records(pages, 0, 700, 300, "2024-01-01T00:00:00Z")
    records.repartition(5).write.option("lineSep", warc.RECORD_END).option("compression", "gzip").text(str(tmp_path / "s"))
    assert sorted(bytes(r["payload"]).decode()[:1] for r in warc.read_warc(spark, str(tmp_path / "s")).collect()) == ["a", "b"]
    records.where(~(F.col("value").contains("WARC-Segment-Number: 3") & F.col("value").contains("bbb"))).write.option("lineSep", warc.RECORD_END).option("compression", "gzip").text(str(tmp_path / "t"))
    assert sorted((r["page_id"], r["problem"]) for r in warc.read_warc(spark, str(tmp_path / "t")).collect()) == [(1, None), (2, "segments are missing")]
    with pytest.raises(ValueError):
        list(warc.parse_warc(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))
    with pytest.raises(ValueError):
        warc.decode_chunked(b"5\r\nab")
    assert warc.decode_chunked(b"3;x=y\r\nabc\r\n0\r\nT: 1\r\n\r\n") == b"abc"


def test_warc_query_digests(spark, tmp_path):
    pages = page_frame(spark, [(9, "a", "same"), (4, "b", "same"), (5, "c", None), (6, "d", "é")])
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r for r in warc.op3_warc(spark, str(tmp_path)).collect()}
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    assert (got[9]["record_type"], got[9]["refers_to"], got[9]["payload_bytes"], got[9]["payload_digest"]) == ("revisit", 4, 4, digest("same"))
    assert (got[5]["payload_bytes"], got[5]["payload_digest"], got[6]["payload_bytes"]) == (0, digest(""), 2)
    page_frame(spark, []).write.parquet(str(tmp_path / "none/pages.parquet"))
    assert warc.op3_warc(spark, str(tmp_path / "none")).count() == 0


def test_warc_query_on_repeated_ids(spark, tmp_path):
    """Equal and different payloads under equal ids, short and segmented, against a plain version."""
    long = ["a" * 30_000, "b" * 20_000, "é" * 9_000]
    rows = [(1, "u", long[0]), (1, "u", long[1]), (2, "u", long[1]), (2, "u", long[1]), (2, "v", long[2]), (1, "w", long[2]), (1, "x", long[2])]
    rows += [(3, "u", "x"), (3, "u", "y"), (4, "u", "y"), (4, "u", "y"), (4, None, "z"), (4, None, "z"), (None, "u", "x"), (None, "u", "q"), (None, "w", "q"), (9, "u", None), (9, "u", "")]
    page_frame(spark, rows).write.parquet(str(tmp_path / "pages.parquet"))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")
    got = sorted(str(tuple(r[c] for c in columns)) for r in warc.op3_warc(spark, str(tmp_path)).collect())
    first = {t or "": min((i for i, _, x in rows if (x or "") == (t or "") and i is not None), default=None) for _, _, t in rows}
    want = []
    for i, _, t in rows:
        raw, lead = (t or "").encode(), first[t or ""]
        again = lead is not None and i != lead
        want.append(str((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", lead if again else None, None)))
    assert got == sorted(want)


@pytest.mark.parametrize("blocks", [(8192, 2048), (32, 8)])
def test_nearest_is_exact(spark, monkeypatch, blocks):
    monkeypatch.setattr(ann, "CANDIDATES", blocks[0])
    monkeypatch.setattr(ann, "QUERIES", blocks[1])
    r = np.random.default_rng(4)
    x = r.standard_normal((400, 12)).astype(np.float32)
    x[50:90] = x[10]
    x[100] = 0
    rows = [(i, [float(v) for v in x[i]], 0) for i in range(400)]
    rows[7] = (7, None, 0)
    rows[8] = (8, [float("nan")] * 12, 0)
    rows[9] = (9, [None] + rows[9][1][1:], 0)
    rows[11] = (11, [1.0, 2.0], 0)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = brute.group((q["query_id"], (q["rank"], q["vec_id"], q["score"])) for q in ann.nearest(df, df.where("vec_id % 20 = 0"), 20).collect())
    good = [i for i in range(400) if i not in (7, 8, 9, 11, 100)]
    assert sorted(got) == [q for q in range(0, 400, 20) if q != 100]
    xs = x.astype(np.float64)
    for q, found in got.items():
        score = np.zeros(400)
        for d in range(12):
            score += xs[q, d] * xs[:, d]
        want = sorted((i for i in good if i != q), key=lambda i: (-score[i], i))[:20]
        assert [(k + 1, i, score[i]) for k, i in enumerate(want)] == sorted(found)


def test_nearest_of_huge_and_tiny_vectors():
    """Products that leave the range of doubles, or are lost below it, against plain sums."""
    r = np.random.default_rng(2)
    x = r.standard_normal((120, 6))
    x[:30, 0], x[30:50, 1] = 1e200, -3e307
    x[50:70] *= 1e-250
    ids = np.arange(120)
    got = ann.search_cell(ids[:60], x[:60], ids, x, 20)
    with np.errstate(over="ignore", invalid="ignore"):
        for q in range(60):
            score = ann.exact_products(np.repeat(x[q : q + 1], 120, 0), x)
            want = sorted((i for i in range(120) if i != q), key=lambda i: (not np.isnan(score[i]), 0 if np.isnan(score[i]) else -score[i], i))[:20]
            assert got[1][got[0] == q].tolist() == want


def test_nearest_of_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [1.0, 1.0]), (None, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = ann.nearest(df, df.where("vec_id % 20 = 0"), 20).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 20), (0, 2, 1), (20, 1, 0), (20, 2, 1)]
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


ITEMS = ["If Alice buys 12 apples for 3 dollars each, how many dollars does Alice spend on the apples in total today?", "the river runs past seven old mills before it reaches a quiet harbour by the sea", "short one", None, ""]


def test_leaks(spark):
    r = random.Random(6)
    texts = [(0, prose(r, 100)), (1, f"{prose(r, 40)}. {ITEMS[0]} {prose(r, 40)}"), (2, f"{prose(r, 20)}\nif Bob buys 40 apples for 9 dollars each, how many dollars does Bob spend on the apples in total today? {prose(r, 5)}"),
             (3, ITEMS[1].upper().replace(" ", "!! ")), (4, f"{prose(r, 30)} the river runs past {prose(r, 30)}"), (5, None), (6, ""), (None, ITEMS[1]), (7, f"x {ITEMS[1]} y {ITEMS[0]}"), (8, "a short one here")]
    bench = spark.createDataFrame([*enumerate(ITEMS), (None, "x")], "item_id long, text string").withColumn("id", F.lit(1))
    got = {(x["doc_id"], x["item_id"]): x for x in decontaminate.find_leaks(docs_frame(spark, texts), bench).collect()}
    assert {k for k in got if k[1] != 2} == {(1, 0), (2, 0), (3, 1), (7, 0), (7, 1)}
    assert got[(1, 0)]["verbatim"] and not got[(2, 0)]["verbatim"]
    assert decontaminate.find_leaks(docs_frame(spark, texts), bench.limit(0)).count() == 0 == decontaminate.find_leaks(docs_frame(spark, []), bench).count()


def test_slots_must_be_consistent():
    same = [([1, 2], [5, 6]), ([2], [6]), ([1], [5])]
    assert decontaminate.consistent(same) == 3
    assert decontaminate.consistent([*same, ([1], [9])]) == 3
    assert decontaminate.consistent([([1], [5]), ([2], [5])]) == 1


def plain_leaks(docs, items):
    order = lambda w: int(decontaminate._hashes(w)[0].astype(np.int64))
    return brute.leaked(docs, items, set(decontaminate.UNITS.split()), set(decontaminate.FUNCTION_WORDS.split()), order)


def found_leaks(docs, bench):
    rows = decontaminate.find_leaks(docs, bench).collect()
    assert len({(r["doc_id"], r["item_id"]) for r in rows}) == len(rows)
    return {(r["doc_id"], r["item_id"]): (r["n_windows"], r["n_matched"], r["n_consistent"], r["verbatim"]) for r in rows}


def test_leaks_against_brute_force(spark, small):
    docs, bench = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain_leaks(*([tuple(r) for r in t.select(i, "text").collect()] for t, i in ((docs, "doc_id"), (bench, "item_id"))))
    assert want and found_leaks(docs, bench) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_leaks_of_templates_against_brute_force(spark, seed):
    r = random.Random(seed)
    names, plain = ["Alice", "Bob", "Carl", "Zoë", "Éva", "NASA", "Q"], ["gives", "has", "apples", "The", "the", "red", "café", "ÀLT", "to", "is", "more", "than"]
    other = ["5", "12", "3.5", "1,000", "7kg", "20%", "9KM", "4x", "km", "min", "%", "--", "(8)", "5.kg", "-3", "a:b", "x" * 80]

    def text(n):
        return "".join(r.choice(names if r.random() < 0.2 else other if r.random() < 0.3 else plain) + r.choice([" "] * 8 + [". ", "? ", "\n", ", ", "! "]) for _ in range(n))

    def changed(t):
        swap = dict(zip(names[:5], r.sample(names[:5], 5), strict=True)) | {"5": "6", "12": "71"}
        return " ".join(swap.get(w, w) if r.random() < 0.95 else r.choice(plain) for w in t.split(" "))

    items = [(i, text(r.choice([0, 1, 2, 4, 5, 6, 8, 20, 30]))) for i in range(40)] + [(90, None), (91, "12 5 3.5 7 8 9 1"), (92, "Bob 5 km")]
    docs = [(d, " ".join(f(r.choice(items)[1] or "") for f in r.choices([changed, str, lambda t: text(9)], k=r.choice([0, 1, 3, 6])))) for d in range(160)]
    want = plain_leaks(docs, items)
    assert len(want) > 100 and any(not v[3] for v in want.values()) and any(v[2] < v[1] for v in want.values())
    assert found_leaks(docs_frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")) == want


def test_cross_entropy_difference(spark):
    good = [" ".join(["alpha", "beta", "gamma", "delta"] * 10) for _ in range(20)]
    bad = [" ".join(["delta", "gamma", "beta", "alpha"] * 10) for _ in range(40)]
    df = docs_frame(spark, [*enumerate(good + bad), (60, None), (61, ""), (None, good[0])])
    got = {x["doc_id"]: x for x in lm_score.score_by_difference(df, spark.createDataFrame([(i,) for i in range(10)] + [(None,), (0,)], "doc_id long")).collect()}
    assert max(got[i]["score"] for i in range(20)) < min(got[i]["score"] for i in range(20, 60))
    assert got[60]["score"] is None and got[61]["n_tokens"] == 0 and got[None]["score"] < min(got[i]["score"] for i in range(20, 60))
    assert lm_score.score_by_difference(docs_frame(spark, []), df.select("doc_id")).count() == 0


@pytest.mark.parametrize("block", [1 << 23, 300])
def test_losses_against_plain_counts(spark, monkeypatch, block):
    """Counts over all texts and blocks, leaving a text out, matching and interpolation, by hand."""
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block)
    r = random.Random(13)
    texts = [(i, prose(r, r.randrange(1, 60))) for i in range(30)] + [(30, prose(r, 1500)), (31, None), (32, " "), (None, "ba ne"), (3, "ba ne"), (3, "ba ne")]
    target = {0, 3, 5, 8, 13, 30, 32}
    ids = spark.createDataFrame([(i,) for i in target] + [(None,), (3,)], "doc_id long")
    got = sorted(lm_score.score_by_difference(docs_frame(spark, texts), ids).collect(), key=str)
    want = brute.losses(texts, target)
    order = lambda rows: sorted(rows, key=lambda r: (str(r[0]), r[1], r[4] or 0))
    for x, y in zip(order([tuple(r) for r in got]), order(want), strict=True):
        assert x[:2] == y[:2] and (x[2:] == y[2:] if y[2] is None else x[2:] == pytest.approx(y[2:], rel=1e-9))


def test_scores_rank_held_out_labels(spark):
    """Labels of odd ids, which the target doesn't hold, against the scores; toxic and bad documents should score higher."""
    at = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{at}/labels.parquet")
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0")
    got = lm_score.score_by_difference(spark.read.parquet(f"{at}/documents.parquet"), good.where("doc_id % 2 = 0").select("doc_id"))
    rows = got.join(labels, "doc_id").where("doc_id % 2 = 1 and score is not null").select("score", "quality", "n_tokens").collect()
    a, b = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert len(a) > 50 and len(b) > 20 and np.mean([x < y for x in a for y in b]) > 0.6


def test_quality_learns_and_scores_whole_texts(spark):
    r = random.Random(9)
    texts, labels = [], []
    for i in range(400):
        junk = i % 4 == 0
        body = prose(r, 150)
        texts.append((i, body + " " + " ".join(x + "$$$" for x in prose(r, 200).split()) if junk else body + " " + prose(r, 200)))
        labels.append((i, 0 if junk else 1, 0))
    texts += [(1000, None), (1001, ""), (None, prose(r, 50))]
    df = docs_frame(spark, texts)
    lab = spark.createDataFrame([*labels, (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(df, lab)
    got = {x["doc_id"]: x["score"] for x in quality.score_quality(df, model).collect()}
    held = {x["doc_id"] for x in df.where(quality.held_out()).collect()}
    assert len(held) > 50 and all((got[i] >= 0.3) == (i % 4 != 0) for i in held if i < 400)
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 403
    assert quality.score_quality(docs_frame(spark, []), model).count() == 0
    none = quality.fit_quality(df, lab.limit(0))
    assert {round(x["score"], 6) for x in quality.score_quality(df, none, keep=["doc_id"]).collect()} == {0.5}


def test_quality_gradient():
    """Backpropagation equals finite differences, and fitting lowers the loss."""
    r = np.random.default_rng(1)
    x, span, y = r.standard_normal((9, quality.N_FEATURES)), np.array([0, 2, 5, 9]), np.array([1, 0, 1], float)
    loss = lambda m: -np.mean(y * np.log(m.forward(x, span)["y"]) + (1 - y) * np.log(1 - m.forward(x, span)["y"]))
    m = quality.AttentionModel()
    m.p = {k: q.astype(float) for k, q in m.p.items()}
    m.p["c"] = r.standard_normal(quality.HIDDEN)
    grad, step = m.gradient(x, span, y), 1e-6
    for k, q in m.p.items():
        for at in r.permutation(q.size)[:12]:
            side = []
            for s in (step, -step):
                q.flat[at] += s
                side.append(loss(m))
                q.flat[at] -= s
            assert abs((side[0] - side[1]) / (2 * step) - grad[k].flat[at]) < 1e-7
    before = loss(m)
    m.fit(x, span, y, steps=60, rate=0.01)
    assert loss(m) < before / 4


def test_quality_against_plain_scores(spark):
    """Passages, features and gated attention of whole texts, repeated rows and a very long text included."""
    r = random.Random(21)
    odd = ["", " \n\t", "One", "a a a b a b", "Zoë café — 99% & $5!\n\n(x) #tag", "w" * 50 + " " + "7 " * 130, prose(r, 64), prose(r, 65), prose(r, 128), prose(r, 6_000)]
    texts = list(enumerate([None, *odd, *odd[2:5], *(prose(r, r.randrange(300)) + "!?" * (k % 3) for k in range(40))])) + [(None, "no id"), (4, "id again")]
    df = docs_frame(spark, texts)
    model = quality.fit_quality(df, spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int"))
    word_hash = lambda w: int(common.word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
    rows = lambda t: brute.passage_features(t, quality._KINDS, quality.N_KINDS, quality.PASSAGE, quality.HASHED, word_hash)
    plain = lambda t: brute.attention_score(rows(t), model.mean, model.scale, model.p)
    want = sorted((-1 if d is None else d, plain(t)) for d, t in texts)
    got = sorted((-1 if x["doc_id"] is None else x["doc_id"], x["score"]) for x in quality.score_quality(df, model).collect())
    assert [d for d, _ in got] == [d for d, _ in want] and np.allclose([s for _, s in got], [s for _, s in want], atol=1e-4)
    assert max(s for _, s in want) - min(s for _, s in want) > 0.3


def test_materialized_tables_keep_rows(spark):
    assert materialize(spark.range(5), "x").count() == 5


def test_losses_over_the_whole_vocabulary(spark, monkeypatch):
    """More words than any fixed table, in many blocks and buckets, against plain counts; rare words tell texts apart."""
    r = random.Random(4)
    texts = [(i, " ".join(f"w{int(1500 * r.random() ** 2)}" for _ in range(r.randrange(1, 120)))) for i in range(150)] + [(150, ""), (151, "rare1 w1 w2"), (152, "rare2 w1 w2"), (153, "rare1 w1 w2"), (None, "w1 w1")]
    chosen = {*range(0, 150, 3), 151}
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(lm_score, "BUCKET_ROWS", 700)
    got = {x["doc_id"]: x for x in lm_score.score_by_difference(docs_frame(spark, texts).repartition(3), spark.createDataFrame([(i,) for i in chosen], "doc_id long")).collect()}
    assert len({w for _, t in texts for w in t.split()}) > 1034 and len(got) == len(texts)
    for d, n, *losses in brute.losses(texts, chosen):
        x = got[d]
        assert x["n_tokens"] == n and (x["target_loss"], x["background_loss"], x["score"]) == (pytest.approx(losses, rel=1e-9) if n else (None,) * 3)
    # 153 shares a rare word with a target text other than itself
    assert got[153]["score"] < got[152]["score"]


def test_leaks_with_names_that_open_sentences_and_glued_units(spark):
    items = ["Alice has 3 apples. Bob has 5 pears. Alice gives Bob 2 apples. How many apples does Alice have?", "A shop sells a coat at 20% off and then adds 5% tax to the price. What is paid?", "The rope weighs 5kg and each box weighs 12kg so how heavy are both together on the scale?"]
    texts = ["Carl has 7 apples. Dana has 9 pears. Carl gives Dana 4 apples. How many apples does Carl have?", "A shop sells a coat at 30% off and then adds 7% tax to the price. What is paid?", "The rope weighs 8 kg and each box weighs 30kg so how heavy are both together on the scale?", "Carl has a dog. Dana has a cat. They meet in the park on most days and talk."]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x for x in decontaminate.find_leaks(docs_frame(spark, list(enumerate(texts + items))), bench).collect()}
    assert set(got) == {(i, i) for i in range(3)} | {(i + 4, i) for i in range(3)}
    assert all(x["verbatim"] == (d >= 4) and x["n_matched"] <= x["n_windows"] for (d, _), x in got.items())


def test_leaks_of_short_items_and_items_without_literals(spark):
    items = ["short one", "12 + 7 + 30 + 4 + 9 + 18 =", "5 6", "Yes"]
    texts = ["a short one here and some more words", "so 12 + 7 + 30 + 4 + 9 + 18 = what is it now", "so 12 + 7 + 30 + 4 + 9 + 19 = what is it now", "we count 5 6 and then stop there", "we say yes", "", "one short", "short one"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.find_leaks(docs_frame(spark, list(enumerate(texts))), bench).collect()}
    assert got == {(0, 0), (1, 1), (3, 2), (4, 3), (7, 0)}

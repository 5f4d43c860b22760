"""Operators against plain Python that restates their rule, and inputs that once were slow or failed."""

import collections
import hashlib
import math
import random
import re
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowkin.llm import common, license_scan, ppm, pu_quality, quality_mcd, toxicity, url_cascade, warc, winnow
from rowkin.llm.textvec import Words

from .test_brute import SMALL, alnum, lowered, texts_of

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="needs the test tables")


# quality rules


def plain_mcd(groups, floors, support=0.75, tolerance=1e-3):
    """{key: (n, mean, scatter)}: all groups take as many concentration steps as the slowest needs."""
    d = len(floors)
    low = lambda v, p: np.sort(v, axis=0)[math.ceil(p * len(v)) - 1]
    now, scale = {}, 1.0
    for k, x in groups.items():
        m = low(x, 0.5)
        now[k] = m, np.diag((1.4826 * low(np.abs(x - m), 0.5)) ** 2 + floors**2)
    lowest = None
    while True:
        if scale != 1.0:
            dets = {k: np.linalg.slogdet(s)[1] for k, (_, s) in now.items()}
            if lowest is not None:
                if max(lowest[k] - dets[k] for k in dets) <= tolerance:
                    return {k: (len(groups[k]), *now[k]) for k in now}
                dets = {k: min(v, lowest[k]) for k, v in dets.items()}
            lowest = dets
        scale = support / quality_mcd._chi2_cdf(quality_mcd.chi2_quantile(support, d), d + 2)
        for k, x in groups.items():
            m, s = now[k]
            d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
            near = x[d2 <= low(d2, support) + 1e-9]
            now[k] = near.mean(axis=0), scale * np.cov(near.T, bias=True).reshape(d, d) + np.diag(floors**2)


def test_kept_against_a_plain_mcd(spark):
    """Every (lang, source) group has an estimate of its own, down to a single row."""
    rows = quality_mcd.quality_rules(spark.read.parquet(f"{SMALL}/documents.parquet"), keep=("doc_id", "lang", "source")).collect()
    floors = np.array([quality_mcd.FLOOR[x] for x in quality_mcd.XS])

    def vector(r):
        per = lambda a, b: a / max(b, 1)
        return [math.log1p(100 * per(r["n_symbols"], r["word_chars"])), math.log1p(100 * per(r["n_repeat_words"], r["n_words"])), math.log1p(r["n_dup_lines"]), math.log(1 + per(r["word_chars"], r["n_words"]))]

    groups = collections.defaultdict(list)
    for r in rows:
        if not r["base_failed"]:
            for key in ((r["lang"], r["source"]), (r["lang"],), ()):
                groups[key].append(vector(r))
    fitted = plain_mcd({k: np.array(v) for k, v in groups.items()}, floors)
    assert min(len(v) for k, v in groups.items() if len(k) == 2) < 5

    def blended(key):
        n, m, s = fitted[key]
        if not key:
            return m, s
        w, (pm, ps) = n / (n + 50), blended(key[:-1])
        return w * m + (1 - w) * pm, w * s + (1 - w) * ps

    limit = quality_mcd.chi2_quantile(0.999, 4)
    for r in rows:
        if r["base_failed"]:
            assert not r["kept"]
            continue
        m, s = blended((r["lang"], r["source"]))
        off = np.array(vector(r)) - m
        d2 = off @ np.linalg.inv(s) @ off
        assert r["d2"] == pytest.approx(d2, rel=1e-6, abs=1e-6)
        worse = (off[:3] > 2 * floors[:3]).any() or abs(off[3]) > 2 * floors[3]
        assert r["kept"] == (not (d2 > limit and worse))


def test_statistics_of_a_very_long_text(spark):
    rng = random.Random(1)
    words = [rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(2_000_000)]
    triples = collections.Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if triples[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    df = spark.createDataFrame([(1, " ".join(words)), (2, "ha " * 2_000_000)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_repeat_words"]) for r in quality_mcd.quality_stats(df).drop("text").collect()}
    assert got == {1: (2_000_000, len(covered)), 2: (2_000_000, 2_000_000)} and covered


# WARC


def test_warc_of_any_id_and_zone(spark, tmp_path):
    ids = [0, 1, 2**40, 2**62, 2**63 - 1, -5, -(2**63), None]
    rows = [(i, "http://a.b/x", f"<p>{k}</p>" * 50) for k, i in enumerate(ids)] + [(2**63 - 2, "u", "<p>4</p>" * 50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        warc.write_warc(df, str(tmp_path / "w"), most_bytes=5000)
        got = warc.merge_index(warc.read_warc(spark, str(tmp_path / "w"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(got) == len(rows) and len({r["archive"] for r in got}) >= 3
    assert {r["page_id"] for r in got} == {"null" if i is None else str(i) for i in ids} | {str(2**63 - 2)}
    assert all(re.fullmatch(r"20\d\d-\d\d-\d\dT\d\d:\d\d:\d\dZ", r["date"]) for r in got)
    assert next(r["date"] for r in got if r["page_id"] == "0") == "2024-01-01T00:00:00Z"
    assert next(r["date"] for r in got if r["page_id"] == "-5") == "2033-12-28T23:59:55Z"
    by_id = {r["page_id"]: r for r in got}
    assert by_id[str(2**63 - 2)]["record_type"] == "revisit" and by_id[str(2**63 - 2)]["refers_to"] == str(2**63 - 1)
    order = [(r["url_key"], r["date"], r["number"]) for r in sorted(got, key=lambda r: (r["range"], r["place"]))]
    assert order == sorted(order)


# licences


def plain_licences(texts, templates, rarest=8, agree=0.75):
    """{id: (labels of the method, score)}"""
    words = {i: alnum(t) for i, t in texts.items()}
    df = collections.Counter(w for ws in words.values() for w in set(ws))
    out = {}
    for i, ws in words.items():
        best = {}
        for label, (notice, must) in templates.items():
            mine = notice.split()
            distinct = sorted(set(mine), key=lambda w: (df[w], w))
            rare = set(distinct[: min(rarest, math.ceil(len(distinct) / 2))])
            spots = [p for p, w in enumerate(mine) if w in rare]
            for start in {a - p for a, w in enumerate(ws) if w in rare for p in spots if mine[p] == w}:
                here = [0 <= start + p < len(ws) and ws[start + p] == w for p, w in enumerate(mine)]
                if sum(here[p] for p in spots) < math.ceil(agree * len(spots) - 1e-9):
                    continue
                places = [next(a for a in range(len(mine)) if mine[a : a + len(k.split())] == k.split()) for k in must]
                if all(all(here[a : a + len(k.split())]) for a, k in zip(places, must, strict=True)):
                    best[label] = max(best.get(label, 0), sum(here) / len(mine))
        out[i] = {k for k, v in best.items() if v >= agree}, max(best.values(), default=0.0)
    return out


def test_licence_labels_against_plain_python(spark):
    texts = texts_of(SMALL)
    rng = random.Random(3)
    for k, (notice, _) in enumerate(license_scan.TEMPLATES.values()):
        words = notice.split()
        texts[10_000 + 3 * k] = f"Copyright 1999 Some Body. {notice.capitalize()}! More of it, {notice.upper()}."
        for _ in range(max(1, len(words) // 6)):
            words[rng.randrange(len(words))] = "something"
        texts[10_001 + 3 * k] = "intro " + " ".join(words)
        texts[10_002 + 3 * k] = " ".join(notice.split()[2:]) + " é " + " ".join(notice.split()[::-1])
    texts |= {20_000: None, 20_001: "", 20_002: "Ünder thE MIT\u00a0license"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected = plain_licences(texts, license_scan.TEMPLATES)
    base = set(license_scan.PHRASES.values())
    seen = set()
    for r in license_scan.license_scan(df).collect():
        labels, score = expected[r["doc_id"]]
        assert set(r["labels"].split(",")) - {""} == labels | (set(r["base_labels"].split(",")) - {""})
        assert r["score"] == pytest.approx(1.0 if r["n_base"] else score)
        assert set(r["base_labels"].split(",")) - {""} <= base
        seen |= labels
    assert seen == set(license_scan.TEMPLATES)


def test_many_long_templates(spark):
    rng = random.Random(5)
    vocabulary = [f"term{i}" for i in range(3000)]
    templates = {f"t{i}": (" ".join(t := rng.choices(vocabulary, k=200)), [" ".join(t[50:54])]) for i in range(100)}
    rows = [(i, "x y " * i + templates[f"t{i}"][0] + " z") for i in range(0, 100, 9)] + [(500, " ".join(rng.choices(vocabulary, k=500)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    began = time.time()
    got = {r["doc_id"]: r["labels"] for r in license_scan.license_scan(df, templates=templates).collect()}
    assert got == {i: f"t{i}" for i in range(0, 100, 9)} | {500: ""} and time.time() - began < 60


# winnowing


def test_repeated_words_are_linear():
    began = time.time()
    index = winnow.Index([("a", "ha " * 100_000), ("b", "ha hi " * 5000), ("c", "ha")])
    got = list(winnow.hits(index, ["ha " * 200_000, "x " + "ha hi " * 50_000, "hi " * 9]))
    assert got == [(200_000, [(0, 200_000)], {"a", "c"}), (100_001, [(1, 100_001)], {"b", "c"}), (9, [], set())] and time.time() - began < 20


# url filters


def test_sharded_cascades_and_long_lists(spark):
    rng = random.Random(7)
    rules = [url_cascade.Rule(rng.choice(["block", "allow"]), f"h{i}.example", "/") for i in range(400)] + [url_cascade.Rule("block", "example", "/a"), url_cascade.Rule("allow", "h3.example", "/a")]
    urls = [f"http://{rng.choice(['', 'w.'])}h{rng.randrange(900)}.example/{rng.choice('ab')}" for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")

    def plain(url):
        host, _, rest = url.partition("://")[2].partition("/")
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and f"/{rest}".startswith(r.path)]
        best = max(fits, key=lambda r: len(r.key), default=None)
        return (best.key, best.action) if best else (None, "allow")

    for most in (1_000_000, 210):
        got = url_cascade.url_filter(df, rules, max_listed=most).collect()
        assert {r["page_id"]: (r["rule"], r["verdict"]) for r in got} == {i: plain(u) for i, u in enumerate(urls)}


# prediction by partial matching


def test_pieces_do_not_change_scores(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id % 3 = 0").union(spark.createDataFrame([(10**6, "lorem ipsum " * 20_000, None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long"))
    df.write.mode("overwrite").parquet(path := f"{common.scratch_dir(spark)}/ppm-test-docs")
    df = spark.read.parquet(path)
    one, many = ({r["doc_id"]: (r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in ppm.ppm_score(df, piece_bytes=n).collect()} for n in (1 << 30, 20_000))
    assert one.keys() == many.keys() and all(one[i][:2] == many[i][:2] and one[i][2:] == pytest.approx(many[i][2:], rel=1e-9) for i in one)


# classifiers


def test_risk_is_the_least(spark):
    rng = np.random.default_rng(11)
    p, u, prior = rng.normal(1.5, 1, (400, 2)), np.vstack([rng.normal(1.5, 1, (500, 2)), rng.normal(-1.5, 1, (500, 2))]), 0.5

    def risk(w):
        """Non-negative unbiased risk with logistic loss, restated, and the weight decay of the fit."""
        z = lambda x: w[0] + x @ w[1:]
        plus = np.log(1 + np.exp(-z(p))).mean()
        minus = np.log(1 + np.exp(z(u))).mean() - prior * np.log(1 + np.exp(z(p))).mean()
        return prior * plus + max(0.0, minus) + 1e-3 / 2 * (w[1:] ** 2).sum()

    w = pu_quality.fit_nnpu(p, u, prior)
    grid = [np.array([a, b, c]) for a in np.linspace(-4, 4, 17) for b in np.linspace(-4, 4, 17) for c in np.linspace(-4, 4, 17)]
    near = [w + rng.normal(0, s, 3) for s in (0.01, 0.05, 0.2, 1.0) for _ in range(200)]
    assert risk(w) <= min(map(risk, grid + near)) + 2e-3


def test_toxic_scores_against_plain_python(spark):
    rng = random.Random(9)
    clean, bad = [f"word{i}" for i in range(60)], ["vile", "vileness", "hateful", "scum"]
    rows, labels = [], []
    for i in range(400):
        words = rng.choices(clean, k=rng.randint(5, 60))
        if i % 4 == 0:
            at = rng.randrange(len(words))
            words[at:at] = rng.choices(bad, k=4)
        elif rng.random() < 0.1:
            words.append(rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs.withColumnRenamed("text", "_t"), known, 4, 2)
    sampled = spark.createDataFrame(rows, "doc_id long, text string").filter((common.crc_mod(F.col("doc_id"), 4) != 2) & (F.pmod(F.xxhash64("doc_id", F.lit(43)), F.lit(3)) > 0))
    learn = {r["doc_id"] for r in sampled.select("doc_id").collect()}

    def tokens(word):
        w = Words([word.encode()], "alnum")
        return {int(w.hash[0])} | {int(x[0]) for x in (w.prefix_hash(n) for n in toxicity.PREFIXES) if x[0]}

    name = {word: tokens(word) for word in clean + bad}
    counts = collections.defaultdict(lambda: [0, 0])
    for (i, text), (_, toxic) in zip(rows, labels, strict=True):
        if i in learn:
            for t in set().union(*(name[w] for w in text.split())):
                counts[t][0 if toxic else 1] += 1
    total = np.sum(list(counts.values()), axis=0)
    ratio, expected = total[0] / total.sum(), {}
    for t, (b, g) in counts.items():
        part = lambda c, q: c * math.log(c / ((b + g) * q)) if c else 0.0  # noqa: B023, E731
        z = math.sqrt(max(0.0, 2 * (part(b, ratio) + part(g, 1 - ratio))))
        prior, mass = 0.05 * (b + g), 0.05 * total.sum()
        odds = math.log((b + prior) / (total[0] + mass - b - prior)) - math.log((g + prior) / (total[1] + mass - g - prior))
        if z >= 4 and abs(odds) >= 1:
            expected[t] = odds
    assert dict(zip(map(int, model.tokens), model.scores, strict=True)) == pytest.approx(expected) and expected
    share = {t: counts[t][1] / total[1] for t in expected}
    rest = 1 - sum(share.values())
    assert sum(share[t] * math.exp(model.rate * (o - model.drift)) for t, o in expected.items()) + rest * math.exp(-model.rate * model.drift) == pytest.approx(1, abs=1e-6)
    for r in toxicity.toxicity(docs, known).collect():
        odds = []
        for w in rows[r["doc_id"]][1].split():
            mine = sorted((-abs(dict(zip(map(int, model.tokens), model.sure, strict=True))[t]), expected[t]) for t in name[w] if t in expected)
            odds.append(mine[0][1] if mine else 0.0)
        s = [o - model.drift for o in odds]

        def maximal(a, b):
            best = max(((sum(s[i:j]), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, a, a))  # noqa: B023
            return [] if best[0] <= 0 else [*maximal(a, best[1]), best[0], *maximal(best[2], b)]

        x = [model.rate * v - math.log(len(s)) - model.place for v in maximal(0, len(s))]
        over, top = [v / model.spread for v in x if v > 0], float(np.clip(max(x, default=-10.0) / model.spread, -10, 20))
        tail = -math.log(max(-math.expm1(-math.exp(-top)), 1e-12))
        z = model.weights @ [1, math.log1p(sum(over)), math.log1p(len(over)), tail]
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-np.clip(z, -30, 30))), rel=1e-6, abs=1e-9)


# components and scratch tables


def test_components_by_rounds_and_by_one_task(spark):
    rng = random.Random(13)
    edges = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(330)] + [(1000, 1000 + i) for i in range(200)] + [(2000 + i, 2001 + i) for i in range(40)]
    up = {}

    def of(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for u, v in edges:
        a, b = of(u), of(v)
        up[max(a, b)] = min(a, b)
    expected = {x: of(x) for x in up if of(x) != x}
    df = spark.createDataFrame(edges, "u long, v long")
    for few in (0, None):
        assert {r["node"]: r["root"] for r in common.components(df, "test", few=few).collect()} == expected
    assert common.components(df.limit(0), "test").count() == 0


def test_scratch_tables(spark):
    mark = common.begun()
    a, b = (common.written(spark.range(n), "test") for n in (3, 4))
    common.removed_since(spark, mark, b)
    assert b.count() == 4 and not Path(a._scratch.removeprefix("file://")).exists()
    common.removed(spark, b)
    assert common.begun() == mark

    class Cluster:
        conf, sparkContext = {}, type("", (), {"master": "spark://somewhere:7077"})

    with pytest.raises(ValueError):
        common.scratch_dir(Cluster)


def test_hashes_of_items(spark):
    """Items' ids as one digest: sorted as strings, comma-joined."""
    bench = spark.createDataFrame([(10, "one two"), (9, "two three"), (100, "x")], "item_id long, text string")
    row = winnow.decontaminate(spark.createDataFrame([(1, "One, two three")], "doc_id long, text string"), bench).first()
    assert (row["n_hit"], row["items_sha256"]) == (3, hashlib.sha256(b"10,9").hexdigest()) and lowered("É") == "É"


# names in other cases, and the pipeline's stages


def test_columns_that_clash_in_another_case(spark):
    docs = spark.createDataFrame([(1, "some words here", "x", "y", "z")], "doc_id long, text string, Score string, N_Words string, Labels string")
    known = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    more = ("Score", "N_Words")
    assert toxicity.toxicity(docs, known, keep=more).columns.count("N_Words") == 1
    assert "Score" not in pu_quality.quality_classifier(docs, known, keep=more).columns
    assert "N_Words" not in winnow.decontaminate(docs, docs, item_col="doc_id").columns
    assert [c for c in license_scan.license_scan(docs).columns if c.lower() == "labels"] == ["labels"]
    assert "N_Words" not in quality_mcd.quality_rules(docs.withColumns({"lang": F.lit("en"), "source": F.lit("a")}), keep=more).columns


def test_stages_on_planted_rows(spark):
    """What each filtering stage does with nulls, empty texts, repeated rows, copies and benchmark passages."""
    import corpus_pipeline

    rng = random.Random(21)
    prose = lambda n: [rng.choice(["the", "river", "town", "under", "old", "bridge", "quietly", "ran", "people", "said", "a", "of"]) + rng.choice(["", "", "s", "ly"]) for _ in range(n)]
    a, b = prose(200), prose(300)
    near = [*a[:100], "changed", *a[101:]]
    item = next(t for t in texts_of(SMALL, "benchmark", "item_id").values() if len(alnum(t)) >= 12)
    rows = [(1, " ".join(a)), (2, " ".join(near)), (2, " ".join(near)), (3, " ".join(b)), (None, " ".join(a)), (5, None), (6, ""), (7, f"{' '.join(b[::-1])} {item}"), (8, "too short")]
    df = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    kept = lambda name: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in stages[name](spark, df, SMALL).select("doc_id", "text").collect())
    of = lambda *ids: sorted([(i is None, i or 0, t) for k, (i, t) in enumerate(rows) if k in ids], key=lambda x: (x[0], x[1]))
    assert kept("quality rules") == of(0, 1, 2, 3, 4, 7)
    assert {x[1] for x in kept("n-gram Jaccard join")} == {0, 3, 5, 6, 7, 8}  # the null id is the least of the copies
    assert kept("benchmark decontamination") == of(0, 1, 2, 3, 4, 5, 6, 8)
    labelled = [x[1] for x in kept("quality classifier")]
    assert set(labelled) <= {0, 1, 2, 3, 5, 6, 7, 8} and labelled.count(2) in (0, 2)

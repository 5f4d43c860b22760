"""Golden scalars, invariants and brute-force checks of the linkage operators."""

import collections
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from rowkin.config import BlockingConfig
from rowkin.functions import normalize, similarity, tokens
from rowkin.operators import blocking, evaluate, features, profile, splits
from rowkin.sources import sinks, tables

NAMES = {
    "LLC Moncada Léarning Center": "llc moncada learning center",
    "B+ Retail Inc": "b and retail inc",
    "<< Team Ecole": "team ecole",
    "Shri Supreme Consulting Private  (Limited)": "shri supreme consulting pvt ltd",
    "Fractales Amis Groupe S.A.S": "fractales amis groupe sas",
    "Pvt. EFS Print Ventures Ltd.": "pvt efs print ventures ltd",
    "International South Consultants Private Ltd": "international south consultants private ltd",
    "मॉडर्न फाइनेंस": "मडरन फइनस",
    "A&B PvtLtd": "a and b pvt ltd",
    "PVT.LTD": "pvt ltd",
    "Foo Limited Company": "foo ltd co",
    "ＡＦ ½ Straße": "af 12 straße",
    "a_b-c": "a b c",
    "": "",
    None: "",
}
ADDRESSES = {
    "GREENSBORO, NC, 19 1/2 STARDUST TRAIL": "greensboro nc 19 1 2 stardust trail",
    "5780 Fawn Ct, Fort Worth, Texas": "5780 fawn court fort worth texas",
    "H.no 910 A 3503, Mumbai, महाराष्ट्र": "hno 910 a 3503 mumbai महरषटर",
    "KH NO. -570/13, NEW DELHI": "kh no 570 13 new delhi",
    "St. Louis St": "street louis street",
}


def one(spark, of, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[1] for r in df.select("i", of(F.col("x")).alias("y")).orderBy("i").collect()]


def test_golden_names_and_addresses(spark):
    assert one(spark, normalize.normalize_name, NAMES) == list(NAMES.values())
    assert one(spark, normalize.normalize_address, ADDRESSES) == list(ADDRESSES.values())
    assert one(spark, normalize.normalize_country, ["US", "India", " france ", "", None, "  "]) == ["US", "INDIA", "FRANCE", "unknown", "unknown", ""]


def plain(x):
    x = unicodedata.normalize("NFKD", x).lower().replace("&", " and ").replace("+", " and ")
    x = re.sub(r"[^\w\s]", "", re.sub(r"[/,_\-;:|]", " ", x))
    return re.sub(r"\s+", " ", x).strip()


def test_random_unicode(spark):
    rng = random.Random(5)
    pools = [range(32, 127), range(0xA0, 0x250), range(0x900, 0xD00), range(0x2000, 0x2070), range(0x1C, 0x20)]
    # characters of an old Unicode version: Python's tables are newer than the JVM's
    pools = [[chr(i) for i in p if unicodedata.ucd_3_2_0.category(chr(i)) != "Cn"] for p in pools]
    texts = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    assert one(spark, normalize.normalize_text, texts) == [plain(t) for t in texts]
    once = one(spark, normalize.normalize_name, texts)
    assert one(spark, normalize.normalize_name, once) == once


def test_tokens(spark):
    df = spark.createDataFrame([("flat ५६ 12345 the road 12345678901 ab",), ("",)], "x string")
    x = F.col("x")
    rows = df.select(tokens.numbers(x), tokens.numbers(x, 10), tokens.distinctive_tokens(x), tokens.first_word(x), tokens.char_ngrams(x, 2)).collect()
    assert list(rows[0])[:4] == [["५६", "12345", "12345678901"], ["५६", "12345"], ["flat", "12345", "12345678901"], "flat"]
    assert [list(v) if isinstance(v, list) else v for v in rows[1]] == [[], [], [], "", []]
    assert one(spark, lambda c: tokens.char_ngrams(c, 3), ["ab", "abcab"]) == [["ab"], ["abc", "bca", "cab"]]


@pytest.mark.parametrize(
    "a, b, expected",
    [
        ("delta telecommunication inc", "delta tetlecommunication inc", (0.5, 0.925926, 0.821429, 0.964286, 0.285714)),
        ("summit inc", "inc summit", (1.0, 0.636364, 0.454545, 0.2, 0.0)),
        ("ab", "abc", (0.0, 0.5, 0.0, 0.666667, 0.666667)),
        ("", "", (0.0, 0.0, 0.0, 1.0, 0.0)),
        ("", "abc", (0.0, 0.0, 0.0, 0.0, 0.0)),
    ],
)
def test_kernels(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    x, y = F.col("a"), F.col("b")
    grams = [similarity.jaccard(tokens.char_ngrams(x, n), tokens.char_ngrams(y, n)) for n in (2, 3)]
    row = df.select(similarity.jaccard(tokens.tokens(x), tokens.tokens(y)), *grams, similarity.levenshtein_ratio(x, y), similarity.prefix_ratio(x, y)).first()
    assert [round(v, 6) for v in row] == list(expected)


def records(spark, n, source, rng, words):
    rows = []
    for i in range(n):
        name = " ".join(rng.choice(words) for _ in range(rng.randint(0, 4)))
        addr = " ".join([str(rng.randint(1, 40)), *(rng.choice(words) for _ in range(rng.randint(0, 3))), str(rng.randint(10000, 10030))][: rng.randint(0, 5)])
        rows.append((f"{source}-{i}", name, addr, rng.choice(["US", "IN"]), i))
    return rows, spark.createDataFrame(rows, "entity_id string, name_n string, addr_n string, country_n string, ord long")


def keys_of(name, addr):
    toks = [t for t in name.split() if len(t) >= 3 and t not in tokens.STOPWORDS]
    atoks = [t for t in addr.split() if len(t) >= 3 and t not in tokens.STOPWORDS]
    nums = [t for t in addr.split() if t.isdigit() and len(t) <= 10]
    first = name.split()[0] if name else ""
    out = [("B1", name)] if name else []
    out += [("B2", first)] if len(first) >= 4 and first not in tokens.STOPWORDS else []
    out += [("B3", name[:5])] if len(name) >= 5 else []
    out += [("B4", t) for t in toks[:5]] + [("B5", f"{nums[0]} {t}") for t in atoks[:3] if nums]
    return out + [("B6", t) for t in atoks[:4]] + [("B7", t) for t in nums if len(t) in (5, 6)]


def test_blocking_against_simulation(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "inc", "road", "delta", "xy", "omega", "the", "sigma"]
    (s1, a), (s2, b), (s3, c) = (records(spark, n, s, rng, words) for n, s in ((60, "S1"), (90, "S2"), (90, "S3")))
    config = BlockingConfig(caps={"B1": None, "B2": 25, "B3": 25, "B4": 20, "B5": 6, "B6": 20, "B7": 4}, top_k=4)
    index = collections.defaultdict(list)
    for eid, name, addr, country, _ in s2 + s3:
        for s, k in keys_of(name, addr):
            index[s, country, k].append(eid)
    expected = {}
    for eid, name, addr, country, _ in s1:
        score = collections.Counter()
        for s, k in keys_of(name, addr):
            bucket = index.get((s, country, k), [])
            if config.caps[s] is None or len(bucket) <= config.caps[s]:
                for x in bucket:
                    score[x] += config.weights[s]
        expected[eid] = [x for x, _ in score.most_common(config.top_k)]
    got = collections.defaultdict(list)
    for r in blocking.candidates(a, blocking.targets_in_order(b, c), config).orderBy("s1_id", "rank").collect():
        got[r["s1_id"]].append(r["cand_id"])
    assert {k: v for k, v in expected.items() if v} == dict(got)
    lists = {r["s1_id"]: r["candidates"] for r in blocking.candidate_lists(a, blocking.candidates(a, blocking.targets_in_order(b, c), config)).collect()}
    assert lists == {k: sorted(v) for k, v in expected.items()}


@pytest.mark.parametrize(
    "true, pred, expected",
    [("abc", "ab", (1, 2 / 3, 0.909091)), ("ab", "abc", (2 / 3, 1, 0.714286)), ("a", "b", (0, 0, 0)), ("", "", (1, 1, 1)), ("", "a", (0, 0, 0)), ("a", "", (0, 0, 0))],
)
def test_entity_scores(spark, true, pred, expected):
    ids = spark.createDataFrame([("S1-1",)], "s1_id string")
    pairs = lambda s: spark.createDataFrame([("S1-1", x) for x in s] + [("S1-9", "zz")], "s1_id string, cand_id string")
    row = evaluate.entity_scores(evaluate.entity_counts(pairs(pred), ids, pairs(true))).first()
    assert [round(row[c], 6) for c in ("precision", "recall", "f")] == [round(v, 6) for v in expected]


def test_sweep_agrees_with_single_thresholds(spark):
    rng = random.Random(1)
    ids = [f"S1-{i}" for i in range(30)]
    scored = [(i, f"S2-{j}", rng.random()) for i in ids for j in rng.sample(range(40), 5)]
    truth = [(i, f"S2-{j}") for i in ids[:22] for j in rng.sample(range(40), 2)]
    s, t = spark.createDataFrame(scored, "s1_id string, cand_id string, p double"), spark.createDataFrame(truth, "s1_id string, cand_id string")
    x = spark.createDataFrame([(i,) for i in ids], "s1_id string")
    for r in evaluate.threshold_sweep(s, x, t, (0.2, 0.5, 0.9)).collect():
        alone = evaluate.macro_scores(evaluate.entity_counts(evaluate.matched(s, r["threshold"]), x, t)).first()
        assert r["macro_f"] == pytest.approx(alone["macro_f"]) and r["singletons_right"] == alone["singletons_right"]


def test_split_keeps_entities_together(spark):
    df = spark.createDataFrame([(f"S1-{i % 50}", i) for i in range(500)], "s1_id string, x int")
    learn, held = splits.split_entities(df)
    a, b = ({r[0] for r in part.select("s1_id").distinct().collect()} for part in (learn, held))
    assert not a & b and len(a | b) == 50 and 2 <= len(b) <= 20
    assert splits.sample_entities(df, 7).count() == 7


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "s.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"Q\t\tUS\nS1-2\tB\tx\tIndia\n', encoding="utf-8")
    df = tables.with_ordinal(tables.read_source(spark, str(tmp_path / "s.tsv")))
    assert [tuple(r) for r in df.orderBy("ord").collect()] == [("S1-1", '"Q', "", "US", 0), ("S1-2", "B", "x", "India", 1)]
    assert [r["entity_id"] for r in tables.stream_source(spark, str(tmp_path / "s.tsv"), ["entity_id"])] == ["S1-1", "S1-2"]
    assert tables.read_source(spark, str(tmp_path / "s.tsv"), country="us").count() == 0
    assert tables.file_sizes(spark, str(tmp_path / "s.tsv")).first()["bytes"] == (tmp_path / "s.tsv").stat().st_size
    (tmp_path / "t.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-9\nS1-1\t S2-1 ,S3-2,,S2-1\nS1-2\t\n", encoding="utf-8")
    truth = tables.read_truth(spark, str(tmp_path / "t.tsv"))
    assert {r["s1_id"]: r["matched"] for r in truth.collect()} == {"S1-1": ["S2-1", "S3-2"], "S1-2": []}
    sinks.write_matches(tables.truth_pairs(truth), truth, str(tmp_path / "out"), single_file=True, order_by="source1_entity_id")
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text() == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-2\nS1-2\t\n"
    sinks.write_report(spark, {"a": {"b": 1}}, str(tmp_path / "r"))
    assert sinks.read_report(spark, str(tmp_path / "r")) == {"a": {"b": 1}}
    assert {tuple(r) for r in profile.as_table(spark, {"a": {"b": 1}}).collect()} == {("a.b", "1")}


def test_features_are_finite_and_bounded(spark):
    rows = [("S1-1", "Foo Inc", "1 Main St", "US", 0), ("S1-2", "", "", "", 1)]
    df = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string, ord long")
    one_side = tokens.with_tokens(normalize.normalize_table(df))
    other = one_side.withColumn("entity_id", F.regexp_replace("entity_id", "S1", "S3"))
    pairs = spark.createDataFrame([("S1-1", "S3-1"), ("S1-2", "S3-2"), ("S1-1", "S3-2"), ("S1-1", "S3-77")], "s1_id string, cand_id string")
    out = features.pair_features(features.paired(pairs, one_side, other))
    assert features.not_finite(out).count() == 0 and out.count() == 3 and len(out.columns) == 33
    same = out.filter("cand_id = 'S3-1'").first()
    assert same["name_sim_max"] == 1.0 and same["source_is_s3"] == 1.0 and same["addr_is_missing"] == 0.0
    assert out.filter("s1_id = 'S1-2'").first()["name_levenshtein_sim"] == 1.0

"""Operators against brute force on small frames."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corvane.operators import dedup, leakage, metrics, select, workset
from corvane.sources import jsonl, sinks


def test_best_k_stream_evicts_the_earliest_of_the_worst(spark):
    d = spark.createDataFrame([("k", 0.5, 1), ("k", 0.5, 2), ("k", 0.9, 3), ("k", 0.5, 4)], "key string, q double, seq bigint")
    assert sorted(r.seq for r in dedup.best_k_stream(d, ["key"], "q", "seq").collect()) == [2, 3]
    first = spark.createDataFrame([("k", 0.9, 1), ("k", 0.5, 2), ("k", 0.5, 3)], "key string, q double, seq bigint")
    assert sorted(r.seq for r in dedup.best_k_stream(first, ["key"], "q", "seq").collect()) == [1, 2]


def test_first_seen_and_dense_id(spark):
    d = spark.createDataFrame([(i, i % 7, f"v{i}") for i in range(50)], "i int, k int, v string")
    assert sorted((r.k, r.v) for r in dedup.first_seen(d, ["k"], ["i"]).collect()) == [(k, f"v{k}") for k in range(7)]
    got = dedup.dense_id(d, ["i"], parts=5).collect()
    assert sorted((r.id, r.i) for r in got) == [(i, i) for i in range(50)]


def test_groups_and_families(spark):
    random.seed(3)
    pairs = [(random.randrange(60), random.randrange(60)) for _ in range(40)]
    parent = list(range(60))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in dedup.groups(spark.createDataFrame(pairs, "a int, b int")).collect()}
    assert got == {x: find(x) for a, b in pairs if a != b for x in (a, b)}
    f = spark.createDataFrame([(1, ["a", "b"]), (2, ["b"]), (3, ["c"]), (4, None)], "r int, t array<string>")
    assert {r.r: r.family for r in dedup.families(f, "r", F.col("t")).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_three_keys(spark):
    random.seed(5)
    rows = [(i, random.randrange(12), random.randrange(12), random.randrange(12)) for i in range(40)]
    seen, want = [set(), set(), set()], []
    for i, *keys in rows:
        if not any(k in s for k, s in zip(keys, seen, strict=True)):
            want.append(i)
            for k, s in zip(keys, seen, strict=True):
                s.add(k)
    got = dedup.three_keys(spark.createDataFrame(rows, "seq int, a int, b int, c int"), ["a", "b", "c"], "seq")
    assert sorted(r.seq for r in got.collect()) == want


def test_near_duplicates(spark):
    d = spark.createDataFrame([(1, "the quick brown fox jumps"), (2, "the quick brown fox jumped"), (3, "nothing like it at all"), (4, "")], "id int, t string").withColumn("b", F.lit(1))
    assert [(r.a, r.b) for r in dedup.near_duplicates(d, "id", "t", ["b"]).collect()] == [(1, 2)]


def test_near_duplicates_query(spark, tmp_path):
    """All documents of one language and source meet, against brute force."""
    import difflib

    from corvane.plans import documents

    r = random.Random(11)
    words = ["".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randrange(2, 9))) for _ in range(150)]
    rows = []
    for i in range(60):
        text = " ".join(r.choice(words) for _ in range(r.randrange(1, 60)))
        place = (r.choice(["en", "fr", None]), r.choice(["s1", "s2"]))
        rows.append((len(rows), text, *place))
        for _ in range(2):
            copy = "".join(c if r.random() > 0.05 else r.choice(["", "é", c + "x"]) for c in text)
            rows.append((len(rows), copy, *(place if r.random() < 0.8 else ("de", "s1"))))
    rows += [(len(rows), None, "en", "s1"), (len(rows) + 1, "", "en", "s1"), (len(rows) + 2, "", "en", "s1")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for a, t, *p in rows:
        for b, u, *q in rows[a + 1 :]:
            if p == q and t is not None and u is not None and (s := difflib.SequenceMatcher(None, t, u, autojunk=False).ratio()) >= 0.92:
                want[a, b] = s
    got = documents.near_duplicates(spark, str(tmp_path)).collect()
    assert len(got) == len(want) > 30 and {(x.a, x.b): x.ratio for x in got} == want


def test_near_duplicates_blocks(spark, monkeypatch):
    """Small blocks and crowds of equal texts give brute force's pairs, both ways round; each text meets another once."""
    import difflib

    from corvane.functions import pairs

    r = random.Random(5)
    words = ["".join(r.choice("aeioumnrst") for _ in range(r.randrange(2, 6))) for _ in range(40)]
    texts = [" ".join(r.choice(words) for _ in range(r.choice([20, 60, 400]))) for _ in range(20)]
    texts += ["".join(c for c in t if r.random() > 0.03) for t in texts]
    texts += [texts[i] for i in (0, 0, 1, 25, 25)] + [texts[2][: len(texts[2]) // 2] + texts[2][: len(texts[2]) // 2]]
    r.shuffle(texts)
    want = {}
    for a, t in enumerate(texts):
        for b, u in enumerate(texts[a + 1 :], a + 1):
            if 2 * min(len(t), len(u)) >= 0.92 * (len(t) + len(u)) and (s := difflib.SequenceMatcher(None, t, u, autojunk=False).ratio()) >= 0.92:
                want[a, b] = s
            assert (a, b) not in want or pairs.common_reaches(pairs.Text(t), pairs.Text(u), 0.92)
    monkeypatch.setattr(dedup, "BLOCK", (3, 10_000))
    monkeypatch.setattr(dedup, "TASKS", 4)
    d = spark.createDataFrame(list(enumerate(texts)), "id int, t string").withColumn("b", F.lit(None).cast("string"))
    got = dedup.near_duplicates(d, "id", "t", ["b"]).collect()
    assert len(got) == len(want) > 20 and {(x.a, x.b): x.ratio for x in got} == want


def test_near_duplicates_prose(monkeypatch):
    """Prose of one small language, whose grams are all alike, is refused before any ratio is computed."""
    from corvane.functions import pairs

    r = random.Random(6)
    words = ["".join(r.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(r.randrange(1, 4))) for _ in range(300)]
    texts = [pairs.Text(" ".join(r.choice(words) for _ in range(n)), n, 1, 1) for n in [300] * 12 + [1500] * 4]
    monkeypatch.setattr(pairs, "_ratio_from", lambda *_: pytest.fail("a ratio was computed"))
    assert not list(pairs.near(texts, None, 0.92)) and pairs.common_reaches(texts[0], texts[0], 0.92)


def test_leakage(spark):
    a = spark.createDataFrame([(1, "p", "s1"), (2, "q", None), (3, "r", "s3")], "id int, path string, speaker string")
    b = spark.createDataFrame([(9, "q", "s1")], "id int, path string, speaker string")
    ids = leakage.identities(path=F.col("path"), speaker=F.col("speaker"))
    assert sorted((r.row, r.kind) for r in leakage.typed_leaks(a, b, "id", ids).collect()) == [(1, "speaker"), (2, "path")]
    assert [r.id for r in leakage.leaked(a, b, "path").collect()] == [2]
    assert sorted(r.id for r in leakage.without(a, b, ["path"]).collect()) == [1, 3]
    assert sorted(tuple(r) for r in leakage.disjoint(a, b, ["path", "speaker"]).collect()) == [("path", "q"), ("speaker", "s1")]
    c = leakage.coverage(a.select("path"), b.select("path").union(b.select("path")), ["path"]).collect()
    assert sorted((r.path, r.fault) for r in c) == [("p", "missing"), ("q", "repeated"), ("r", "missing")]
    o = leakage.overlay(spark.createDataFrame([("k", 0, 1, "base"), ("k", 1, 2, "late"), ("k", 1, 1, "first"), ("m", 0, 1, "only")], "k string, layer int, line int, v string"), ["k"], "layer", ["line"])
    assert sorted(r.v for r in o.collect()) == ["first", "only"]


def test_workset_adds_up(spark):
    rows = spark.createDataFrame(
        [
            (1, "a", 0.5, 10.0, "t", []),
            (2, "a", 0.9, 10.1, "t", []),
            (3, "b", 0.1, None, "t", ["missing_duration"]),
            (4, "c", 0.1, None, "t", ["invalid_duration"]),
            (5, "d", 0.2, 10.0, "t", []),
            (6, "d", 0.2, 10.1002, "t", []),
            (7, "e", 0.3, 2.0, "t", []),
            (8, "f", 0.9, None, "", None),
            (9, "f", 0.1, 3.0, "t", []),
            (10, "f", 0.5, None, "t", ["missing_duration"]),
            (11, "g", 0.5, 1.0, "t", []),
            (12, "g", 0.1, 1.0, "t", ["language_mismatch"]),
            (13, None, 0.1, 1.0, "t", []),
            (14, "h", 0.5, 1.0, None, []),
        ],
        "i int, clip string, quality double, duration double, text string, errors array<string>",
    )
    clips = workset.representatives(rows, "clip", "i", ["i"])
    got = {r.clip: (r.representative, r.duration, r.blocked) for r in clips.collect()}
    assert got == {
        "a": (2, 10.1, None),
        "b": (3, None, "missing_duration"),
        "c": (4, None, "invalid_duration"),
        "d": (5, 10.0, "duration_conflict"),
        "e": (7, 2.0, None),
        "f": (10, 3.0, None),
        "g": (11, 1.0, "language_mismatch"),
        "h": (14, 1.0, "missing_or_invalid_text"),
    }
    fate = workset.dispositions(rows, clips, spark.createDataFrame([("e",)], "clip string"), "clip", "i")
    assert {r.i: r.disposition for r in fate.collect()} == {1: "duplicate", 2: "eligible", 3: "blocked", 4: "blocked", 5: "blocked", 6: "duplicate", 7: "eval_excluded", 8: "duplicate", 9: "duplicate", 10: "eligible", 11: "blocked", 12: "duplicate", 13: "source_invalid", 14: "blocked"}
    assert sum(r.n for r in workset.inventory(fate, "clip").collect() if r.axis == "all") == 14
    two = spark.createDataFrame([("x", "en", None), ("x", "fr", None), ("y", "en", "duration_conflict")], "clip string, lang string, blocked string")
    assert sorted((r.clip, r.blocked) for r in workset.cross_language(two, "clip", "lang").collect()) == [("x", "cross_language_conflict")] * 2 + [("y", "duration_conflict")]


def test_select(spark):
    w = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "k string, w int")
    assert {r.k: r.quota for r in select.largest_remainder(w, "k", "w", 10).collect()} == {"a": 4, "b": 3, "c": 3}
    d = spark.createDataFrame([(i, "x" if i < 5 else "y") for i in range(7)], "i int, s string")
    assert max(r.turn for r in select.interleave(d, "s", ["i"], stop_at_shortest=True).collect()) == 2
    p = spark.createDataFrame([("c", i, n) for i, n in enumerate([5, 5, 20, 1, 1, 1])], "g string, o int, n int")
    assert [r.pack for r in select.greedy_packs(p, "g", "o", "n", 10, 2).orderBy("o").collect()] == [0, 0, 1, 2, 2, 3]


def test_place_matches_a_plain_loop(spark):
    random.seed(11)
    rows = [("en", i, f"s{random.randrange(3)}", f"t{random.randrange(9)}", f"p{random.randrange(70)}") for i in range(90)]
    size, cap, most, least = 8, 4, 2, 0.6
    seen, texts, index, own, mine, sources, want = set(), Counter(), 0, Counter(), [], Counter(), {}
    for _, i, s, t, p in rows:
        if p in seen:
            want[i] = ("duplicate_path", None)
        elif len(mine) >= cap and sources[s] >= cap:
            want[i] = ("source_capped", None)
        elif texts[t] + own[t] >= most:
            want[i] = ("text_capped", None)
        else:
            want[i] = ("open", index)
            mine.append((i, p))
            seen.add(p)
            sources[s] += 1
            own[t] += 1
            if len(mine) == size:
                good = len(own) >= least * size
                for j, q in mine:
                    want[j] = ("accepted", index) if good else ("refused_low_diversity", None)
                    if not good:
                        seen.discard(q)
                texts += own if good else Counter()
                index, own, mine, sources = index + 1, Counter(), [], Counter()
    d = spark.createDataFrame(rows, "lang string, i int, source string, key string, path string")
    got = select.place(d, "lang", ["i"], "source", "key", "path", size, cap / size, most, least)
    assert {r.i: (r.outcome, r.batch) for r in got.collect()} == want


def test_metrics(spark):
    d = spark.createDataFrame([(c / 10, c >= 4) for c in range(11)], "c double, y boolean")
    curve = {r.threshold: (r.answered, r.errors) for r in metrics.risk_curve(d, "c", F.col("y")).collect()}
    assert curve[0.4] == (7, 0) and curve[0.0] == (11, 4)
    assert metrics.threshold(d, "c", F.col("y"), 0.0).first()["threshold"] == 0.4
    r = metrics.nearest_rank(spark.createDataFrame([("g", v) for v in (1, 2, 2, 9)], "g string, v int"), ["g"], "v", [0.5, 0.99]).first()
    assert (r.p50, r.p99) == (2, 9)
    b = metrics.bootstrap(spark.createDataFrame([(i, i % 2, 1) for i in range(60)], "f int, a int, b int"), "f", "a", "b").first()
    assert b.low < b.ratio == 0.5 < b.high
    t = metrics.temperature(spark.createDataFrame([([2.0, 0.0], [1.0, 0.0]), ([2.0, 0.0], [0.0, 1.0]), ([2.0, 0.0], [1.0, 0.0])], "l array<double>, t array<double>"), "l", "t", steps=25)
    assert abs(t - 2 / 0.6931) < 0.02  # two of three right: the logit gap at the optimum is ln 2


LINES = [
    '{"audio_filepath":"a.wav","text":"hi","duration":1.5,"lang":"en"}',
    '{"wav_path":"b.wav","transcript":"yo","duration":"2.5"}',
    '{"audio":{"path":"c.wav"},"sentence":"s","duration":true}',
    "",
    "{bad",
    "[1]",
    '{"text":"no path"}',
    '{"audio_filepath":"d.wav","duration":-1}',
]


@pytest.fixture
def manifest(tmp_path):
    (tmp_path / "m.jsonl").write_text("\n".join(LINES) + "\n")
    return str(tmp_path / "m.jsonl")


def test_tolerant_reader(spark, manifest):
    rows = jsonl.read_tolerant(spark, manifest).collect()
    assert [r.reject_reason for r in rows] == [None, None, None, "blank_line", "malformed_json", "not_an_object", "missing_path", "missing_text"]
    assert [r.path for r in rows[:3]] == ["a.wav", "b.wav", "c.wav"]
    assert [r.duration for r in rows[:3]] == [1.5, 2.5, None]
    assert rows[2].duration_fault == "boolean_duration" and rows[7].duration_fault == "nonpositive_duration"


def test_strict_reader(spark, manifest, tmp_path):
    with pytest.raises(Exception, match="no "):
        jsonl.read_strict(spark, manifest).collect()
    (tmp_path / "ok.jsonl").write_text(LINES[0] + "\n\n")
    assert [tuple(r) for r in jsonl.read_strict(spark, str(tmp_path / "ok.jsonl")).collect()] == [("a.wav", 1.5, "hi", "en")]


def test_numbered_arrays_and_registry(spark, manifest, tmp_path):
    assert [r.line for r in jsonl.numbered(spark, manifest).orderBy("line").collect()] == list(range(1, 9))
    (tmp_path / "a.json").write_text('[{"audio_filepath":"x","text":"t"},{"text":"u"}]')
    assert jsonl.tolerant(jsonl.read_array(spark, str(tmp_path / "a.json"))).where("reject_reason is null").count() == 1
    reg = jsonl.Registry(jsonl.Spec("one", "en", (manifest,), prefix="/root", max_rows=2), jsonl.Spec("two", "fr", (manifest,), gated=True))
    assert [s.name for s in reg.select(gated=False)] == ["one"]
    got = reg.frame(spark)
    assert got.where("source = 'one'").count() == 2 and got.where("source = 'two'").count() == 8
    with pytest.raises(ValueError, match="twice"):
        jsonl.Registry(jsonl.Spec("a", "en", ()), jsonl.Spec("a", "en", ()))


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([(i, "ab"[i % 2], i * 0.1) for i in range(20)], "i int, lang string, q double")
    where = str(tmp_path / "pool")
    sinks.write_pool(d, where, ["lang"], F.desc("q"), 2)
    assert spark.read.parquet(where).count() == 20
    seal = sinks.seal(spark, where)
    seal.write.parquet(str(tmp_path / "seal"))
    sealed = spark.read.parquet(str(tmp_path / "seal"))
    assert sinks.broken(spark, where, sealed).count() == 0
    sinks.replace_parts(d.where("lang = 'a'").limit(3), where, ["lang"])
    assert spark.read.parquet(where).count() == 13
    assert sinks.broken(spark, where, sealed).count() > 0

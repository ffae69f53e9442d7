"""Dialects, comparisons, numerals, signals, evaluation, corrections, audits and planning."""

import io
import random
import wave
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corvane.functions import compare, dialect, numerals, signal
from corvane.operators import audit, corrections, evaluate, planning

LEXICON = {"scots": ["wee", "bonnie", "didnae*"], "texan": ["y'all", "fixin to", "howdy"]}


def column(spark, values, kind="string"):
    return spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")


def values(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_dialect(spark):
    d = column(spark, ["a wee bonnie lass", "howdy y'all, fixin to go", "plain words", "wee howdy"])
    got = values(d, dialect.detect(F.col("x"), LEXICON))
    assert [r["label"] for r in got] == ["scots", "texan", "unknown", "unknown"]
    assert got[0]["evidence"] == ["wee", "bonnie"] and got[2]["confidence"] == 0.0 and got[3]["confidence"] == 0.2
    seen = F.struct(F.lit("scots").alias("label"), F.lit(0.8).alias("confidence"))
    none = F.struct(F.lit("unknown").alias("label"), F.lit(0.2).alias("confidence"))
    one = column(spark, ["TEXAN "])
    assert tuple(values(one, dialect.reconcile(seen, F.col("x"), F.lit(0.9), ["scots", "texan"]))[0]) == ("scots", 0.8, "reconciled")
    assert tuple(values(one, dialect.reconcile(none, F.col("x"), F.lit(1.0), ["texan"]))[0]) == ("texan", 0.6, "claim")
    assert tuple(values(one, dialect.reconcile(none, F.col("x"), F.lit(1.0), []))[0]) == ("unknown", 0.2, "none")


def test_erasure(spark):
    d = spark.createDataFrame([(0, "a wee dram aye", "a small dram aye"), (1, "wee", "wee"), (2, "wee", "dram"), (3, "x", "y")], "i int, a string, b string")
    got = values(d, dialect.erasure(F.col("a"), F.col("b"), {"wee": ["small", "little"], "aye": ["yes"]}))
    assert [(r["kept"], r["replaced"], r["dropped"], r["severity"]) for r in got] == [(["aye"], ["wee"], [], 1.0), (["wee"], [], [], 0.0), ([], [], ["wee"], 1.0), ([], [], [], 0.0)]


def test_compare(spark):
    d = spark.createDataFrame([(0, "the cat sat", "the cat sat"), (1, "The cat, sat!", "the cat sat"), (2, "the 3 cats", "the three cats"), (3, "the dog", "the cat")], "i int, a string, b string")
    got = values(d, compare.divergence(F.col("a"), F.col("b")))
    assert [r["kind"] for r in got] == ["identical", "punctuation", "numbers", "words"] and got[3]["changes"] == ["cat > dog"]
    assert values(d, compare.added_letters(F.col("b"), F.col("a"))) == [0, 0, 0, 3]
    c = spark.createDataFrame([(0, "", ""), (1, "", "a"), (2, "ab c", "abd")], "i int, r string, h string")
    assert values(c, compare.cer(F.col("r"), F.col("h"))) == [0.0, 1.0, pytest.approx(1 / 3)]
    g = spark.createDataFrame([(0, "same text"), (1, ""), (2, "zzzzzz qqqq"), (3, "same text" + " same text" * 9)], "i int, o string")
    assert values(g, compare.guard(F.col("o"), [F.lit("same text")], 50.0)) == [None, "empty", None, "too_long"]
    assert values(g, compare.guard(F.col("o"), [F.lit("same text")]))[2] == "diverges"


def test_marks(spark):
    plain, marked = "كتب", "كَتَبَ"
    d = spark.createDataFrame([(0, plain, marked), (1, marked, plain), (2, plain, "كاتب"), (3, "كتّب", plain)], "i int, a string, b string")
    assert values(d, compare.marks_only(F.col("a"), F.col("b"))) == [None, None, "letters_changed", "critical_mark_dropped"]
    assert values(d, compare.project_marks(F.col("a"), F.col("b")))[0] == marked


def test_issues(spark):
    d = spark.createDataFrame([(0, "", 3.0), (1, "go on go on go on go on go on", 6.0), (2, "привет мир как", 2.0), (3, "short", 60.0), (4, "all is well here", 4.0)], "i int, x string, s double")
    assert values(d, compare.issues(F.col("x"), F.col("s"), "en")) == [["empty"], ["loop"], ["wrong_script"], ["truncated"], []]


def test_numerals(spark):
    d = column(spark, ["at 25:70 o'clock", "John 42:71 says", "on 31/02/2020", "on 12/31/2020", "٥0% of", "twenty thirty forty", "12 and 5000000000"])
    got = values(d, numerals.flags(F.col("x"), F.col("x"), "en"))
    assert got == [["odd_time"], [], ["odd_date"], [], ["digits_mixed", "odd_percentage"], ["numbers_spoken"], ["large_number"]]
    assert values(column(spark, ["١٢.٥", "x1", " 7 "]), numerals.ascii_number(F.col("x"))) == ["12.5", None, "7"]


def test_signal(spark):
    d = spark.createDataFrame([(0, [1.0, 2.0, 3.0])], "i int, x array<double>")
    assert values(d, signal.pad(F.col("x"), 5)) == [[1.0, 2.0, 3.0, 0.0, 0.0]] and values(d, signal.pad(F.col("x"), 2)) == [[1.0, 2.0]]
    assert values(d, signal.mask_spans(F.col("x"), F.array(F.struct(F.lit(1).alias("start"), F.lit(1).alias("length"))))) == [[1.0, 0.0, 3.0]]
    spans = values(d, signal.seeded_spans(F.lit("k"), 4, F.lit(100), 0.2))[0]
    assert all(0 <= s["start"] and s["start"] + s["length"] <= 100 and s["length"] <= 20 for s in spans)
    mixed = values(d, signal.mixed_at(F.col("x"), F.array(F.lit(1.0), F.lit(-1.0)), F.lit(0.0)))[0]
    assert mixed[0] - 1 == pytest.approx((14 / 3) ** 0.5)
    n = 37
    for _ in range(2):
        n = (n + 2 - 3) // 2 + 1
    assert values(column(spark, [37], "int"), signal.strided_length(F.col("x"))) == [n]
    raw = io.BytesIO()
    with wave.open(raw, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(8000), w.writeframes(bytes(8000))
    got = values(spark.createDataFrame([(0, raw.getvalue()), (1, b"no")], "i int, x binary"), signal.wave_header(F.col("x")))
    assert tuple(got[0]) == (8000, 1, 0.5) and tuple(got[1]) == (None, None, None)


def test_subsampled_lengths(spark, tmp_path):
    """Lengths of nothing and lengths a double cannot hold, as the SQL divides them."""
    import duckdb

    from corvane.plans import catalog, more

    rows = [(i, n) for i, n in enumerate([0, 1, 2, 3, 4, 5, 37, 2**53 + 1, 2**60 + 3, None])]
    spark.createDataFrame(rows, "doc_id bigint, n_chars bigint").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    want = duckdb.sql(catalog.SQL["subsampled_lengths"].replace("documents", f"'{tmp_path}/documents.parquet/*.parquet'")).fetchall()
    assert sorted(map(tuple, more.subsampled_lengths(spark, str(tmp_path)).collect())) == sorted(want) and dict(want)[0] == 1
    assert values(column(spark, [0, 1, 2], "bigint"), signal.strided_length(F.col("x"))) == [0, 1, 1]


def _mentions(df, piece):
    return df._jdf.queryExecution().optimizedPlan().toString().count(piece)


def _few_documents(spark, path):
    rows = [(6, ""), (13, "  "), (20, None), (1, "the which from and"), (2, "شلون وين الحين abc"), (3, "語語語 a"), (4, "see www.x.org 1:02:03")]
    spark.createDataFrame([(i, t, "fr" if i < 4 else "en") for i, t in rows], "doc_id bigint, text string, lang string").coalesce(1).write.parquet(f"{path}/documents.parquet")


def _as_sql(spark, path, name, query):
    import duckdb

    from corvane.plans import catalog

    want = duckdb.sql(catalog.SQL[name].replace("FROM documents", f"FROM '{path}/documents.parquet/*.parquet'")).fetchall()
    assert sorted(map(tuple, query(spark, str(path)).collect()), key=str) == sorted(want, key=str)


def test_votes_are_counted_once(spark, tmp_path):
    from corvane.plans import documents

    _few_documents(spark, tmp_path)
    assert _mentions(documents.language_vote_contradiction(spark, str(tmp_path)), "regexp_replace") <= 7
    rows = documents.language_vote_contradiction(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.guess) for r in rows) == [(1, "en"), (2, "ar"), (3, "zh")]


def test_lexicon_words_are_taken_once(spark, tmp_path):
    from corvane.plans import more

    _few_documents(spark, tmp_path)
    assert _mentions(more.lexicon_labels(spark, str(tmp_path)), "regexp_extract_all") == 1
    spark.createDataFrame([(1, "which from within and the inner 'that'"), (2, "")], "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/b/documents.parquet")
    _as_sql(spark, tmp_path / "b", "lexicon_labels", more.lexicon_labels)


def test_gate_patterns_are_sought_once(spark, tmp_path):
    from corvane.plans import documents

    _few_documents(spark, tmp_path)
    assert _mentions(documents.quality_gate(spark, str(tmp_path)), "SPEAKER|SPK") == 1


def test_gate_contamination_of_blank_texts(spark, tmp_path):
    from corvane.plans import rows

    _few_documents(spark, tmp_path)
    _as_sql(spark, tmp_path, "gate_contamination", rows.gate_contamination)


def test_evaluate(spark):
    refs = spark.createDataFrame([("a", "en", "r1", "the cat sat"), ("b", "en", "r2", "hello"), ("c", "fr", "r3", "oui")], "id string, lang string, rec string, reference string")
    preds = spark.createDataFrame([("a", "the bat sat"), ("c", "oui"), ("x", "?")], "id string, hypothesis string")
    assert sorted(tuple(r) for r in evaluate.coverage_faults(refs, preds, "id").collect()) == [("b", "missing"), ("x", "unexpected")]
    rows = evaluate.scored(refs, preds, "id")
    got = {(r.axis, r.value): r for r in evaluate.error_rates(rows, ["lang"]).collect()}
    assert got[("all", "all")].wer == pytest.approx(2 / 5) and got[("lang", "fr")].wer == 0 and got[("lang", "en")].n == 2
    same = evaluate.coverage_faults(refs, refs.withColumn("lang", F.lit("en")), "id", ["lang"]).collect()
    assert [tuple(r) for r in same] == [("c", "differs:lang")]
    a = spark.createDataFrame([(i, i % 20, 1, 2) for i in range(100)], "id int, f int, e int, u int")
    r = evaluate.paired(a, a.withColumn("e", F.lit(2)), "id", "f", "e", "u", 100).first()
    assert r.ratio == 0.5 and r.low == r.high == 0.5


def test_corrections(spark):
    def service(texts):
        if any("poison" in x for x in texts):
            raise ValueError
        return [x.replace("teh", "the") if "far" not in x else "nothing like it" for x in texts]

    d = column(spark, ["teh cat sat", "poison pill", "far away words", "", None])
    got = {r.i: (r.corrected, r.verdict) for r in corrections.corrected(d, "x", service).collect()}
    assert got == {0: ("the cat sat", "accepted"), 1: ("poison pill", "unanswered"), 2: ("far away words", "diverges"), 3: ("", "accepted"), 4: (None, "accepted")}
    again = {r.i: (r.attempt, r.verdict) for r in corrections.with_retries(d, "i", "x", [service, corrections.identity]).collect()}
    assert again == {0: (0, "accepted"), 1: (1, "accepted"), 2: (1, "accepted"), 3: (0, "accepted"), 4: (0, "accepted")}
    a = spark.createDataFrame([(0, '[{"i":1,"t":"b"},{"i":0,"t":"a"}]', 2), (1, '[{"i":0,"t":"a"},{"i":0,"t":"b"}]', 2), (2, "none", 1)], "i int, a string, n int")
    got = {r.i: r["items"] and [x.t for x in r["items"]] for r in corrections.parsed_answers(a, "a", "n").collect()}
    assert got == {0: ["a", "b"], 1: None, 2: None}
    v = spark.createDataFrame([(1, "j1", "x", "x"), (1, "j2", "x", "x"), (2, "j1", "y", "x"), (2, "j2", "y", "x"), (3, "j1", "x", "x"), (4, "j1", "x", "x"), (4, "j2", "y", "x")], "r int, judge string, label string, target string")
    assert {r.r: r.resolution for r in corrections.votes(v, "r", "judge", "label", "target").collect()} == {1: "confirmed", 2: "contradicted", 3: "open", 4: "split"}


def test_audit(spark):
    d = spark.createDataFrame([("en", "p1", "hi <b>", 1.5), ("en", "p1", "Hi b", None), ("fr", "p2", "", -1.0), ("fr", "p3", "http://x", 40.0)], "lang string, path string, text string, d double")
    got = {r.lang: r for r in audit.census(d, "text", "d", "path", "lang").collect()}
    assert (got["en"].n, got["en"].html, got["en"].distinct_paths, got["en"].distinct_texts, got["en"].no_duration) == (2, 1, 1, 1, 1)
    assert (got["fr"].empty, got["fr"].url, got["fr"].nonpositive, got["fr"].bin9) == (1, 1, 1, 1)
    assert audit.census(d, "text", None, "path").first().n == 4
    m = spark.createDataFrame([("b1", "a"), ("b1", "b"), ("b2", "c"), ("b2", "c")], "batch string, path string")
    s = spark.createDataFrame([("b1", "a"), ("b1", "b"), ("b2", "c")], "batch string, path string")
    faults = {r.batch: r.faults for r in audit.batch_faults(m, s, spark.createDataFrame([("b",)], "path string"), "path", 2, "batch").collect()}
    assert faults == {"b1": ["leaks_held_out"], "b2": ["repeated_path", "sidecar_out_of_step"]}
    b = spark.createDataFrame([("en", 1), ("en", 2), ("fr", 7)], "lang string, label int")
    assert sorted((r.lang, r.label) for r in audit.bundle(b, "lang", "label").collect()) == [("en", 1), ("fr", 7)]
    o = spark.createDataFrame([("en", "accepted"), ("en", "rejected"), ("fr", "accepted")], "lang string, status string")
    r = {x.lang: (x.complete, x.by_status) for x in audit.reconcile(d.select("lang"), o, ["lang"], "status").collect()}
    assert r == {"en": (True, {"accepted": 1, "rejected": 1}), "fr": (False, {"accepted": 1})}
    assert {(x.axis, x.value): x.n for x in audit.axes(d, ["lang"]).collect()} == {("lang", "en"): 2, ("lang", "fr"): 2}
    reg = spark.createDataFrame([("s1", True), ("s2", False)], "source_id string, permitted boolean")
    rows = spark.createDataFrame([(1, ["s1"]), (2, ["s2", "s9"])], "r int, ids array<string>")
    assert sorted((x.r, x.source_id, x.fault) for x in audit.registered(rows, "r", "ids", reg).collect()) == [(2, "s2", "not_permitted"), (2, "s9", "unknown")]
    c = spark.createDataFrame([("x", {"a": 1, "b": 2}), ("x", {"a": 3})], "w string, m map<string,int>")
    assert {(x.w, x.key): x.n for x in audit.merged_counters(c, "m", "w").collect()} == {("x", "a"): 4, ("x", "b"): 2}


def test_planning(spark):
    d = spark.range(3000).select(F.col("id").cast("int").alias("i"), (F.col("id") % 1000).alias("family"))
    s = planning.splits(d, "family", "7", {"train": 8, "dev": 1, "test": 1}, {"test": [5, 6]})
    rows = s.collect()
    by = {}
    assert all(by.setdefault(r.family, r.split) == r.split for r in rows) and by[5] == by[6] == "test"
    share = Counter(by.values())
    assert 700 < share["train"] < 880 and share["dev"] > 60
    assert values(column(spark, [2, 4, 16, 64, 65, 300], "int"), planning.option_bin(F.col("x"))) == ["2", "3-5", "6-16", "17-64", "65-255", None]
    short = {r.split: r.missing for r in planning.shortfall(s, "split", {"train": 10**6, "gone": 5}).collect()}
    assert short["gone"] == 5 and short["train"] == 10**6 - sum(r.split == "train" for r in rows)
    sample = planning.audit_sample(s, ["split"], "family", 20, "s").collect()
    assert Counter(r.split for r in sample) == {"train": 20, "dev": 20, "test": 20}
    reviews = spark.createDataFrame([("c", f, f == 0) for f in range(50) for _ in range(2)], "cell string, family int, bad boolean")
    b = planning.audit_bounds(reviews, ["cell"], "family", F.col("bad"), 0.15).first()
    assert (b.families, b.errors, b.passed) == (50, 1, True)
    random.seed(1)
    pool = spark.createDataFrame([(i, i // 2, f"c{i % 5}", [p := random.random(), 1 - p]) for i in range(200)], "i int, family int, cell string, p array<double>")
    got = planning.acquire(pool, "i", "family", "cell", F.col("p"), 30, "s").collect()
    assert len(got) == 30 == len({r.family for r in got}) and sum(r.reason == "random" for r in got) == 6
    worlds = planning.budget_worlds(d.limit(300), "i", "w").collect()
    assert {r.answer for r in worlds} == {"fits", "exceeds", "insufficient"}
    assert all((r.answer == "insufficient") == (None in (r.total, r.spent, r.requested)) for r in worlds)
    g = spark.createDataFrame([(0, "abcdef", [(1, 3, "bc")]), (1, "abcdef", [(1, 3, "xx")])], "i int, doc string, s array<struct<start:int,end:int,text:string>>")
    assert values(g, planning.grounded(g, "doc", "s")) == [True, False]


def test_selection_extras(spark):
    from corvane.operators import select

    d = spark.createDataFrame([(i, "ab"[i % 2], 10 - i) for i in range(10)], "i int, g string, v int").withColumn("w", F.lit(0))
    assert [r.i for r in select.sort_within(d, "w", "g", "v", "i").where("g = 'a'").orderBy("place").collect()] == [8, 6, 4, 2, 0]
    got = select.draws(d, "g", {"a": 7, "b": 3, "none": 4}, "s").collect()
    assert Counter(r.g for r in got) == {"a": 7, "b": 3}
    assert sorted(map(tuple, got)) == sorted(map(tuple, select.draws(d, "g", {"a": 7, "b": 3}, "s").collect()))
    a = spark.createDataFrame([(i, f"a{i}") for i in range(6)], "id bigint, t string")
    b = spark.createDataFrame([(i, f"b{i}") for i in range(4)], "id bigint, t string")
    p = select.pairs(a, b, "id", 100).collect()
    assert len(p) == 24 == len({(r.t_i, r.t_j) for r in p})
    assert select.highest_averages({"x": 60, "y": 30, "z": 10, "n": 0}, 10) == {"x": 6, "y": 3, "z": 1}
    assert select.least_loaded({"a": 5, "b": 4, "c": 3, "d": 1}, 2) == {"a": 0, "b": 1, "c": 1, "d": 0}


def test_conventions(spark):
    from corvane.functions import rules
    from corvane.functions import text as t

    d = column(spark, ["hello ,world !! yes....no", "teh cat", "i am. we go"])
    assert values(d, t.tidy_punctuation(F.col("x")))[0] == "hello, world! yes… no"
    assert values(d, t.replace_words(F.col("x"), {"teh": "the"}))[1] == "the cat"
    assert values(d, t.sentence_case(F.col("x")))[2] == "I am. We go"
    assert values(column(spark, ["абв", "hello", "नमस्ते दुनिया", "abc नम"]), t.dominant_script(F.col("x"), 3)) == [None, "latin", "devanagari", "latin"]
    e = spark.createDataFrame([(0, "wee lad", "small lad"), (1, "wee lad", "wee lad")], "i int, a string, b string")
    assert values(e, compare.formalised(F.col("a"), F.col("b"), {"wee": "small"})) == [["wee > small"], []]
    f = spark.createDataFrame([(0, 5, None), (1, None, 2)], "i int, x int, y int")
    assert values(f, rules.said(("x is %d.", [F.col("x")]), ("y is %d.", [F.col("y")]))) == ["x is 5.", "y is 2."]
    assert values(f, rules.faults(small=F.col("x") < 3, even=F.col("y") % 2 == 0)) == [["small"], []]

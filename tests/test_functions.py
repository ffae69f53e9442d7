"""Text, number and rule functions against plain Python."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from corvane.functions import numeric, rules, unicode
from corvane.functions import text as t
from corvane.operators import gates

TEXTS = ["", " ", "Hello hello WORLD", "aaaaaaab", "a1b2 c3", "سلام دنيا يا", "सीखना 123", "中文 text 中", "اللُّغَة", "x" * 30, "one, two; three. four", None]


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def values(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def run(text):
    best = n = 1
    for a, b in zip(text, text[1:], strict=False):
        n = n + 1 if a == b and not b.isspace() else 1
        best = max(best, n)
    return best if text else 0


def test_longest_run(spark):
    got = values(column(spark, TEXTS), t.longest_run(F.col("x")))
    assert got == [0 if s is None else run(s) for s in TEXTS]


def test_text_key(spark):
    got = values(column(spark, TEXTS), t.text_key(F.col("x")))
    assert got == [s and "".join(c for c in s.lower() if unicodedata.category(c)[0] in "LN") for s in TEXTS]


def test_script_ratio(spark):
    d = column(spark, ["abc def", "ab سلام", "123", ""])
    assert values(d, t.script_ratio(F.col("x"), F.lit("en"))) == [1.0, 2 / 6, 0.0, 0.0]
    assert values(d, t.script_ratio(F.col("x"), F.lit("de"))) == [1.0] * 4


@pytest.mark.parametrize(
    ("lang", "text", "want"),
    [
        ("en", "  a <b>x</b>\x01 b​c  ", "a x bc"),
        ("ar", "س١٢ , ـسلام؟", "س12 ، سلام؟"),
        ("hi", "राम | १२", "राम । 12"),
        ("zh", "你 好,世 界", "你好，世界"),
        ("en", "“quoted”", '"quoted"'),
    ],
)
def test_normalize(spark, lang, text, want):
    assert values(column(spark, [text]), t.normalize(F.col("x"), F.lit(lang))) == [want]


def test_top_word_share_and_richness(spark):
    d = column(spark, ["the the the cat", "a b c d", ""])
    assert values(d, t.top_word_share(F.col("x"))) == [0.75, 0.25, 0.0]
    assert values(d, t.richness(F.col("x"), F.lit("en")))[2] == 0.0


def test_dialect_and_tokens(spark):
    assert values(column(spark, ["عايز ايه دلوقتي", "كتاب", "plain"]), t.dialect(F.col("x"))) == ["egyptian", "msa", "unknown"]
    assert values(column(spark, ["Marketing. marketing [noise] vitamin-C"]), t.latin_tokens(F.col("x"))) == [["marketing", "vitamin-c"]]


def test_numbers(spark):
    d = column(spark, ["12,000 and 5", "no"])
    assert values(d, t.numbers(F.col("x"))) == [["12000", "5"], []]
    assert values(d, t.dropped_numbers(F.lit("12000"), F.col("x"))) == [["5"], []]
    assert values(column(spark, ["5000000000"]), t.large_numbers(F.col("x"))) == [["5000000000"]]


def test_envelope(spark):
    got = values(column(spark, ["language English<asr_text>hi\nthere", "plain"]), t.envelope(F.col("x")))
    assert [tuple(r) for r in got] == [("English", "hi\nthere"), (None, "plain")]


def test_gate(spark):
    d = column(spark, ["A clean sentence of words.", "", None, "http://x.y see", "aaaaaaaa bbb", "a", "zzz zzz zzz zzz zzz zzz zzz b", "12345"])
    got = values(d, gates.gate(F.col("x"), F.lit("en")))
    assert [r["reasons"] for r in got] == [[], ["empty_text"], ["empty_text"], ["url"], ["char_run"], ["too_short"], ["word_repeat"], ["no_letters"]]
    assert got[0]["passed"] and got[0]["quality"] == 1.0 and got[4]["quality"] == 0.0


def test_gate_duration(spark):
    g = gates.gate(F.lit("some words here"), F.lit("en"), F.col("x"), gates.GateConfig(gate_duration=True))
    got = values(column(spark, [None, 0.1, 2.0, 29.0], "double"), g)
    assert [r["reasons"] for r in got] == [["duration_missing_or_nonpositive"], ["duration_out_of_band"], [], ["speech_rate_low"]]


def test_gate_require(spark):
    with pytest.raises(Exception, match="rule broken: positive"):
        gates.require(column(spark, [1, -1], "int"), positive=F.col("x") > 0).collect()


def test_unicode_functions(spark):
    d = column(spark, ["é", "ﬁne Straße", None])
    assert values(d, unicode.nfc(F.col("x"))) == ["é", "ﬁne Straße", None]
    assert values(d, unicode.fold_key(F.col("x"))) == ["é", "finestrasse", None]
    j = column(spark, ['{"b":1,"a":[2]}', '{"a":1,"a":2}', '{"a":NaN}', "nope"])
    assert values(j, unicode.canonical_json(F.col("x"))) == ['{"a":[2],"b":1}', None, None, None]
    s = column(spark, ['```json\n[{"i":0},{"i":1', "<think>x</think>[1,2]", "none"])
    assert values(s, unicode.salvage_json(F.col("x"))) == ['[{"i": 0}]', "[1, 2]", None]


def test_edits():
    assert unicode.edits("a b c".split(), "a x c d".split()) == (1, 0, 1)
    assert unicode.edits([], ["a"]) == (0, 0, 1)
    assert unicode.edits(list("kitten"), list("sitting")) == (2, 0, 1)


def test_error_counts(spark):
    d = spark.createDataFrame([(0, "the cat sat", "the bat sat down"), (1, "", "x")], "i int, r string, h string")
    got = values(d, unicode.error_counts(F.col("r"), F.col("h")))
    assert (got[0]["word_substitutions"], got[0]["word_insertions"], got[0]["words"]) == (1, 1, 3)
    assert got[1]["chars"] == 0 and got[1]["char_errors"] == 1


def test_merge():
    assert unicode._merge("a b c d", "c d e") == "a b c d e"
    assert unicode._merge("one", "two") == "two" and unicode._merge("one two", "three four") == "three four"


def test_numeric(spark):
    d = spark.createDataFrame([([1.0, 2.0, 3.0],)], "x array<double>").withColumn("i", F.lit(0))
    p = values(d, numeric.softmax(F.col("x")))[0]
    assert abs(sum(p) - 1) < 1e-12 and p[2] > p[1] > p[0]
    assert values(d, numeric.argmax(F.col("x"))) == [2]
    assert values(d, numeric.nearest_rank(F.col("x"), 0.5)) == [2.0]
    assert values(d, numeric.exclusive_quantile(F.col("x"), 0.95)) == [3.0]
    n = 101
    a = numeric.coprime(n, 37)
    assert sorted(r[0] for r in spark.range(n).select(numeric.affine(F.col("id"), a, 5, F.lit(n))).collect()) == list(range(n))
    i, j = numeric.diagonal_pair(F.col("id"), 6, 4)
    assert len({tuple(r) for r in spark.range(24).select(i, j).collect()}) == 24


def test_rules(spark):
    d = spark.createDataFrame([(0, 1, True, None), (1, None, True, True), (2, 9, False, None)], "i int, x int, a boolean, b boolean")
    assert values(d, rules.budget(F.col("x"), F.lit(1), F.lit(5))) == ["fits", "insufficient", "exceeds"]
    assert values(d, rules.policy([F.col("a"), F.col("b")], every=True)) == ["insufficient", "eligible", "ineligible"]
    assert values(d, rules.safety([([F.col("a"), F.col("b")], "stop")], "go")) == ["escalate", "stop", "go"]
    assert values(d, rules.slot(F.lit(None).cast("int"), F.col("x"))) == [False, True, False]
    assert values(d, rules.route(F.array(F.lit("pay"), F.lit("bill")), {"money": ["pay", "bill"], "other2": ["pay"]})) == ["money"] * 3
    assert values(d, rules.compare(F.lit(1), F.lit(1000), "==", F.lit(1000), F.lit(1))) == ["true"] * 3


def test_merge_of_rolling_windows(spark):
    """Against a plain restatement: the longest common run that begins the new text, anywhere in the old one."""
    import random

    from pyspark.sql import functions as F

    from corvane.functions import unicode

    r = random.Random(3)
    cases = [("a b c d", "b c x", "a b c x"), ("a b c d", "x y", "x y"), ("", "a", "a"), ("a b", "", "a b"), ("Hello, World again", "hello world now", "hello world now"), ("abcdef", "cdefg", "abcdefg"), ("abcdef", "xyz", "xyz"), ("a b", "b c", "b c")]
    for _ in range(300):
        a, b = (" ".join(r.choice("ab c d".split()) for _ in range(r.randrange(1, 8))) for _ in range(2))
        x, y = a.split(), b.split()
        spaced = " " in a + b
        if spaced:
            runs = []
            for at in range(len(x)):
                n = 0
                while n < min(len(x) - at, len(y)) and x[at + n] == y[n]:
                    n += 1
                runs.append((n, -at))
            best = max(runs)
            want = " ".join(x[: -best[1]] + y) if best[0] >= 2 else b
            cases.append((a, b, want))
    got = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a string, b string").select("i", unicode.merge_transcripts(F.col("a"), F.col("b")).alias("m")).collect()
    assert {x.i: x.m for x in got} == {i: w for i, (*_, w) in enumerate(cases)}

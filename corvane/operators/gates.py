"""Row gates: every failed rule of a row as data, never a dropped row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import text as t

# Patterns of unrecoverable contamination and speech-rate bands in units a second.
NOISE = r"\[[^\]\n]{1,40}\]"
URL = r"(?iuU)(?:https?://|www\.)\S+"
SPEAKER = r"(?iuU)(?:^|\s)(?:SPEAKER|SPK|MALE|FEMALE|M|F)\s*[:#]?\s*\d*\s*[:|]"
TIMESTAMP = r"(?U)(?=\d)\b\d{1,2}:\d{2}:\d{2}\b"
RATES = {"ar": (0.4, 7.0), "en": (0.4, 7.0), "hi": (0.4, 7.0), "ml": (0.4, 7.0), "zh": (0.8, 12.0)}


@dataclass(frozen=True)
class GateConfig:
    """Inclusive thresholds; duration rules are off unless ``gate_duration``."""

    gate_duration: bool = False
    min_duration: float = 0.5
    max_duration: float = 30.0
    min_chars: int = 2
    max_chars: int = 2000
    min_script_ratio: float = 0.8
    max_vocalisation: float = 0.4
    max_char_run: int = 4
    max_word_share: float = 0.5
    min_richness: float = 0.0


def contamination(text: Column) -> Column:
    """Why a text cannot be saved; the marks a pattern needs are looked for first."""
    marked = F.contains(text, F.lit(":")) | F.contains(text, F.lit("|"))
    return F.array_compact(
        F.array(
            F.when(F.contains(text, F.lit("�")), "replacement_char"),
            F.when(F.regexp_like(text, F.lit(NOISE)), "noise_marker"),
            F.when(F.regexp_like(text, F.lit(URL)), "url"),
            F.when(marked & (F.regexp_like(text, F.lit(SPEAKER)) | F.regexp_like(text, F.lit(TIMESTAMP))), "speaker_label_or_timestamp"),
            F.when(~F.regexp_like(text, F.lit(r"\p{L}")), "no_letters"),
        )
    )


def measures(text: Column, lang: Column) -> Column:
    """What the gate's thresholds are held against."""
    top = F.when(lang == "zh", F.lit(None).cast("double")).otherwise(t.top_word_share(text))
    marks = F.when(lang == "ar", t.vocalisation(text))
    return F.struct(F.length(text).alias("chars"), t.script_ratio(text, lang).alias("ratio"), t.longest_run(text).alias("run"), t.unit_count(text, lang).alias("units"), top.alias("top"), marks.alias("marks"), t.richness(text, lang).alias("rich"))


def gated(df: DataFrame, text: str, lang: str, duration: str | None = None, config: GateConfig = GateConfig(), name: str = "gate") -> DataFrame:
    """df with the gate's struct; measures are a projection of their own, so each is computed once a row."""
    d = F.col(duration) if duration else None
    measured = df.withColumn("__measures", measures(F.col(text), F.col(lang)))
    return measured.withColumn(name, gate(F.col(text), F.col(lang), d, config, m=F.col("__measures"))).drop("__measures")


def gate(text: Column, lang: Column, duration: Column | None = None, config: GateConfig = GateConfig(), require_duration: bool = True, m: Column | None = None) -> Column:
    """struct(passed, reasons, chars, script_ratio, char_run, units, top_word, richness, quality, composite) of a text.

    Duration reasons stand alone, then emptiness, then contamination; only a text free of those is measured for the rest.
    """
    d = duration if duration is not None else F.lit(None).cast("double")
    known = F.coalesce(d > 0, F.lit(False))
    early = F.lit(None).cast("string")
    if config.gate_duration:
        if require_duration:
            early = F.when(~known, "duration_missing_or_nonpositive")
        early = F.coalesce(early, F.when(known & ~d.between(config.min_duration, config.max_duration), "duration_out_of_band"))
    blank = text.isNull() | ~F.regexp_like(text, F.lit(r"(?U)\S"))
    early = F.coalesce(early, F.when(blank, "empty_text"))
    m = measures(text, lang) if m is None else m
    chars, ratio, run, units, top, marks, rich = (m[c] for c in ("chars", "ratio", "run", "units", "top", "marks", "rich"))
    rate = F.when(known, units / d)
    low, high = (F.coalesce(*(F.when(lang == k, F.lit(v[i])) for k, v in RATES.items())) for i in (0, 1))
    late = [
        F.when(chars < config.min_chars, "too_short"),
        F.when(chars > config.max_chars, "too_long"),
        F.when(ratio < config.min_script_ratio, "script_ratio_low"),
        F.when(marks > config.max_vocalisation, "over_vocalized"),
        F.when(run > config.max_char_run, "char_run"),
        F.when((units > 5) & (top > config.max_word_share), "word_repeat"),
        F.when(F.lit(config.min_richness > 0) & (rich < config.min_richness), "low_richness"),
    ]
    if config.gate_duration:
        late += [F.when(rate < low, "speech_rate_low"), F.when(rate > high, "speech_rate_high")]
    reasons = t.bound(contamination(text), lambda dirty: F.when(early.isNotNull(), F.array(early)).when(F.size(dirty) > 0, dirty).otherwise(F.array_compact(F.array(*late))))
    pace = F.when(rate.isNull() | low.isNull(), 1.0).otherwise(F.greatest(F.lit(0.0), 1 - F.abs(rate - (low + high) / 2) / ((high - low) / 2)))
    clean = F.round(F.least(ratio, F.lit(1.0)) * pace * F.when(chars < 20, 0.85).otherwise(1.0), 4)

    def verdict(reasons: Column) -> Column:
        passed = F.size(reasons) == 0
        quality = F.when(passed, clean).otherwise(0.0)
        return F.struct(passed.alias("passed"), reasons.alias("reasons"), chars.alias("chars"), ratio.alias("script_ratio"), run.alias("char_run"), units.alias("units"), top.alias("top_word"), rich.alias("richness"), quality.alias("quality"), F.round(quality * rich, 4).alias("composite"))

    return t.bound(reasons, verdict)


def hard_checks(text: Column, original: Column, lang: str) -> Column:
    """Reasons to refuse a cleaned text: empty, wrong script, shrunk below 0.3 or grown over 3 times, foreign characters."""
    a, b = F.length(text), F.length(original)
    return F.array_compact(
        F.array(
            F.when(t.one_space(text) == "", "empty"),
            F.when(~t.has_script(text, lang), "no_expected_script"),
            F.when((b > 0) & (a < 0.3 * b), "shrunk"),
            F.when((b > 0) & (a > 3 * b), "grown"),
            F.when(F.size(t.foreign_chars(text, original)) > 0, "foreign_characters"),
        )
    )


def soft_flags(text: Column, original: Column, lang: str) -> Column:
    """Advisory flags of a cleaned text: Latin words lost, numbers dropped, digits mixed, script share down by a tenth."""
    share = [t.script_ratio(x, F.lit(lang)) for x in (text, original)]
    return F.array_compact(
        F.array(
            F.when(F.size(t.lost_latin(text, original)) > 0, "latin_lost"),
            F.when(F.size(t.dropped_numbers(text, original)) > 0, "numbers_dropped"),
            F.when(t.mixed_digits(text), "digits_mixed"),
            F.when(F.size(t.large_numbers(text)) > 0, "large_number"),
            F.when(share[0] < share[1] - 0.1, "script_ratio_drop"),
        )
    )


def reason_census(df: DataFrame, reasons: str, *by: str) -> DataFrame:
    """Rows per reason (and ``by``); a row with several reasons counts under each."""
    return df.select(*by, F.explode(reasons).alias("reason")).groupBy(*by, "reason").agg(F.count("*").alias("n"))


def require(df: DataFrame, **rules: Column) -> DataFrame:
    """df, whose evaluation fails at the first row that breaks a rule, with the rule's name."""
    for name, rule in rules.items():
        df = df.where(F.when(F.coalesce(rule, F.lit(False)), True).otherwise(F.raise_error(F.lit(f"rule broken: {name}")).cast("boolean")))
    return df

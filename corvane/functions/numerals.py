"""Checks of written numbers, dates and percentages in transcripts, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions import text as t

# Number words that should have been written as digits, and cues that digits are a time of day.
SPOKEN = {
    "ar": "صفر|واحد|اثنين|ثلاثة|أربعة|خمسة|ستة|سبعة|ثمانية|تسعة|عشرة|عشرون|ثلاثون|أربعون|خمسون|ستون|سبعون|ثمانون|تسعون|مئة|ألف|مليون|مليار",
    "en": "twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety|hundred|thousand|million|billion",
}
TIME_CUE = "(?i)o'clock|[ap]\\.?m\\.?\\b|hour|minute|second|ساعة|صباح|مساء|上午|下午"


def western(text: Column) -> Column:
    """All digit alphabets to Western digits."""
    out = text
    for alphabet in (t.ARABIC_DIGITS, t.PERSIAN_DIGITS, t.DEVANAGARI_DIGITS, t.FULL_WIDTH_DIGITS):
        out = t.fold_digits(out, alphabet)
    return out


def spoken(text: Column, lang: str) -> Column:
    """Number words left unconverted, in order."""
    return F.regexp_extract_all(text, F.lit(rf"(?iU)\b({SPOKEN[lang]})\b"), F.lit(1)) if lang in SPOKEN else F.array().cast("array<string>")


def odd_times(text: Column) -> Column:
    """Clock times with impossible fields, where the text speaks of time at all: scores and verses look alike."""
    found = F.regexp_extract_all(western(text), F.lit(r"\b(\d{1,2}:\d{2}(?::\d{2})?)\b"), F.lit(1))
    bad = F.filter(found, lambda x: (F.get(F.split(x, ":"), F.lit(0)).cast("int") > 24) | (F.get(F.split(x, ":"), F.lit(1)).cast("int") > 59) | (F.coalesce(F.get(F.split(x, ":"), F.lit(2)).cast("int"), F.lit(0)) > 59))
    return F.when(F.regexp_like(text, F.lit(TIME_CUE)), bad).otherwise(F.array().cast("array<string>"))


def odd_dates(text: Column) -> Column:
    """Day/month/year groups that are a date in neither order."""
    found = F.regexp_extract_all(western(text), F.lit(r"\b(\d{1,2}/\d{1,2}/\d{2,4})\b"), F.lit(1))
    part = lambda x, i: F.get(F.split(x, "/"), F.lit(i)).cast("int")
    return F.filter(found, lambda x: ~(t.valid_month_day(part(x, 1), part(x, 0)) | t.valid_month_day(part(x, 0), part(x, 1))))


def odd_percentages(text: Column) -> Column:
    """Percentages written in mixed digit alphabets."""
    found = F.regexp_extract_all(text, F.lit(r"([\d٠-٩]+(?:[.,٫][\d٠-٩]+)?\s*[%٪])"), F.lit(1))
    return F.filter(found, t.mixed_digits)


def flags(text: Column, original: Column, lang: str) -> Column:
    """Names of all number checks a text fails."""
    return F.array_compact(
        F.array(
            F.when(t.mixed_digits(text), "digits_mixed"),
            F.when(F.size(spoken(text, lang)) > 2, "numbers_spoken"),
            F.when(F.size(t.large_numbers(text)) > 0, "large_number"),
            F.when(F.size(odd_times(text)) > 0, "odd_time"),
            F.when(F.size(odd_dates(text)) > 0, "odd_date"),
            F.when(F.size(odd_percentages(text)) > 0, "odd_percentage"),
            F.when(F.size(t.dropped_numbers(western(text), western(original))) > 0, "numbers_dropped"),
        )
    )


def ascii_number(value: Column) -> Column:
    """A numeral in any digit alphabet as plain decimal text; null if it is none."""
    plain = western(F.trim(value))
    return F.when(F.regexp_like(plain, F.lit(r"^[+-]?\d+(\.\d+)?$")), plain)

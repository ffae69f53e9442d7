"""Text functions as Column expressions: everything here runs inside the JVM.

Functions take and return Columns and never look at data; null in gives null out unless said
otherwise. Character classes are written as explicit ranges so that other engines read them alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scripts and marks by code point range, and one-to-one letter, digit and quote maps.
LATIN = "A-Za-z"
ARABIC = "ء-يٱ-ۓ"
ARABIC_WIDE = "ء-ي٠-٩ٱ-ە"
HAN = "㐀-䶿一-鿿豈-﫿"
DEVANAGARI = "ऀ-ॿ"
MALAYALAM = "ഀ-ൿ"
SCRIPTS = {"ar": ARABIC, "zh": HAN, "hi": DEVANAGARI, "ml": MALAYALAM, "en": LATIN}
CRITICAL_MARKS = "ًٌٍّ"
OTHER_MARKS = "َُِْٰٕٖٓٔ"
ALL_MARKS = "ؐ-ًؚ-ٰٟ"
TATWEEL = "ـ"
WESTERN = "0123456789"
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
PERSIAN_DIGITS = "۰۱۲۳۴۵۶۷۸۹"
DEVANAGARI_DIGITS = "०१२३४५६७८९"
FULL_WIDTH_DIGITS = "０１２３４５６７８９"
QUOTES = ("“”„‟‘’‚‹›", '""""' + "'''''")
NOISE_ZW = "​‎‏‪-‮﻿⁠"
JOINERS = "‌‍"
CJK_MARKS = "　-。〈-』【】〔〕—‘’“”…·！（），：；？～"
CJK_PUNCTUATION = (",.?!;:()", "，。？！；：（）")
BRACKETED = "noise|music|laughter|applause|silence|inaudible|crosstalk"
DIALECTS = {
    "gulf": r"يا|وش|ليش|كيف|مو|ما\s+هو|الله\s+ي|الحين|وين|شنو|شلون|يبي|اشوي",
    "levantine": r"شو|ليش|كيف|هلق|وين|عم\s+ب|بدي|عنجد|كتير|هيك|منيح|إشي",
    "egyptian": r"ايه|ليه|ازاي|دلوقتي|فين|عايز|خالص|اوي|كده|بتاع|حاجة",
    "maghrebi": r"واش|علاش|كيفاش|دابا|فين|بغيت|بزاف|هاد|ديال",
    "iraqi": r"شلون|اكو|ماكو|هذني|يريد|گام|شنو|مو|جان|هاي|هاذا",
}
LANGUAGE_NAMES = {"english": "en", "arabic": "ar", "hindi": "hi", "malayalam": "ml", "chinese": "zh", "mandarin": "zh"}


def count(text: Column, pattern: str) -> Column:
    """Matches of a pattern."""
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def chars(text: Column, inside: str, letter: bool = False) -> Column:
    """Characters of a class (letters among them): the length of what is left without the runs of others, which takes no array of matches."""
    return F.length(drop(text, rf"[[^{inside}]\P{{L}}]+" if letter else f"[^{inside}]+")).cast("bigint")


def ratio(part: Column, whole: Column, empty: float | None = 0.0) -> Column:
    """part / whole; ``empty`` where whole is zero."""
    return F.when(whole == 0, F.lit(empty)).otherwise(part / whole)


def drop(text: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(by))


def letters(text: Column) -> Column:
    return chars(text, r"\p{L}")


# --- cleaning ---------------------------------------------------------------


def strip_control(text: Column) -> Column:
    """Without C0 and C1 controls, tab and line feed and carriage return left in."""
    return drop(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]")


def strip_html(text: Column) -> Column:
    return drop(text, "<[^>]+>")


def strip_fillers(text: Column) -> Column:
    """Without bracketed non-speech markers such as [noise]."""
    return drop(text, rf"(?i)\[(?:{BRACKETED})\]")


def collapse_runs(text: Column) -> Column:
    """Runs of five or more of one character as three of it; digits are content and stay."""
    return drop(text, r"(\D)\1{4,}", "$1$1$1")


def collapse_space(text: Column) -> Column:
    """Spaces and tabs to one space, three or more line feeds to two, ends trimmed."""
    return drop(drop(drop(text, r"[ \t]+", " "), r"\n{3,}", "\n\n"), r"^\s+|\s+$")


def one_space(text: Column) -> Column:
    """All white space runs to one space, ends trimmed."""
    return F.trim(drop(text, r"(?U)\s+", " "))


def remove_tatweel(text: Column) -> Column:
    return F.replace(text, F.lit(TATWEEL), F.lit(""))


def preprocess(text: Column, arabic: bool = False) -> Column:
    """The cleaning chain on text already composed (see unicode.nfc)."""
    t = remove_tatweel(text) if arabic else text
    return collapse_space(collapse_runs(strip_fillers(strip_html(strip_control(t)))))


def fold_digits(text: Column, alphabet: str) -> Column:
    return F.translate(text, alphabet, WESTERN)


def to_arabic_digits(text: Column) -> Column:
    return F.translate(text, WESTERN, ARABIC_DIGITS)


def straighten_quotes(text: Column) -> Column:
    return F.translate(text, *QUOTES)


def strip_artifacts(text: Column, lang: Column) -> Column:
    """Tags and controls to spaces; invisible marks out, joiners kept where Indic scripts need them."""
    t = drop(drop(text, "<[^>]{0,200}>", " "), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", " ")
    t = drop(t, f"[{NOISE_ZW}]")
    return F.when(lang.isin("hi", "ml"), t).otherwise(drop(t, f"[{JOINERS}]"))


def arabic_rules(text: Column, marks: str = "critical_only") -> Column:
    """Tatweel, Persian letters and alef wasla folded, Latin punctuation replaced, marks by policy, split prefixes joined."""
    t = F.translate(remove_tatweel(text), "یکٱ,?;", "يكا،؟؛")
    gone = {"critical_only": OTHER_MARKS, "strip_all": OTHER_MARKS + CRITICAL_MARKS, "preserve_all": ""}[marks]
    t = drop(t, f"[{gone}]") if gone else t
    return drop(t, "(^|\\s)([وفلبك])\\s+(?=[ء-ي])", "$1$2")


def cjk_rules(text: Column) -> Column:
    """Latin punctuation beside Han text (spaces aside) made full width, spaces between Han text removed."""
    near, t = f"[{HAN}{CJK_MARKS}]", text
    for latin, wide in zip(*CJK_PUNCTUATION, strict=True):
        t = drop(t, rf"(?<={near}\s{{0,8}})\{latin}|\{latin}(?=\s*{near})", wide)
    return drop(t, rf"(?<={near})\s+(?={near})")


def normalize(text: Column, lang: Column, marks: str = "critical_only") -> Column:
    """A transcript in its language's conventions; text is composed already (see unicode.nfc)."""
    t = fold_digits(straighten_quotes(strip_artifacts(text, lang)), FULL_WIDTH_DIGITS)
    arabic = arabic_rules(fold_digits(fold_digits(t, ARABIC_DIGITS), PERSIAN_DIGITS), marks)
    hindi = F.translate(fold_digits(t, DEVANAGARI_DIGITS), "|", "।")
    return one_space(F.when(lang == "ar", arabic).when(lang == "zh", cjk_rules(t)).when(lang == "hi", hindi).otherwise(t))


def text_key(text: Column) -> Column:
    """Lower case letters and digits alone: one key for one sentence however it is written."""
    return drop(F.lower(text), r"[^\p{L}\p{N}]")


# --- measures ---------------------------------------------------------------


def script_ratio(text: Column, lang: Column) -> Column:
    """Share of letters in the language's script or Latin; 1 for languages without a rule, 0 without letters."""
    n, hits = letters(text), F.lit(None).cast("bigint")
    for code, own in SCRIPTS.items():
        hits = F.when(lang == code, chars(text, own + LATIN, letter=True)).otherwise(hits)
    return F.when(~lang.isin(*SCRIPTS) | lang.isNull(), F.lit(1.0)).otherwise(ratio(hits, n))


def has_script(text: Column, lang: str) -> Column:
    """Any character of the language's script; of any letter where the language has no rule."""
    return F.regexp_like(text, F.lit(f"[{SCRIPTS[lang]}]" if lang in SCRIPTS else r"\p{L}"))


def arabic_ratio(text: Column) -> Column:
    """Arabic letters over letters."""
    return ratio(chars(text, ARABIC_WIDE, letter=True), letters(text))


def mark_count(text: Column) -> Column:
    return chars(text, ALL_MARKS)


def critical_mark_count(text: Column) -> Column:
    return chars(text, CRITICAL_MARKS)


def has_marks(text: Column) -> Column:
    return F.regexp_like(text, F.lit(f"[{ALL_MARKS}]"))


def strip_marks(text: Column) -> Column:
    return drop(text, f"[{ALL_MARKS}]")


def mark_density(text: Column) -> Column:
    """Marks per Arabic letter."""
    return ratio(mark_count(text), chars(text, ARABIC_WIDE))


def vocalisation(text: Column) -> Column:
    """Marks and tatweel per Arabic letter; null without Arabic letters."""
    return ratio(chars(text, CRITICAL_MARKS + OTHER_MARKS + TATWEEL), chars(text, ARABIC), None)


def mark_ratio(text: Column) -> Column:
    """Combining marks over letters and marks."""
    return ratio(chars(text, r"\p{M}"), chars(text, r"\p{L}\p{M}"))


def bound(value: Column, body) -> Column:
    """body(value) with value computed once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def longest_run(text: Column) -> Column:
    """Length of the longest run of one non-space character; 0 for an empty text."""
    runs = F.transform(F.regexp_extract_all(text, F.lit(r"((\S)\2+)"), F.lit(1)), F.length)
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, 0).otherwise(F.greatest(F.lit(1), F.array_max(runs)))


def words(text: Column) -> Column:
    """Pieces between runs of white space; none in a blank text."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


#: Languages counted in words.
SPACED = ("ar", "en", "hi", "ml")


def unit_count(text: Column, lang: Column) -> Column:
    """Words in languages that space them; in others Han characters, or all characters if there are none."""
    han = chars(text, HAN)
    spaced = F.coalesce(lang.isin(*SPACED), F.lit(False))
    return F.when(spaced, F.size(words(text))).otherwise(F.when(han > 0, han).otherwise(F.length(text))).cast("bigint")


def folded(text: Column) -> Column:
    """Case folded: lower case of the upper case, final sigma as sigma."""
    return F.replace(F.lower(F.upper(text)), F.lit("\u03c2"), F.lit("\u03c3"))


def content_units(text: Column, lang: Column) -> Column:
    """Case-folded words with a letter or digit; in languages that do not space words, Han characters where there are any."""
    own = F.filter(words(folded(text)), lambda w: F.regexp_like(w, F.lit(r"[\p{L}\p{N}]")))
    han = F.regexp_extract_all(text, F.lit(f"([{HAN}])"), F.lit(1))
    spaced = F.coalesce(lang.isin(*SPACED), F.lit(False))
    return F.when(~spaced & (F.size(han) > 0), han).otherwise(own)


def richness(text: Column, lang: Column, full_units: int = 24, full_chars: int = 24) -> Column:
    """0.4 distinct share of units + 0.4 distinct units toward full + 0.2 characters toward full."""
    def score(size: Column) -> Column:
        n, distinct = size["n"], size["distinct"]
        variety = F.when(distinct >= 2, distinct / n).otherwise(0.0)
        volume = F.least(distinct / F.lit(full_units), F.lit(1.0))
        band = F.least(F.length(drop(text, r"(?U)^\s+|\s+$")) / F.lit(full_chars), F.lit(1.0))
        return F.when(n == 0, 0.0).otherwise(F.round(0.4 * variety + 0.4 * volume + 0.2 * band, 4))

    sizes = bound(content_units(text, lang), lambda units: F.struct(F.size(units).alias("n"), F.size(F.array_distinct(units)).alias("distinct")))
    return bound(sizes, score)


def top_word_share(text: Column) -> Column:
    """Share of the most frequent word, case aside."""
    # Sorted words stand in runs; a fold keeps the word, the length of its run and the longest run.
    def share(own: Column) -> Column:
        start = F.struct(F.lit("").alias("word"), F.lit(0).alias("run"), F.lit(0).alias("top"))

        def step(held: Column, word: Column) -> Column:
            run = F.when(held["word"] == word, held["run"] + 1).otherwise(1)
            return bound(run, lambda r: F.struct(word.alias("word"), r.alias("run"), F.greatest(held["top"], r).alias("top")))

        return F.when(F.size(own) == 0, 0.0).otherwise(F.aggregate(own, start, step)["top"] / F.size(own))

    return bound(F.sort_array(words(F.lower(text))), share)


def code_switch_ratio(text: Column, lang: Column) -> Column:
    """Share of letters outside the language's own script."""
    own = F.lit(None).cast("bigint")
    for code, script in SCRIPTS.items():
        own = F.when(lang == code, chars(text, script, letter=True)).otherwise(own)
    return F.when(own.isNull(), 0.0).otherwise(F.when(letters(text) == 0, 0.0).otherwise(1 - own / letters(text)))


def script_counts(text: Column) -> Column:
    """Characters of each script, and letters; all scripts but Latin lie from U+0600 on, so they are counted in what is left from there."""
    def beyond(rest: Column) -> Column:
        others = (("arabic", ARABIC_WIDE), ("han", HAN), ("devanagari", DEVANAGARI), ("malayalam", MALAYALAM))
        return F.struct(chars(text, LATIN).alias("latin"), *(chars(rest, own).alias(code) for code, own in others), letters(text).alias("letters"))

    return bound(drop(text, r"[\x00-\u05ff]+"), beyond)


def script_language(text: Column, least: int = 3, share: float = 0.35) -> Column:
    """The language the scripts vote for: at least so many characters and such a share of letters; first of equals."""
    def vote(c: Column) -> Column:
        best = F.greatest(*(c[k] for k in ("arabic", "han", "devanagari", "malayalam", "latin")))
        pick = F.coalesce(*(F.when(c[k] == best, F.lit(code)) for k, code in (("arabic", "ar"), ("han", "zh"), ("devanagari", "hi"), ("malayalam", "ml"), ("latin", "en"))))
        return F.when((best >= least) & (best >= share * c["letters"]), pick)

    return bound(script_counts(text), vote)


def dialect(text: Column) -> Column:
    """The dialect with most lexical markers, first of equals; msa for other Arabic text, else unknown."""
    hits = {k: count(text, rf"(?U)\b(?:{p})\b") for k, p in DIALECTS.items()}
    best = F.greatest(*hits.values())
    other = F.when(F.regexp_like(text, F.lit(f"[{ARABIC_WIDE}]")), "msa").otherwise("unknown")
    return F.when(best == 0, other).otherwise(F.coalesce(*(F.when(n == best, F.lit(k)) for k, n in hits.items())))


def latin_tokens(text: Column) -> Column:
    """Distinct lower-cased Latin words in order of first appearance."""
    found = F.regexp_extract_all(strip_fillers(strip_html(text)), F.lit(r"([A-Za-z][A-Za-z0-9'’.&-]*)"), F.lit(1))
    return F.array_distinct(F.filter(F.transform(found, lambda t: drop(F.lower(t), r"^[.&\-'’]+|[.&\-'’]+$")), lambda t: t != ""))


def lost_latin(text: Column, original: Column) -> Column:
    """Latin words of the original that the text lacks."""
    return F.array_except(latin_tokens(original), latin_tokens(text))


def foreign_chars(text: Column, original: Column) -> Column:
    """Indic characters of the text that the original lacks."""
    own = F.regexp_extract_all(text, F.lit(f"([{DEVANAGARI}{MALAYALAM}])"), F.lit(1))
    return F.array_except(own, F.split(original, ""))


def fidelity_flags(text: Column) -> Column:
    """Format controls, replacement characters."""
    return F.array_compact(F.array(F.when(F.regexp_like(text, F.lit(r"\p{Cf}")), "format_control"), F.when(F.contains(text, F.lit("�")), "replacement_char")))


# --- numbers in text --------------------------------------------------------


def numbers(text: Column) -> Column:
    """Digit runs with inner separators taken out."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(\d+(?:[,.]\d+)*)"), F.lit(1)), lambda n: drop(n, "[,.]"))


def dropped_numbers(text: Column, original: Column) -> Column:
    """Numbers of the original whose digits the text does not hold."""
    soup = drop(text, r"\D")
    return F.filter(F.array_distinct(numbers(original)), lambda n: ~F.contains(soup, n))


def large_numbers(text: Column, over: int = 1_000_000_000) -> Column:
    return F.filter(numbers(text), lambda n: n.try_cast("decimal(38,0)") > over)


def mixed_digits(text: Column) -> Column:
    """Western and Arabic digits in one text."""
    return F.regexp_like(text, F.lit("[0-9]")) & F.regexp_like(text, F.lit(f"[{ARABIC_DIGITS}]"))


def valid_month_day(month: Column, day: Column) -> Column:
    """A month and a day it can have in some year."""
    longest = F.element_at(F.array(*(F.lit(n) for n in (31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31))), F.greatest(F.least(month, F.lit(12)), F.lit(1)).cast("int"))
    return month.between(1, 12) & (day >= 1) & (day <= longest)


# --- names and envelopes ----------------------------------------------------


def envelope(text: Column) -> Column:
    """language and text of ``language X<asr_text>Y``; language null for a plain text."""
    lang = F.regexp_extract(text, r"(?s)^\s*language\s+(.*?)<asr_text>", 1)
    return F.struct(F.when(lang != "", F.trim(lang)).alias("language"), F.when(lang != "", F.trim(F.regexp_extract(text, r"(?s)<asr_text>(.*)$", 1))).otherwise(text).alias("text"))


def language_code(value: Column) -> Column:
    """The code of a language name or code; null if unknown."""
    low = F.lower(F.trim(value))
    pairs = [x for name, code in LANGUAGE_NAMES.items() for x in (F.lit(name), F.lit(code))]
    return F.coalesce(F.element_at(F.create_map(*pairs), low), F.when(low.isin(*SCRIPTS), low))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def split_of(path: Column) -> Column:
    """The first token of a file's name."""
    return F.regexp_extract(basename(path), r"^([^_.\-]+)", 1)


def remap(path: Column, old: str, new: str) -> Column:
    """path with a leading prefix exchanged."""
    return F.when(F.startswith(path, F.lit(old)), F.concat(F.lit(new), F.substring(path, F.lit(len(old) + 1), F.length(path)))).otherwise(path)


def under(path: Column, root: str) -> Column:
    """A relative path below root; absolute paths as they are."""
    return F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


# --- conventions --------------------------------------------------------------


def replace_words(text: Column, mapping: dict[str, str]) -> Column:
    """Whole words exchanged by a table, case and all; white space between them becomes one space."""
    if not mapping:
        return text
    table = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    return F.array_join(F.transform(words(text), lambda w: F.coalesce(F.element_at(table, w), w)), " ")


def tidy_punctuation(text: Column) -> Column:
    """No space before a closing mark, one space after it where a letter follows, repeated marks once, dots to an ellipsis."""
    t = drop(text, r"\.{3,}", "…")
    t = drop(t, r"([,;:!?،؛؟।])\1+", "$1")
    t = drop(t, r"\s+([,.;:!?،؛؟।…])", "$1")
    return one_space(drop(t, r"([,;!?،؛؟।…])(?=\p{L})", "$1 "))


def sentence_case(text: Column) -> Column:
    """A capital at the start of the text and after a full stop, and for the English pronoun."""
    parts = F.split(text, r"(?<=[.!?])\s+")
    up = F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, F.lit(2), F.length(p))))
    return drop(F.array_join(up, " "), r"\bi\b", "I")


def dominant_script(text: Column, least: int = 5) -> Column:
    """The script with most letters, first of equals; null under ``least`` letters."""
    names = ("latin", "arabic", "han", "devanagari", "malayalam")

    def most(c: Column) -> Column:
        best = F.greatest(*(c[n] for n in names))
        return F.when((c["letters"] >= least) & (best > 0), F.coalesce(*(F.when(c[n] == best, F.lit(n)) for n in names)))

    return bound(script_counts(text), most)

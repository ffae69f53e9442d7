"""Dialect evidence from lexicons given as data: scoring, detection, reconciliation, erasure.

A lexicon is {label: [marker, ...]}; a marker ending in ``*`` matches the start of longer words.
Everything is a Column expression over a text's words, so lexicons ride in the plan as literals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions import text as t

Lexicon = dict[str, list[str]]


def _hits(text: Column, words: Column, marker: str, inside_words: bool) -> Column:
    stem = marker.removesuffix("*")
    if marker.endswith("*"):
        return F.size(F.filter(words, lambda w: F.startswith(w, F.lit(stem)) & (F.length(w) > len(stem))))
    if " " in stem:
        return F.size(F.split(text, rf"\Q{stem}\E", -1)) - 1
    return F.size(F.filter(words, lambda w: F.contains(w, F.lit(stem)) if inside_words else w == stem))


def scores(text: Column, lexicon: Lexicon, inside_words: bool = False) -> Column:
    """array of struct(label, score, found): a marker's hits weigh 1 and a quarter more for each character over two."""
    flat = [m for markers in lexicon.values() for m in markers]

    def hits(low: Column) -> Column:
        words = t.words(low) if inside_words else F.transform(F.regexp_extract_all(low, F.lit(r"([\p{L}']+)"), F.lit(1)), lambda w: F.trim(w, F.lit("'")))
        return t.bound(words, lambda own: F.array(*(_hits(low, own, m, inside_words) for m in flat)))

    def weigh(n: Column) -> Column:
        out, at = [], 0
        for label, markers in lexicon.items():
            own = {m: n[at + i] for i, m in enumerate(markers)}
            at += len(markers)
            score = reduce(lambda a, b: a + b, (own[m] * (1 + 0.25 * (len(m.removesuffix("*")) - 2)) for m in markers))
            found = F.array_compact(F.array(*(F.when(own[m] > 0, F.lit(m.removesuffix("*"))) for m in markers)))
            out.append(F.struct(F.lit(label).alias("label"), score.alias("score"), found.alias("found")))
        return F.array(*out)

    return t.bound(t.bound(F.lower(text), hits), weigh)


def detect(text: Column, lexicon: Lexicon, least: float = 1.5, margin: float = 0.75, inside_words: bool = False) -> Column:
    """struct(label, confidence, evidence): the best label if it scores enough and leads the next by the margin, else ``unknown``."""
    return decide(scores(text, lexicon, inside_words), least, margin)


def decide(scored: Column, least: float = 1.5, margin: float = 0.75) -> Column:
    """detect from the scores of a text."""
    ranked = F.array_sort(scored, lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).otherwise(0))

    def pick(ranked: Column) -> Column:
        first = F.get(ranked, F.lit(0))
        second = F.coalesce(F.get(ranked, F.lit(1))["score"], F.lit(0.0))
        sure = (first["score"] >= least) & (first["score"] - second >= margin)
        confidence = F.least(F.lit(0.95), 0.35 + 0.12 * first["score"] + 0.05 * F.size(first["found"]))
        none = F.when(first["score"] > 0, 0.2).otherwise(0.0)
        return F.struct(F.when(sure, first["label"]).otherwise("unknown").alias("label"), F.when(sure, confidence).otherwise(none).alias("confidence"), F.when(sure, first["found"]).otherwise(F.array().cast("array<string>")).alias("evidence"))

    return t.bound(ranked, pick)


def reconcile(detected: Column, claimed: Column, claim_confidence: Column, valid: list[str]) -> Column:
    """struct(label, confidence, source): sure evidence beats a claim; a valid claim fills in where evidence is missing."""
    claim = F.lower(F.trim(claimed))
    known, ok = (detected["label"] != "unknown") & (detected["confidence"] >= 0.5), F.coalesce(claim.isin(*valid), F.lit(False))
    source = F.when(known & ok & (claim != detected["label"]), "reconciled").when(known, "lexicon").when(ok, "claim").otherwise("none")
    fill = F.least(F.lit(0.6), 0.3 + 0.3 * F.coalesce(claim_confidence, F.lit(0.0)))
    return F.struct(F.when(~known & ok, claim).otherwise(detected["label"]).alias("label"), F.when(~known & ok, fill).otherwise(detected["confidence"]).alias("confidence"), source.alias("source"))


def erasure(source: Column, final: Column, pairs: dict[str, list[str]]) -> Column:
    """struct(kept, replaced, dropped, severity) of a lexicon's markers between a text and its edit.

    A marker that is gone counts as replaced if one of its standard equivalents is there, else as dropped.
    """
    has = lambda c, m: F.contains(c, F.lit(m))
    some = lambda own: F.array_compact(F.array(*own)) if own else F.array().cast("array<string>")
    gone = {m: has(source, m) & ~has(final, m) for m in pairs}
    swapped = {m: reduce(lambda a, b: a | b, (has(final, s) for s in own), F.lit(False)) for m, own in pairs.items()}
    kept = some([F.when(has(source, m) & has(final, m), F.lit(m)) for m in pairs])
    replaced = some([F.when(gone[m] & swapped[m], F.lit(m)) for m in pairs])
    dropped = some([F.when(gone[m] & ~swapped[m], F.lit(m)) for m in pairs])
    n = F.size(kept) + F.size(replaced) + F.size(dropped)
    severity = F.when(n > 0, (2.0 * F.size(replaced) + F.size(dropped)) / n).otherwise(0.0)
    return F.struct(kept.alias("kept"), replaced.alias("replaced"), dropped.alias("dropped"), severity.alias("severity"))

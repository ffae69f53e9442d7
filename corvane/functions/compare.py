"""Comparisons of two versions of a text: error rates, divergence classes, marks, output guards."""

from __future__ import annotations

import difflib
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions import text as t
from corvane.functions.unicode import _compare_form, _each, edits

_MARKS = re.compile(f"[{t.ALL_MARKS}]")


def cer(reference: Column, hypothesis: Column) -> Column:
    """Character error rate of two texts in comparison form, spaces aside; an empty reference gives 0 or 1. JVM-side."""
    r, h = F.replace(reference, F.lit(" "), F.lit("")), F.replace(hypothesis, F.lit(" "), F.lit(""))
    return F.when(r == "", F.when(h == "", 0.0).otherwise(1.0)).otherwise(F.levenshtein(r, h) / F.length(r))


def _added(source: str, out: str) -> int:
    a, b = (re.sub(r"[\d ]", "", _compare_form(x)) for x in (source, out))
    s, _, i = edits(list(a), list(b))
    return s + i


def _divergence(text: str, original: str) -> dict:
    """identical, punctuation, numbers or words, and the word stretches that differ."""
    if not original or text == original:
        return {"kind": "identical", "changes": []}
    a, b = _compare_form(original).split(), _compare_form(text).split()
    if a == b or "".join(a) == "".join(b):
        return {"kind": "punctuation", "changes": []}
    changes, digits = [], True
    for op, i, j, k, m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if op != "equal":
            digits &= any(c.isdigit() for w in a[i:j] + b[k:m] for c in w)
            changes.append(f"{' '.join(a[i:j]) or '-'} > {' '.join(b[k:m]) or '-'}")
    return {"kind": "numbers" if digits else "words", "changes": changes}


def _on_letters(text: str) -> list[tuple[str, str]]:
    """(base character, its marks) of a composed text."""
    out: list[tuple[str, str]] = []
    for c in unicodedata.normalize("NFC", text):
        if _MARKS.match(c) and out:
            out[-1] = (out[-1][0], out[-1][1] + c)
        else:
            out.append((c, ""))
    return out


def _marks_only(source: str, out: str) -> str | None:
    """Why an edit is not one of marks alone; null if it is."""
    a, b = _on_letters(source), _on_letters(out)
    if [x for x, _ in a] != [x for x, _ in b]:
        return "letters_changed"
    if any(set(m) & set(t.CRITICAL_MARKS) - set(n) for (_, m), (_, n) in zip(a, b, strict=True)):
        return "critical_mark_dropped"
    if any(len(m) > 2 for _, m in b):
        return "stacked_marks"
    return None


def _project(source: str, out: str) -> str:
    """out's marks on source's letters where both align; source's critical marks stay. Source itself if they align too badly."""
    a, b = _on_letters(source), _on_letters(out)
    match = difflib.SequenceMatcher(None, [x for x, _ in a], [x for x, _ in b], autojunk=False)
    if match.ratio() < 0.9:
        return source
    kept = ["".join(c for c in m if c in t.CRITICAL_MARKS) for _, m in a]
    for i, k, n in match.get_matching_blocks():
        for d in range(n):
            if re.match(f"[{t.ARABIC}]", a[i + d][0]):
                more = "".join(c for c in b[k + d][1] if c not in kept[i + d])
                kept[i + d] = (kept[i + d] + more)[:2]
    return unicodedata.normalize("NFC", "".join(c + m for (c, _), m in zip(a, kept, strict=True)))


added_letters = _each("int", _added)
divergence = _each("struct<kind:string,changes:array<string>>", _divergence)
marks_only = _each("string", _marks_only)
project_marks = _each("string", _project)


def guard(output: Column, sources: list[Column], most: float = 0.5) -> Column:
    """Why a rewritten text is refused, by its comparison forms: empty, far from every source, or far too long; null if accepted."""
    near = F.least(*(cer(s, output) for s in sources)) if len(sources) > 1 else cer(sources[0], output)
    longest = F.greatest(*(F.length(s) for s in sources)) if len(sources) > 1 else F.length(sources[0])
    return F.when(F.trim(output) == "", "empty").when(near > most, "diverges").when(F.length(output) > 2 * longest + 20, "too_long")


def issues(text: Column, seconds: Column, lang: str) -> Column:
    """Signs of a failed transcript: empty, looping, wrong script, too short for its duration."""
    words = t.words(text)
    loop = F.regexp_like(text, F.lit(r"(?U)(\b\w+\b(?:\s+\w+){0,3})(?:\s+\1){3,}"))
    wrong = (t.letters(text) >= 5) & (t.script_ratio(text, F.lit(lang)) < 0.5)
    return F.array_compact(F.array(F.when(t.one_space(text) == "", "empty"), F.when(loop, "loop"), F.when(wrong, "wrong_script"), F.when((seconds > 5) & (F.size(words) < seconds * 0.3), "truncated")))


def formalised(source: Column, final: Column, pairs: dict[str, str]) -> Column:
    """Markers of the source whose place the formal word has taken: the marker is rarer and its formal word more frequent."""
    a, b = t.words(source), t.words(final)
    n = lambda words, w: F.size(F.filter(words, lambda x: x == w))
    return F.array_compact(F.array(*(F.when((n(a, m) > n(b, m)) & (n(b, f) > n(a, f)), F.lit(f"{m} > {f}")) for m, f in pairs.items())))

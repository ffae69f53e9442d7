"""URL filter by a sort-merge range join.

Hosts are written with their labels reversed and each label ended by a dot (``com.example.``), so
that a host and all its subdomains form one interval of keys. Pages and rules are laid out in
one key order, cut into ranges at sampled pages; a rule goes to every range its interval
meets, so each range knows the rules already open where it begins. A sorted sweep over a range
keeps a stack of nested open rules, pops those whose interval has ended, and judges a page by the
open rules whose path starts its own: the longest host wins, then the longest path.

Null urls and urls without ``://`` have an empty host and path and fit no rule. Rules that are
null in host or path, or have an empty host, are ignored; of equal rules, ``block`` wins. Repeated
and tied pages are judged each; very long urls are kept whole; an empty table gives no rows; other
columns of pages are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm._spark import sample

OUT = "page string, host string, path string, rule string, verdict string"


def fold(host: Column) -> Column:
    """A-Z lower-cased, and no other letter."""
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    ok = url.contains("://")
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = fold(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.when(ok, host), F.lit("")), F.coalesce(F.when(ok, path), F.lit(""))


def reverse_host(host: Column) -> Column:
    """``a.b.c`` as ``c.b.a.``: a prefix of it is a parent domain."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", page: str = "page_id", default: str = "allow", rows_per_range: int = 200_000) -> DataFrame:
    """Each page's host, path, deciding rule (host and path joined; null if none) and verdict (``default`` if no rule).

    rules: host, path, verdict. pages keep ``page`` (as text while it travels) and are spread over
    ranges by key, path and page, so a host with a third of all pages takes a third of the ranges.
    """
    host, path = parts(F.col(url).cast("string"))
    kind = dict(pages.dtypes)[page]
    p = pages.select(F.col(page).cast("string").alias("page"), host.alias("host"), path.alias("path"))
    p = p.select(reverse_host(F.col("host")).alias("key"), "host", "path", "page")
    r = rules.select(fold(F.col("host")).alias("host"), "path", "verdict").where("host <> '' and path is not null").groupBy("host", "path").agg(F.max(F.struct(F.col("verdict") == "block", "verdict")).getField("verdict").alias("verdict"))
    r = r.select(reverse_host(F.col("host")).alias("key"), "host", "path", "verdict")
    order = F.struct("key", "path", F.coalesce("page", F.lit("")).alias("page"))
    # A sample of fixed size by hash sets the cuts; it decides how rows are spread, never a result.
    wanted = max(8, p.sparkSession.sparkContext.defaultParallelism * 2)
    wanted = max(wanted, -(-pages.count() // rows_per_range))
    some = sorted(tuple(x[0]) for x in sample(p.select(order.alias("o")), min(100_000, 64 * wanted), distinct=False).collect())
    cuts = sorted({some[len(some) * i // wanted] for i in range(1, wanted)}) if some else []
    flat = np.array([_code(x) for x in cuts], object)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import bisect

        for b in batches:
            rows = zip(*(b[c].to_pylist() for c in ("key", "path", "page")), strict=True)
            at = pa.array([bisect.bisect_right(flat, _code((k, x, g or ""))) for k, x, g in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([at, *(b[c] for c in ("key", "host", "path", "page"))], ["range", "key", "host", "path", "page"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import bisect

        for b in batches:
            out = []
            for key, h, x, verdict in zip(*(b[c].to_pylist() for c in ("key", "host", "path", "verdict")), strict=True):
                low, high = bisect.bisect_left(flat, _code((key, "", ""))), bisect.bisect_right(flat, _code((key[:-1] + "/", "", "")))
                out += [(at, key, h, x, verdict) for at in range(low, high + 1)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int32(), *[pa.string()] * 4], strict=True)], ["range", "key", "host", "path", "verdict"])

    placed = p.mapInArrow(place, "range int, key string, host string, path string, page string").selectExpr("range", "key", "1 as kind", "host", "path", "page", "cast(null as string) as verdict")
    opened = r.mapInArrow(spread, "range int, key string, host string, path string, verdict string").selectExpr("range", "key", "0 as kind", "host", "path", "cast(null as string) as page", "verdict")
    swept = placed.unionByName(opened).repartition(max(1, len(cuts) + 1), "range").sortWithinPartitions("range", "key", "kind").mapInArrow(sweep(default), OUT)
    return swept.withColumn("page", F.col("page").cast(kind)).withColumnRenamed("page", page)


def _code(x: tuple[str, str, str]) -> bytes:
    """A tuple's order as bytes (UTF-8 keeps the order of code points)."""
    return b"\0".join(s.encode() for s in x)


def sweep(default: str):
    """A pass over rows in order of (range, key, rules first) with a stack of open rules."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, stack = None, []  # of (key, [(path, host + path, verdict), ...]), each key a prefix of the next
        for b in batches:
            out = []
            for rng, key, kind, host, path, page, verdict in zip(*(b[c].to_pylist() for c in ("range", "key", "kind", "host", "path", "page", "verdict")), strict=True):
                if rng != at:
                    at, stack = rng, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, []))
                    stack[-1][1].append((path, host + path, verdict))
                    stack[-1][1].sort(key=lambda x: -len(x[0]))
                    continue
                best = next(((said, v) for _, own in reversed(stack) for start, said, v in own if path.startswith(start)), (None, default))
                out.append((page, host, path, *best))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], ["page", "host", "path", "rule", "verdict"])

    return run

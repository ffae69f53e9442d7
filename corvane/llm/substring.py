"""Substring dedup by relative Lempel-Ziv parsing against an indexed reference.

A window is ``width`` consecutive words. The words of a document covered by a window that also
starts in a document with a smaller id are duplicate. The reference, all documents with smaller
ids, is indexed by hashes of word 25-grams chosen by content: of the 26 grams in a window the leftmost with the least hash
is its anchor, so equal windows have equal anchors at equal places, wherever they stand. The index lies in blocks by
anchor; the anchor of a stretch says which block alone can hold it, so looking there is looking in every block.
The stretch covered by the consecutive windows of one anchor is a phrase. A document is parsed greedily from left to right: a
factor takes in one phrase after another as long as the index holds each whole in a smaller document, and breaks where the
reference does; ``factors`` names each factor's stretch and reference. At factor boundaries, where an anchor is shared
but the phrases around it differ, each window of the phrase is looked up on its own. Both lookups are minima by key, combined before
the shuffle, and joins read written tables on both sides, so that a passage that all documents share can be split. The result is exact.

Phrases are compared by 128 bits of hash. Null and empty texts have no words; rows with a null id are left
alone and hide nothing; rows sharing an id are not duplicates of each other; a very long text is parsed whole; an empty
table gives no rows; other columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm._arrow import Words, mix, slices, spans
from corvane.llm._spark import cut


def anchors(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """For each maximal run of windows of one document with one anchor: the anchor's hash, the phrase's hash, the first and last window, as word indices."""
    gram = width // 2
    reach = width - gram + 1  # grams in a window
    n = len(h) - width + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none
    at = np.arange(len(h) - gram + 1)
    g = mix(spans(h, at, at + gram, "word"))
    low, size = at, 1
    while size < reach:
        step = min(size, reach - size)
        a, b = low[: len(low) - step], low[step:]
        low, size = np.where(g[b] < g[a], b, a), size + step
    inside = np.zeros(n, bool)
    lengths = np.diff(first)
    for a, b in zip(first[:-1][lengths >= width], first[1:][lengths >= width], strict=True):
        inside[a : b - width + 1] = True
    start = np.flatnonzero(inside)
    if not len(start):
        return none, none, none, none
    anchor = low[start]
    begin = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
    lo, hi = start[begin], start[np.concatenate([begin[1:], [len(start)]]) - 1]
    return g[anchor[begin]].view(np.int64), mix(spans(h, lo, hi + width, "alt")).view(np.int64), lo, hi


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def _runs(w: Words, width: int) -> tuple[np.ndarray, ...]:
    """anchors() with the range of runs of each document in front."""
    anchor, phrase, lo, hi = anchors(w.hash, w.first, width)
    return np.searchsorted(lo, w.first), anchor, phrase, lo, hi


def phrases(keyed: DataFrame, width: int, whole: bool) -> DataFrame:
    """anchor and doc_id, and the phrase if ``whole``, of each phrase of each document."""
    names = ["anchor", *(["phrase"] if whole else []), "doc_id"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            bounds, anchor, phrase, _, _ = _runs(Words(b["text"]), width)
            ids = b["doc_id"].take(pa.array(np.repeat(np.arange(b.num_rows), np.diff(bounds))))
            yield pa.RecordBatch.from_arrays([pa.array(anchor), *([pa.array(phrase)] if whole else []), ids], names)

    return keyed.where("doc_id is not null").mapInArrow(parse, ", ".join(f"{n} bigint" for n in names))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 50, texts: bool = True) -> DataFrame:
    """One row per document: n_words, n_removed, kept_sha256, and unless ``texts`` is off the removed word ranges (``spans``), the ``factors`` (word range and reference) and the kept text.

    Words are hashed anew in each pass over the texts, which is cheaper than storing the phrases of
    every document; what is shuffled is one short row a phrase, and the texts once.
    """
    keyed = _keyed(docs, doc_id, text)
    shared = cut(phrases(keyed, width, False).groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("anchor"))
    found = cut(phrases(keyed, width, True).join(shared, "anchor"))
    phrase = found.groupBy("anchor", "phrase").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    several = phrase.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor", F.lit(True).alias("several"))
    factor = cut(phrase.join(several, "anchor", "left").where("several or last > first").drop("last"))
    hits = found.join(factor, ["anchor", "phrase"]).where("doc_id > first or several")
    hits = hits.groupBy("doc_id").agg(F.collect_set(F.when(F.col("doc_id") > F.col("first"), F.struct("phrase", "first"))).alias("whole"), F.collect_set(F.when(F.col("doc_id") == F.col("first"), F.col("phrase"))).alias("open"))
    hits = cut(hits)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            w = Words(b["text"])
            bounds, _, phrase, lo, hi = _runs(w, width)
            at, doc = [], []
            for i, own in enumerate(b["open"]):
                a, z = bounds[i], bounds[i + 1]
                for k in np.flatnonzero(np.isin(phrase[a:z], own.values.to_numpy())):
                    at.append(np.arange(lo[a + k], hi[a + k] + 1))
                    doc.append(np.full(len(at[-1]), i))
            if at:
                at, doc = np.concatenate(at), np.concatenate(doc)
                keys = [mix(spans(w.hash, at, at + width, kind)).view(np.int64) for kind in ("word", "alt")]
                yield pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(keys[1]), b["doc_id"].take(pa.array(doc))], ["k1", "k2", "doc_id"])

    looked = keyed.join(hits.where("size(open) > 0").select("doc_id", "open"), "doc_id").select("doc_id", "text", "open").mapInArrow(windows, "k1 bigint, k2 bigint, doc_id bigint")
    least = looked.groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last")
    single = looked.join(least, ["k1", "k2"]).where("doc_id > first").groupBy("doc_id").agg(F.collect_set("k1").alias("single"))
    fate = hits.where("size(whole) > 0").select("doc_id", "whole").join(single, "doc_id", "full_outer")

    kind = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (", spans array<struct<start:int,end:int>>, factors array<struct<start:int,end:int,reference:bigint>>, kept string" if texts else "")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            w = Words(b["text"])
            bounds, _, phrase, lo, hi = _runs(w, width)
            split = [t.encode().split() for t in b["text"].to_pylist()]  # bytes.split() splits at exactly the six ASCII spaces
            out = []
            for i, (words, whole, single) in enumerate(zip(split, b["whole"], b["single"], strict=True)):
                start, n = w.first[i], len(words)
                gone = np.zeros(n + 1, np.int64)
                a, z = bounds[i], bounds[i + 1]
                factors: list[list[int]] = []
                if whole.is_valid:
                    known, refs = (whole.values.field(c).to_numpy() for c in ("phrase", "first"))
                    order = np.argsort(known, kind="stable")
                    at = np.minimum(np.searchsorted(known[order], phrase[a:z]), len(known) - 1)
                    held = known[order][at] == phrase[a:z]
                    for k in np.flatnonzero(held):
                        low, high, ref = int(lo[a + k] - start), int(hi[a + k] + width - start), int(refs[order][at[k]])
                        if factors and factors[-1][2] == ref and low <= factors[-1][1]:
                            factors[-1][1] = high
                        else:
                            factors.append([low, high, ref])
                    for low, high, _ in factors:
                        gone[low] += 1
                        gone[high] -= 1
                if single.is_valid and n >= width:
                    at = np.arange(start, start + n - width + 1)
                    hit = at[np.isin(mix(spans(w.hash, at, at + width, "word")).view(np.int64), single.values.to_numpy())] - start
                    np.add.at(gone, hit, 1)
                    np.add.at(gone, hit + width, -1)
                dead = np.cumsum(gone)[:-1] > 0
                kept = words if not dead.any() else [words[k] for k in np.flatnonzero(~dead)]
                joined = b" ".join(kept)
                row = (n, int(dead.sum()), hashlib.sha256(joined).hexdigest())
                if texts:
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], dead, [False]]).astype(np.int8)))
                    row += ([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2], strict=True)], [dict(zip(("start", "end", "reference"), f, strict=True)) for f in factors], joined.decode())
                out.append(row)
            types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("reference", pa.int64())])), pa.string()]
            names = ["n_words", "n_removed", "kept_sha256", "spans", "factors", "kept"]
            cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=False)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], *cols], ["doc_id", *names[: len(cols)]])

    whole = keyed.join(fate, "doc_id", "left").select("doc_id", "text", "whole", "single")
    return whole.mapInArrow(remove, kind).withColumnRenamed("doc_id", doc_id)

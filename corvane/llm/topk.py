"""Exact top-k inner products by block-at-a-time pruning.

Vectors become integer terms floor(scale * x). Like vectors are laid together: a bounded sample gives pivots, rows are
dealt by their nearest pivot (a frequent pivot's rows over several tasks) and lie in super-blocks of consecutive
rows, and those in blocks of ``block`` rows. Every super-block and every block has the maximum and the
minimum of each term; for a query, its bound is the sum over terms of the larger of weight times maximum and weight times minimum.

A query first visits the super-block of highest bound. Its k-th score there goes with it, and it visits no other
super-block but those whose bound reaches that score. Within a super-block, blocks are visited by falling bound and
scored whole through their forward index, until the bound falls below the k-th score so far; a
block whose bound equals it is still scored, since ties go to the smaller id.

Queries are rows of the table, marked by a column. Rows are told apart by place, so of rows sharing an id each is a query and a candidate of its own, and
a query's own row alone is left out. Null vectors, and vectors with null or non-finite components,
take no part; nor do rows without an id. Shorter vectors count as padded with zeros; empty ones are zeros. Terms are exact at any size; a
score beyond a long is ranked exactly and returned as the nearest long. An empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corvane.llm._spark import cut

EXACT = 2**53
LONG = 2**63 - 1
#: Rows of the sample that pivots come from, and pivots.
SAMPLE, PIVOTS = 20_000, 256


def terms(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): whole numbers as doubles, or as Python integers where doubles would not do."""
    with np.errstate(over="ignore"):
        t = np.floor(scale * x)
    if np.isfinite(t).all():
        return t
    return np.array([[math.floor(v) * scale if abs(v) >= EXACT else math.floor(scale * v) for v in row] for row in x.tolist()], object).reshape(x.shape)


def _product(q: np.ndarray, data: np.ndarray) -> type:
    """The kind of numbers in which all scores are exact."""
    if q.dtype == object or data.dtype == object:
        return object
    top = float(np.abs(q).max(initial=0)) * float(np.abs(data).max(initial=0)) * max(1, q.shape[1])
    return np.float64 if top < EXACT else object


def _whole(x: np.ndarray, kind: type) -> np.ndarray:
    return x.astype(np.float64) if kind is np.float64 else np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape)


def _padded(*parts: np.ndarray) -> list[np.ndarray]:
    dim = max(x.shape[1] for x in parts)
    return [np.pad(x, ((0, 0), (0, dim - x.shape[1]))) for x in parts]


def search(own: np.ndarray, q: np.ndarray, uids: np.ndarray, ids: np.ndarray, data: np.ndarray, k: int, block: int, kth: list | None = None) -> tuple[list[tuple[int, int, int, int]], int]:
    """(query, uid, id, score) of each query's k best rows scoring at least ``kth``, ties to the smaller id, its own row (uid) left out; and the number of blocks scored."""
    q, data = _padded(q, data)
    kind = _product(q, data)
    q, data = _whole(q, kind), _whole(data, kind)
    starts = np.arange(0, len(ids), block)
    high, low = np.maximum.reduceat(data, starts), np.minimum.reduceat(data, starts)
    bound = np.maximum(q, 0).dot(high.T) + np.minimum(q, 0).dot(low.T)
    order = np.argsort(-bound, axis=1, kind="stable") if kind is np.float64 else np.array([sorted(range(len(starts)), key=lambda b: -row[b]) for row in bound.tolist()], int).reshape(bound.shape)
    n, out, scored = len(q), [], 0
    floor = [-math.inf if kth is None or kth[i] is None else kth[i] for i in range(n)]
    best: list[list[tuple]] = [[] for _ in range(n)]
    open_ = np.arange(n)
    for step in range(len(starts)):
        # Queries still open, by the block each visits next: one product scores a block for all of them.
        blocks = order[open_, step]
        keep = np.array([bound[i, b] >= floor[i] for i, b in zip(open_, blocks, strict=True)], bool)
        open_, blocks = open_[keep], blocks[keep]
        if not len(open_):
            break
        for b in np.unique(blocks):
            rows = slice(starts[b], starts[b] + block)
            scored += 1
            some = open_[blocks == b]
            for i, s in zip(some, q[some].dot(data[rows].T), strict=True):
                pick = np.flatnonzero((s >= floor[i]) & (uids[rows] != own[i])) if kind is np.float64 else [t for t, v in enumerate(s) if v >= floor[i] and uids[rows][t] != own[i]]
                best[i] = sorted([*best[i], *((-int(s[t]), int(ids[rows][t]), int(uids[rows][t])) for t in pick)])[:k]
                if len(best[i]) == k:
                    floor[i] = max(floor[i], -best[i][-1][0])
    for i in range(n):
        out += [(int(own[i]), uid, x, -s) for s, x, uid in best[i]]
    return out, scored


def order_key(x: int) -> str:
    """A text that sorts as the whole number does: sign, number of digits, digits; of negatives the complements."""
    digits = str(abs(x))
    if x >= 0:
        return f"p{len(digits):04d}{digits}"
    return f"n{9999 - len(digits):04d}{digits.translate(_NINES)}"


_NINES = str.maketrans("0123456789", "9876543210")


def _array(row: pa.StructScalar | dict, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(row[name], kind)


def _nearest(pivots: np.ndarray, x: np.ndarray) -> np.ndarray:
    x, pivots = _padded(x, pivots)
    return np.argmin((pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T, axis=1)


def _pivots(rows: list[list[float]], n: int) -> np.ndarray:
    """Centres of like vectors (a few rounds of Lloyd's) of a sample; which ones they are decides how much is pruned, never a result."""
    if not rows:
        return np.zeros((0, 0))
    dim = max(map(len, rows))
    x = np.array([[*r, *[0.0] * (dim - len(r))] for r in rows]).reshape(len(rows), dim)
    x = x / np.maximum(1.0, np.abs(x).max(initial=0))
    centres = x[np.random.Generator(np.random.PCG64(2)).permutation(len(x))[:n]]
    for _ in range(4):
        near = _nearest(centres, x)
        total, count = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(total, near, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(1, count)[:, None], centres)
    # In an order in which each is followed by the nearest one left, so that like pivots' rows lie side by side.
    order, left = [0], np.ones(len(centres), bool)
    left[0] = False
    while left.any():
        away = np.where(left, ((centres - centres[order[-1]]) ** 2).sum(1), np.inf)
        order.append(int(np.argmin(away)))
        left[order[-1]] = False
    return centres[order]


def _packed(vectors: DataFrame, vec_id: str, vector: str, query: str, rows: int) -> DataFrame:
    """Super-blocks: part, n, dim, ids, asks (query or not) and data (doubles) of like vectors."""
    v = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(F.col(query).cast("boolean"), F.lit(False)).alias("ask"))
    v = v.where("id is not null and v is not null and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    total = v.count()
    seed = F.xxhash64(F.lit(9), "id", "v")
    share = min(1.0, 1.2 * SAMPLE / max(1, total))
    some = [r["v"] for r in v.where(F.pmod(seed, F.lit(1 << 30)) < share * (1 << 30)).orderBy(seed).limit(SAMPLE).select("v").collect()]
    scale = max((abs(x) for r in some for x in r), default=1.0)
    scale = max(1.0, scale)
    pivots = _pivots(some, PIVOTS)
    counts = np.bincount(_nearest(pivots, np.array([[*r, *[0.0] * (pivots.shape[1] - len(r))] for r in some]).reshape(len(some), pivots.shape[1]) / scale), minlength=len(pivots)) if some else np.zeros(0, int)
    # A pivot with many rows is dealt over several tasks by the id.
    spread = np.maximum(1, np.ceil(counts / max(1, len(some)) * total / (4 * rows))).astype(int)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b["v"]
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
            near = np.zeros(b.num_rows, np.int64)
            for dim in np.unique(lengths):
                pick = np.flatnonzero(lengths == dim)
                x = np.clip(flat[(ends[pick] - dim)[:, None] + np.arange(dim)] / scale, -1e6, 1e6).reshape(len(pick), dim)
                x, p = _padded(x, pivots)
                near[pick] = np.argmin((p * p).sum(1)[None, :] - 2 * x @ p.T, axis=1)
            salt = b["id"].to_numpy(zero_copy_only=False).view(np.uint64) % spread[near].astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(near * 65_536 + salt.astype(np.int64) % 65_536), b["id"], lists, b["ask"]], ["near", "id", "v", "ask"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        held: list[pa.RecordBatch] = []

        def out(own: pa.Table) -> pa.RecordBatch:
            nonlocal number
            own = own.combine_chunks()
            lists = own["v"].to_pylist()
            dim = max(map(len, lists))
            data = np.zeros((len(lists), dim))
            for i, x in enumerate(lists):
                data[i, : len(x)] = x
            number += 1
            cols = [own["id"].to_numpy().astype(np.int64), own["ask"].to_numpy().astype(np.uint8), data]
            return pa.RecordBatch.from_arrays([pa.array([number - 1]), pa.array([len(lists)]), pa.array([dim]), *(pa.array([c.tobytes()], pa.binary()) for c in cols)], ["part", "n", "dim", "ids", "asks", "data"])

        for b in batches:
            held.append(b)
            while sum(x.num_rows for x in held) >= rows:
                own = pa.Table.from_batches(held)
                yield out(own.slice(0, rows))
                held = own.slice(rows).to_batches()
        if sum(x.num_rows for x in held):
            yield out(pa.Table.from_batches(held))

    n_parts = max(1, -(-total // (4 * rows)))
    laid = v.mapInArrow(place, "near bigint, id bigint, v array<double>, ask boolean") if some else v.select(F.lit(0).cast("bigint").alias("near"), "id", "v", "ask")
    return laid.repartitionByRange(n_parts, "near").sortWithinPartitions("near", "id").mapInArrow(run, "part bigint, n bigint, dim bigint, ids binary, asks binary, data binary")


def top_k(vectors: DataFrame, query: str, vec_id: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = 1024, block: int = 128, rows: int = 8192, group: int = 1024, meetings: list | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best vectors; ``query`` names the column that marks queries.

    A super-block holds ``rows`` vectors and a query group about ``group`` queries, whatever the input, so
    a task's memory is bounded. What is emitted between is one row a query group and super-block that meet. ``meetings``,
    if given, gets the number of meetings of a query with a super-block, and what it would be without bounds.
    """
    v = cut(_packed(vectors, vec_id, vector, query, rows))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bounds of each super-block, and its queries."""
        for b in batches:
            for r in b.to_pylist():
                x = _array(r, "data", np.float64).reshape(r["n"], r["dim"])
                asks = np.flatnonzero(_array(r, "asks", np.uint8))
                uids = (r["part"] << 20) + np.arange(r["n"])
                cols = [x.max(0), x.min(0), uids[asks], _array(r, "ids", np.int64)[asks], x[asks]]
                yield pa.RecordBatch.from_arrays([pa.array([r["part"]]), pa.array([r["dim"]]), pa.array([len(asks)]), *(pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in cols)], ["part", "dim", "n", "high", "low", "uids", "ids", "q"])

    seen = cut(v.mapInArrow(edges, "part bigint, dim bigint, n bigint, high binary, low binary, uids binary, ids binary, q binary"))
    count = seen.agg(F.count("*").alias("parts"), F.sum("n").alias("queries")).first()
    chunks = max(1, (count["parts"] or 0) // 256)
    bounds = seen.select(F.pmod(F.xxhash64("part"), F.lit(chunks)).alias("chunk"), F.struct("part", "dim", "high", "low").alias("b")).groupBy("chunk").agg(F.collect_list("b").alias("bounds"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Query groups out of the queries of super-blocks next to each other."""
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 24, []

        def out() -> pa.RecordBatch:
            nonlocal number, held
            q = np.concatenate(_padded(*(_array(r, "q", np.float64).reshape(r["n"], r["dim"]) for r in held)))
            number += 1
            cols = [np.concatenate([_array(r, c, np.int64) for r in held]) for c in ("uids", "ids")]
            held = []
            return pa.RecordBatch.from_arrays([pa.array([number - 1]), pa.array([len(q)]), pa.array([q.shape[1]]), *(pa.array([c.tobytes()], pa.binary()) for c in (*cols, q))], ["g", "n", "dim", "uids", "ids", "q"])

        for b in batches:
            for r in b.to_pylist():
                held.append(r)
                if sum(x["n"] for x in held) >= group:
                    yield out()
        if held:
            yield out()

    asked = seen.where("n > 0").select("part", "dim", "n", "uids", "ids", "q")
    groups = cut(asked.repartitionByRange(max(1, (count["queries"] or 0) // (4 * group)), "part").sortWithinPartitions("part").mapInArrow(gather, "g bigint, n bigint, dim bigint, uids binary, ids binary, q binary"))

    def reach(first: bool):
        """(g, part, at, kth): the queries (by place in the group) that visit a super-block."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    q = terms(_array(r, "q", np.float64).reshape(r["n"], r["dim"]), scale)
                    out = []
                    top, where = [-math.inf] * len(q), [None] * len(q)
                    for b in r["bounds"]:
                        high, low = (terms(_array(b, c, np.float64).reshape(1, -1), scale) for c in ("high", "low"))
                        qs, high, low = _padded(q, high, low)
                        kind = _product(qs, np.concatenate([high, low]))
                        qs, high, low = (_whole(x, kind) for x in (qs, high, low))
                        bound = (np.maximum(qs, 0) * high + np.minimum(qs, 0) * low).sum(1)
                        if first:
                            for i, x in enumerate(bound):
                                if x > top[i]:
                                    top[i], where[i] = x, b["part"]
                        else:
                            at = [i for i, x in enumerate(bound) if r["home"][i] != b["part"] and (r["kth"][i] is None or x >= int(r["kth"][i]))]
                            if at:
                                out.append((r["g"], b["part"], at, [r["kth"][i] for i in at]))
                    if first:
                        out = [(r["g"], p, [i for i in range(len(q)) if where[i] == p], None) for p in dict.fromkeys(where)]
                        out = [(g, p, at, [order_key(int(top[i])) for i in at]) for g, p, at, _ in out]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())), strict=True)], ["g", "part", "at", "kth"])

        return run

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                at = np.array(r["at"], int)
                q = terms(_array(r, "q", np.float64).reshape(r["qn"], r["qdim"])[at], scale)
                data = terms(_array(r, "data", np.float64).reshape(r["n"], r["dim"]), scale)
                kth = [None if x is None else int(x) for x in r["kth"]] if r["kth"] is not None else None
                out, _ = search(_array(r, "uids", np.int64)[at], q, (r["part"] << 20) + np.arange(r["n"]), _array(r, "vids", np.int64), data, k, block, kth)
                if out:
                    names = dict(zip(_array(r, "uids", np.int64).tolist(), zip(_array(r, "ids", np.int64).tolist(), range(r["qn"]), strict=True), strict=True))
                    rows_ = [(r["g"], names[o][1], o, names[o][0], x, str(s), order_key(s)) for o, _, x, s in out]
                    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows_, strict=True), types, strict=True)], ["g", "at", "uid", "query_id", "vec_id", "score", "key"])

    plan = "g bigint, part bigint, at array<int>, kth array<string>"
    hits = "g bigint, at int, uid bigint, query_id bigint, vec_id bigint, score string, key string"
    def visit(where: DataFrame) -> DataFrame:
        q = groups.select("g", F.col("n").alias("qn"), F.col("dim").alias("qdim"), "uids", "ids", "q")
        own = v.select("part", "n", "dim", F.col("ids").alias("vids"), "data")
        return where.join(q, "g").join(own, "part").mapInArrow(meet, hits)

    # Every group meets the bounds of super-blocks in chunks: a stated query set against bounds, not against rows.
    asking = groups.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))))
    met = asking.join(bounds, "chunk").select("g", "n", "dim", "q", "bounds")
    tops = met.mapInArrow(reach(True), plan).select("g", "part", F.explode(F.arrays_zip("at", "kth")).alias("x")).select("g", "part", F.col("x.at").alias("at"), F.col("x.kth").alias("key"))
    home = cut(tops.groupBy("g", "at").agg(F.max_by("part", F.struct("key", "part")).alias("part")))
    one = cut(visit(home.groupBy("g", "part").agg(F.sort_array(F.collect_list("at")).alias("at")).withColumn("kth", F.lit(None).cast("array<string>"))))
    kth = one.groupBy("g", "at").agg(F.count("*").alias("n"), F.min_by("score", "key").alias("least")).select("g", "at", F.when(F.col("n") >= k, F.col("least")).alias("kth"))
    state = home.join(kth, ["g", "at"], "left").groupBy("g").agg(F.sort_array(F.collect_list(F.struct("at", F.col("part").alias("home"), "kth"))).alias("s")).select("g", F.col("s.home").alias("home"), F.col("s.kth").alias("kth"))
    more = cut(asking.join(cut(state), "g").join(bounds, "chunk").select("g", "n", "dim", "q", "bounds", "home", "kth").mapInArrow(reach(False), plan))
    if meetings is not None:
        meetings += [home.count() + (more.agg(F.sum(F.size("at"))).first()[0] or 0), (count["queries"] or 0) * (count["parts"] or 0)]
    found = one.unionByName(visit(more.repartition(max(1, count["parts"] or 1), "part")))
    rank = F.row_number().over(W.partitionBy("uid").orderBy(F.desc("key"), "vec_id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    near = F.coalesce(F.expr("try_cast(score as bigint)"), F.when(F.col("score").startswith("-"), F.lit(-LONG - 1)).otherwise(F.lit(LONG)))
    return best.select("query_id", "rank", "vec_id", near.alias("score"))

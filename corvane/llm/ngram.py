"""N-gram Jaccard join through a MinHash LSH forest.

Documents are sets of five-word shingles. Documents of one set are one class. Each class has a
signature of ``trees`` prefix tries; a trie key packs four MinHash values of 16 bits, so keys in order
list a trie, and dropping low bits shortens a prefix. Matching starts at full length: each class meets the classes that are first and
last in the order of a whole key. The similarities of those pairs, by their signatures and
each weighed by how seldom a whole key finds it, estimate how the true pairs are distributed, and prefixes are shortened level by level
until the recall estimated for that distribution reaches the target: pairs far above the threshold leave prefixes
long, pairs close to it shorten them. At that depth each class meets the first and the last under its prefixes, then all
classes under a prefix that no likely link joins yet meet, in blocks. A link is likely if the
signatures agree in no fewer values than four deviations under the threshold's. Classes joined by likely links are a candidate group
(distributed union-find); in it every pair of classes is verified by the exact Jaccard index of
whole shingle sets, in blocks of bounded size, so that no pair is emitted: a block returns
link counts and a spanning forest of verified links, and a second union-find over the forests makes the groups.

A text of one to four words is one shingle. Texts without words (null and empty ones too) are
alone: no links. Classes take the smallest id; ids may repeat, null ids come last; repeated rows are copies of
one class; a very long text is a large set like others; an empty table gives no rows; other columns are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm._arrow import Words, mix, release, slices, spans
from corvane.llm._spark import components, cut, near

LEVELS, BITS = 4, 16


def found_at(d: int, trees: int, similarity: float) -> float:
    """The chance that a pair of such a similarity shares a prefix of d values in some tree."""
    return 1 - (1 - similarity**d) ** trees


def depth(pairs: dict[float, int], threshold: float, trees: int, recall: float) -> tuple[int, float]:
    """The longest prefix whose estimated recall reaches the target, and that recall.

    pairs counts the pairs that whole keys found, by similarity; each stands for as many as whole keys
    miss beside it. Where none is known, pairs are taken to lie at the threshold.
    """
    weight = {s: n / found_at(LEVELS, trees, s) for s, n in pairs.items()} or {threshold: 1.0}
    total, reached = sum(weight.values()), 0.0
    for d in range(LEVELS, 0, -1):
        reached = sum(w * found_at(d, trees, s) for s, w in weight.items()) / total
        if reached >= recall:
            return d, reached
    return 1, reached


def shingles(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's distinct shingles, sorted within the document, and each document's first."""
    lengths = np.diff(w.first)
    count = np.where(lengths >= width, lengths - width + 1, (lengths > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(count)), count)
    at = np.arange(first[-1]) - first[doc] + w.first[doc]
    h = mix(spans(w.hash, at, np.minimum(at + width, w.first[doc + 1]), "word"))
    out = [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    return np.concatenate(out) if out else h, np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64)


def signatures(h: np.ndarray, first: np.ndarray, trees: int) -> np.ndarray:
    """One key a tree for each document with shingles: LEVELS MinHash values of BITS bits, first value highest."""
    rng = np.random.Generator(np.random.PCG64(71))
    seeds = rng.integers(1, 2**63, (trees * LEVELS, 2), dtype=np.uint64) | np.uint64(1)
    out = np.zeros((len(first) - 1, trees), np.uint64)
    some = np.flatnonzero(np.diff(first))
    for j, (a, b) in enumerate(seeds):
        low = np.minimum.reduceat((h ^ b) * a, first[some]) if len(some) else np.zeros(0, np.uint64)
        out[some, j // LEVELS] = (out[some, j // LEVELS] << np.uint64(BITS)) | (mix(low) >> np.uint64(64 - BITS))
    return out.view(np.int64)


def to_bytes(h: np.ndarray) -> bytes:
    """Sorted hashes as six bytes each: two sets of n shingles have a false common one by a chance of n * n / 2**48."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def from_bytes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))


def verify(sets: list[np.ndarray], sizes: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which of left's documents (rows) and right's (columns) have Jaccard index threshold or more; exact."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    kept = np.bincount(column)[column] > 1  # a shingle of one document is in no intersection
    column, owner = column[kept], owner[kept]
    _, column = np.unique(column, return_inverse=True)
    n = int(column.max()) + 1 if len(column) else 0
    common = np.zeros((len(left), len(right)), np.float32)
    step = max(64, 4_000_000 // max(1, len(sets)))
    for low in range(0, n, step):
        a, b = np.searchsorted(column, [low, low + step])
        m = np.zeros((len(sets), min(step, n - low)), np.float32)
        m[owner[a:b], column[a:b] - low] = 1
        common += m[left] @ m[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - common
    return common >= threshold * union - 1e-6 * np.maximum(1, union) * 0.1


def _local(linked: np.ndarray) -> np.ndarray:
    """The smallest index in each index's connected component of a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        low = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _agree(a: str, b: str) -> Column:
    """In how many of their MinHash values two signatures agree."""
    same = lambda x, y: sum((F.shiftrightunsigned(x.bitwiseXOR(y), BITS * k).bitwiseAND(F.lit(2**BITS - 1)) == 0).cast("int") for k in range(LEVELS))
    return F.aggregate(F.zip_with(a, b, same), F.lit(0), lambda s, x: s + x)


def _likely(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with ``agree``."""
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("keys").alias(f"k{side}")), side)
    return pairs.withColumn("agree", _agree("ka", "kb")).drop("ka", "kb")


def _star(prefix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes under a prefix that others share (key, node), and the pairs (a, b) of each with the first and the last of its prefixes."""
    ends = prefix.groupBy("key").agg(F.min(F.struct("path", "node")).getField("node").alias("low"), F.max(F.struct("path", "node")).getField("node").alias("high"), F.count("*").alias("n")).where("n > 1").drop("n")
    member = cut(prefix.drop("path").join(cut(ends), "key"))
    pairs = member.select("node", F.explode(F.array("low", "high")).alias("other")).where("node <> other")
    return member.select("key", "node"), pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _cells(rows: DataFrame, group: str, cell: list[str], handle, kind: str) -> DataFrame:
    """handle(rows of a cell, as lists by column) for every cell of two blocks (i, j) of a group, streamed in order of the cells.

    rows has ``blocks`` and ``block``; each row goes to the cells of its block with every block, so a group is dealt over many tasks.
    """
    met = rows.withColumn("with", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))).withColumn("i", F.least("block", "with")).withColumn("j", F.greatest("block", "with")).drop("with")
    met = met.withColumn("meet", F.xxhash64(group, "i", "j")).repartition("meet").sortWithinPartitions("meet", group, "i", "j").select(group, "i", "j", "block", *cell)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key = None
        for b in batches:
            for root, i, j, *row in zip(*(b[c].to_pylist() for c in (group, "i", "j", "block", *cell)), strict=True):
                if (root, i, j) != key:
                    if held and (done := handle(held, key[1], key[2])):
                        yield done
                    key, held = (root, i, j), []
                held.append(tuple(row))
        if held and (done := handle(held, key[1], key[2])):
            yield done
        release()

    return met.mapInArrow(run, kind)


def _sides(block: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    return (np.arange(len(block)),) * 2 if i == j else (np.flatnonzero(block == i), np.flatnonzero(block == j))


def _together(prefix: DataFrame, component: DataFrame, sets: DataFrame, least: float, block: int) -> DataFrame:
    """a, b: a forest of likely links between classes under one prefix that are not of one component yet.

    Every two classes under a prefix meet in one cell, that of their two blocks; a cell returns a row a class at most.
    """
    own = prefix.join(component, "node", "left").withColumn("root", F.coalesce("root", "node"))
    live = own.groupBy("key").agg(F.ceil(F.count("*") / block).alias("blocks"), F.min("root").alias("first"), F.max("root").alias("last")).where("first < last").select("key", "blocks")
    own = own.join(cut(live), "key").join(sets.select("node", "keys"), "node").withColumn("block", F.pmod(F.xxhash64(F.lit(5), "node"), F.col("blocks")).cast("int"))

    def handle(rows: list[tuple], i: int, j: int) -> pa.RecordBatch | None:
        nodes, roots = (np.array([r[c] for r in rows]) for c in (1, 2))
        signs = np.array([r[3] for r in rows]).view(np.uint16).reshape(len(rows), -1)
        left, right = _sides(np.array([r[0] for r in rows]), i, j)
        linked = roots[:, None] == roots[None, :]
        for at in range(0, len(left), 64):
            linked[np.ix_(left[at : at + 64], right)] |= (signs[left[at : at + 64], None, :] == signs[None, right, :]).sum(2) >= least
        label = _local(linked | linked.T)
        new = np.flatnonzero(roots != roots[label])
        return pa.RecordBatch.from_arrays([pa.array(nodes[new]), pa.array(nodes[label[new]])], ["a", "b"]) if len(new) else None

    return _cells(own, "key", ["node", "root", "keys"], handle, "a bigint, b bigint")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, threshold: float = 0.8, trees: int = 16, recall: float = 0.9999, block: int = 512) -> DataFrame:
    """One row per document: id, class_id (smallest id of its group), n_links (other documents at the threshold or above), copies (documents of its very shingle set)."""
    keyed = _keyed(docs, doc_id, text)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, first = shingles(Words(b["text"]), width)
            n = np.diff(first)
            total = np.concatenate([[0], np.cumsum(mix(h), dtype=np.uint64)]).astype(np.uint64)
            node = mix((total[first[1:]] - total[first[:-1]]) ^ n.astype(np.uint64)).view(np.int64)
            keys = signatures(h, first, trees)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * trees), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_key"], pa.array(node, mask=n == 0), pa.array(n), flat], ["doc_id", "text_key", "node", "n", "keys"])

    signed = cut(keyed.mapInArrow(sign, "doc_id bigint, text_key bigint, node bigint, n bigint, keys array<bigint>"))
    sets = signed.where("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("own"), F.count("*").alias("copies"), F.min_by("keys", "text_key").alias("keys"))
    sets = cut(sets.select("node", "own.doc_id", "own.text_key", "copies", "keys"))
    trie = sets.select("node", F.posexplode("keys").alias("tree", "path"))
    under = lambda d: trie.select("node", "path", F.xxhash64("tree", F.shiftrightunsigned("path", BITS * (LEVELS - d))).alias("key"))

    values = trees * LEVELS
    least = values * threshold - 4 * (values * threshold * (1 - threshold)) ** 0.5
    _, pairs = _star(under(LEVELS))
    known = _likely(pairs, sets).groupBy((F.col("agree") / values).alias("s")).agg(F.count("*").alias("n")).where(F.col("s") >= threshold).collect()  # a row for each number of values
    d, _ = depth({r["s"]: r["n"] for r in known}, threshold, trees, recall)
    member, pairs = _star(under(d))
    likely = cut(_likely(pairs, sets).where(F.col("agree") >= least).select("a", "b"))
    likely = likely.unionByName(_together(member, components(likely, "a", "b"), sets, least, block))
    cluster = cut(components(likely, "a", "b"))
    sized = cut(cluster.groupBy("root").agg(F.ceil(F.count("*") / block).alias("blocks")))
    members = cluster.join(sized, "root").join(sets.select("node", "doc_id", "text_key", "copies"), "node")
    members = cut(members.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, first = shingles(Words(b["text"]), width)
            data = [to_bytes(h[x:y]) for x, y in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in ("root", "blocks", "block", "node", "copies")), pa.array(data, pa.binary())], ["root", "blocks", "block", "node", "copies", "data"])

    full = near(keyed, members, "text_key").alias("d").join(members.alias("m"), F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.text_key") == F.col("m.text_key"))).select("root", "blocks", "block", "node", "copies", "text")
    full = full.mapInArrow(gather, "root bigint, blocks bigint, block int, node bigint, copies bigint, data binary")

    def compare(rows: list[tuple], i: int, j: int) -> pa.RecordBatch:
        rows = sorted({r[1]: r for r in rows}.values(), key=lambda r: r[1])  # a repeated row stands once
        nodes, copies = (np.array([r[c] for r in rows]) for c in (1, 2))
        data = [from_bytes(r[3]) for r in rows]
        left, right = _sides(np.array([r[0] for r in rows]), i, j)
        linked = np.zeros((len(rows), len(rows)), bool)
        if len(left) and len(right) and len(rows) > 1:
            linked[np.ix_(left, right)] = verify(data, np.array([len(x) for x in data]), left, right, threshold)
        linked |= linked.T
        np.fill_diagonal(linked, False)
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array((linked @ copies).astype(np.int64)), pa.array(nodes[_local(linked)])], ["node", "links", "root"])

    found = cut(_cells(full, "root", ["node", "copies", "data"], compare, "node bigint, links bigint, root bigint"))
    group = components(found.where("node <> root"), "node", "root")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = sets.select("node", "copies", "doc_id").join(links, "node", "left").join(group, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = cut(named.groupBy("root").agg(F.min("doc_id").alias("class_id")))
    named = named.join(first, "root").select("node", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "copies")
    out = signed.select("doc_id", "text_key", "node").join(named, "node", "left")
    out = out.select("doc_id", "text_key", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), F.coalesce("copies", F.lit(1).cast("bigint")).alias("copies"))
    return out.withColumnRenamed("doc_id", doc_id)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs without the documents whose group has one with a smaller id; of repeated rows (one id, one text) one stays."""
    groups = join(docs, doc_id, text, **options).where(F.col(doc_id).isNull() | (F.col(doc_id) == F.col("class_id")))
    groups = cut(groups.groupBy(F.col(doc_id).alias("__id"), F.col("text_key").alias("__k")).agg(F.count("*").alias("__rows")))
    whole = docs.withColumn("__key", F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))).alias("d")

    def kept(own: DataFrame) -> DataFrame:
        own = own.alias("g")
        return whole.join(own, F.col(f"d.{doc_id}").cast("bigint").eqNullSafe(F.col("g.__id")) & (F.col("d.__key") == F.col("g.__k")), "left_semi")

    # Rows without an id are told apart by their text alone, so a repeated one may be another document: all of them stay.
    once = kept(groups.where("__rows = 1 or __id is null"))
    return once.unionByName(kept(groups.where("__rows > 1 and __id is not null")).dropDuplicates([doc_id, "__key"])).drop("__key")

"""Packing by power-of-two decomposition.

A document of n tokens (its ids, then an end id) is cut into pieces of 2**k tokens: as many of
the longest length as fit, then the binary digits of the remainder, longest first. Pieces of one
length form that length's bucket; each piece is a sequence of its own, so no sequence crosses
documents, none needs padding, and training batches draw whole sequences from one bucket. Nothing
is shuffled: a piece's place depends on its own document alone. ``buckets`` writes the pieces
partitioned by length, for readers that want equal lengths together.

Null text counts as empty (one end id); rows with a null id are packed under it; empty tables give no
rows; repeated rows are packed each; a very long text gives many pieces of the longest length; columns
of docs other than the two named are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm._arrow import slices

PIECES = "row bigint, start bigint, length bigint, bucket int, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
#: Every character up to here is split alike by both tokenizer libraries (a test compares them over the whole range).
LATIN = 0x24F


def _ranks(vocabulary: str) -> dict[bytes, int]:
    with open(os.path.splitext(vocabulary)[0] + ".tiktoken", "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def same_merges(vocabulary: str) -> list[str]:
    """What keeps merging by rank from giving the ids of the ``tokenizers`` file; empty if nothing does.

    The file merges the listed pairs, first listed first; merging by rank merges any two tokens that make a token, lowest id
    first. Both go the same way if ids follow the list and every token, merged by the list from its bytes, becomes
    itself: were some pair merged by rank alone, the merges inside its stretch would have been the same so
    far as in that token by itself (a merge across its ends would have broken it), so the list would go on with the same pair.
    """
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(vocabulary)
    with open(vocabulary, encoding="utf-8") as f:
        model = json.load(f)["model"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in pairs]
    added = {t.content for t in full.get_added_tokens_decoder().values()}
    own = {t: i for t, i in model["vocab"].items() if t not in added}
    to_byte = {c: b for b, c in _byte_letters().items()}
    out = [] if ids == sorted(set(ids)) else ["ids do not follow the merges"]
    if {bytes(to_byte[c] for c in t): i for t, i in own.items()} != _ranks(vocabulary):
        out.append("the ranks are another vocabulary")
    out += [f"{t!r} is not what its bytes merge to" for t, i in own.items() if [x.id for x in full.model.tokenize(t)] != [i]]
    return out


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, else the next free one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


@cache
def encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """Token ids of a text under a ``tokenizers`` file, as that library gives them without special tokens added.

    Beside byte_bpe_50k.json lies the same vocabulary as ranks. A text of Latin letters without an added token is encoded
    with those, which is several times faster and, as ``same_merges`` shows for the whole table, gives the same ids; any other
    text goes through the ``tokenizers`` file.
    """
    import re

    from tokenizers import Tokenizer

    @cache
    def full() -> Tokenizer:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        return Tokenizer.from_file(vocabulary)

    slow = lambda text: full().encode(text, add_special_tokens=False).ids
    if not os.path.exists(os.path.splitext(vocabulary)[0] + ".tiktoken"):
        return slow
    import public_tokenizers
    import tiktoken

    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(vocabulary), special_tokens={}).encode_ordinary
    with open(vocabulary, encoding="utf-8") as f:
        added = [t["content"] for t in json.load(f).get("added_tokens") or []]
    other = re.compile("|".join([f"[^\x00-{chr(LATIN)}]", *map(re.escape, added)])).search
    return lambda text: slow(text) if other(text) else fast(text)


def pieces(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of n tokens; lengths are powers of two, falling."""
    out, at = [], 0
    while at < n:
        size = min(longest, 1 << ((n - at).bit_length() - 1))
        out.append((at, size))
        at += size
    return out


def pack(docs: DataFrame, vocabulary: str, text: str = "text", row: str = "doc_id", longest: int = 1024, end_id: int = 0, ids: bool = True) -> DataFrame:
    """One row per sequence: its document (``row``), start, length, bucket, crc of its ids, and the ids themselves unless ``ids`` is off.

    ``row`` becomes a long; ``sequence_id`` is unique and repeats when a task is run again.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(vocabulary)
        number = TaskContext.get().partitionId() << 40
        for part in slices(batches, "text", 4_000_000):
            cols: list[list] = [[] for _ in range(5)]
            tokens: list[np.ndarray] = []
            for row_id, words in zip(part["row"].to_pylist(), part["text"].to_pylist(), strict=True):
                own = np.array([*encode(words or ""), end_id], "<u4")
                raw = memoryview(own).cast("B")
                for start, size in pieces(len(own), longest):
                    for col, x in zip(cols, (row_id, start, size, zlib.crc32(raw[4 * start : 4 * (start + size)]), len(own)), strict=True):
                        col.append(x)
                tokens.append(own)
            rows, starts, sizes, crcs, lengths = (pa.array(c, pa.int64()) for c in cols)
            n = len(rows)
            out = [rows, starts, sizes, sizes.cast(pa.int32()), crcs, lengths, pa.array(np.arange(number, number + n)), pa.array(np.zeros(n, np.int64))]
            number += n
            names = [c.split()[0] for c in PIECES.split(", ")]
            if ids:
                flat = np.concatenate(tokens).astype(np.int32) if tokens else np.zeros(0, np.int32)
                ends = np.concatenate([[0], np.cumsum(sizes.to_numpy())]).astype(np.int32)
                out, names = [*out, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(out, names)

    slim = docs.select(F.col(row).cast("bigint").alias("row"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, PIECES + (", ids array<int>" if ids else "")).withColumnRenamed("row", row)


def buckets(packed: DataFrame, path: str) -> None:
    """Writes the sequences under ``path``, one folder for each length; a length's rows are spread over tasks as they lie."""
    packed.write.partitionBy("bucket").parquet(path)

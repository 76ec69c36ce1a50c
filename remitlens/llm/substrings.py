"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text: each step doubles the hash and adds a number for the byte, so a 32-bit hash is
that of the last 32 bytes. A text is cut where the hash is the least within ``radius`` positions on both sides; that
depends on the bytes around alone, so an insertion moves the cuts near it and no others, and equal passages are cut
alike but for their edges. Chunks are compared by 128-bit digests. A chunk is a repeat if its digest occurs earlier (at a
smaller doc_id, or before in the same text); consecutive repeats form runs, and runs of at least ``least_run`` bytes
are removed.

NULL texts are empty; a text without a cut is one chunk. Rows that share a doc_id have the same rank, so neither is a later
repeat of the other; a NULL doc_id comes before all. Other columns are ignored; an empty table gives an empty result. Counts
and cuts are made for all texts; a digest with a third of all chunks is reduced to one row per task before it is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import random_table, settle, texts_of
from remitlens.llm.spans import cut_spans, text_key

RADIUS = 24
#: Bytes of the shortest run that is removed.
LEAST_RUN = 100
_GEAR = random_table(256, 51).astype(np.uint32)
#: A long text is hashed in pieces; each sees so much of what surrounds it that its cuts are those of the whole text.
PIECE_BYTES = 1 << 20

CHUNKS = "doc_id long, key long, d1 long, d2 long, start int, stop int, again boolean"


def gear_hashes(codes: np.ndarray) -> np.ndarray:
    """The gear hash after each byte, from up to 32 bytes, in five doubling steps."""
    out = _GEAR[codes]
    with np.errstate(over="ignore"):
        for step in (1, 2, 4, 8, 16):
            if step < len(out):
                shifted = out[:-step] << np.uint32(step)
                out = out.copy()
                out[step:] += shifted
    return out


def _least_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """The least of values[i : i + width]; the array is shorter by width - 1."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _cuts_of_piece(codes: np.ndarray, radius: int) -> np.ndarray:
    if len(codes) <= 2 * radius:
        return np.zeros(0, np.int64)
    hashes = gear_hashes(codes)
    around = _least_ahead(hashes, radius)
    middle = hashes[radius:-radius]
    least = (middle < around[: len(middle)]) & (middle <= around[radius + 1 :][: len(middle)])
    return np.flatnonzero(least) + radius + 1


def cuts(text: bytes, radius: int = RADIUS) -> np.ndarray:
    """Positions at which a text is cut; no cut is within ``radius`` of its ends."""
    codes = np.frombuffer(text, np.uint8)
    if len(codes) <= PIECE_BYTES:
        return _cuts_of_piece(codes, radius)
    margin, found = 32 + radius, []
    for start in range(0, len(codes), PIECE_BYTES):
        low = max(0, start - margin)
        own = _cuts_of_piece(codes[low : start + PIECE_BYTES + margin], radius) + low
        found.append(own[(own > start) & (own <= start + PIECE_BYTES)])
    return np.concatenate(found)


def _chunker(radius: int) -> Callable:
    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
            columns: list[list] = [[] for _ in range(6)]
            digests: list[bytes] = []
            for doc_id, key, text in zip(ids, keys, texts_of(batch), strict=True):
                if not text:
                    continue
                edges = [0, *cuts(text, radius).tolist(), len(text)]
                own = [hashlib.blake2b(text[a:b], digest_size=16).digest() for a, b in zip(edges, edges[1:], strict=False)]
                seen: set[bytes] = set()
                again = [d in seen or seen.add(d) is not None for d in own]
                digests += own
                n = len(own)
                for column, values in zip(columns, ([doc_id] * n, [key] * n, edges[:-1], edges[1:], again), strict=False):
                    column += values
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(np.ascontiguousarray(halves[:, 0])),
                    pa.array(np.ascontiguousarray(halves[:, 1])),
                    pa.array(columns[2], pa.int32()),
                    pa.array(columns[3], pa.int32()),
                    pa.array(columns[4], pa.bool_()),
                ],
                names=["doc_id", "key", "d1", "d2", "start", "stop", "again"],
            )

    return chunked


def repeated_chunks(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """span_id, span_key and the spans of all repeated chunks, one row per text that has any."""
    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("key"), F.col("text").cast("string"))
    chunks = rows.mapInArrow(_chunker(radius), CHUNKS)
    # Inside a text the first copy of a chunk stands for all, so the digests of a text are distinct from here on.
    rank = F.coalesce("doc_id", F.lit(-(1 << 63)))
    places = chunks.where(~F.col("again")).groupBy(F.col("d1").alias("e1"), F.col("d2").alias("e2"))
    shared = places.agg(F.min(rank).alias("first"), F.max(rank).alias("last")).where("first < last")
    # Written, so that both sides of the join are plain shuffles, of which Spark splits a hot digest's partition.
    shared = settle(shared.select("e1", "e2", "first"), "chunks-shared")
    joined = chunks.join(shared, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left")
    repeated = F.col("again") | F.coalesce(rank > F.col("first"), F.lit(False))
    found = joined.where(repeated).select("doc_id", "key", F.struct("start", "stop").alias("span"))
    return found.groupBy(F.col("doc_id").alias("span_id"), F.col("key").alias("span_key")).agg(
        F.collect_set("span").alias("spans")
    )


def deduplicated_substrings(
    docs: DataFrame, radius: int = RADIUS, least_run: int = LEAST_RUN, keep: bool = False
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes with ``keep``) of every row."""
    spans = settle(repeated_chunks(docs, radius), "chunk-spans")
    return cut_spans(docs, spans, least_run, keep)

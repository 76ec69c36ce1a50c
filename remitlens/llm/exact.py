"""Exact deduplication through a minimal perfect hash over the digests of the past.

The distinct digests of the rows already known are dealt into blocks of bounded size by their leading bits; each block
holds a perfect hash whose slots carry the full digest and the locator (row) of its winner. Distinct digests of new
rows look themselves up in their block; a hit counts only if all 32 bytes agree, and then the new copies join the
winner's group. The others, absent from the past, are grouped among themselves. Only digests are shuffled, never texts, and
both sides are reduced to one row per digest before they meet, so a text with a third of all rows is one row there.

NULL and empty texts are equal (both normalise to nothing). Of equal texts the row with the most code points in its
original stays, then the smallest doc_id (NULL before all), then the row first in the settled table: of rows that repeat
in full one stays. Other columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import pieces_for, same, settle, texts_of
from remitlens.llm.mph import PerfectHash, keys_of_digests

#: Fixed value: the characters that don't count.
BLANKS = b" \t\n\x0b\x0c\r"
#: Distinct digests of a block of the index.
BLOCK = 50_000

INDEX_SCHEMA = "block int, hash binary, digests binary, locators binary"


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).cast(pa.int64())
        found = [hashlib.sha256((t or b"").translate(None, BLANKS)).digest() for t in texts_of(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), points, pa.array(found, pa.binary())],
            names=["doc_id", "n_points", "digest"],
        )


def text_digests(docs: DataFrame) -> DataFrame:
    """doc_id, code points of the text, SHA-256 of the text without blanks, and a row number; written once."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.mapInArrow(_digest_batches, "doc_id long, n_points long, digest binary")
    return settle(rows.withColumn("row", F.monotonically_increasing_id()), "digests")


def _winner() -> Column:
    return F.min(F.struct((-F.col("n_points")).alias("order"), "doc_id", "row")).alias("best")


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(blocks)).cast("int").alias("block")


def _build_block(table: pa.Table) -> pa.Table:
    digests = table.column("digest").to_pylist()
    keys = keys_of_digests(digests)
    index = PerfectHash.build(keys)
    slots = index.slots(keys)
    full = np.empty((len(digests), 32), np.uint8)
    full[slots] = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
    locators = np.empty(len(digests), "<i8")
    locators[slots] = table.column("locator").to_numpy()
    return pa.table(
        {
            "block": pa.array([table.column("block")[0].as_py()], pa.int32()),
            "hash": [index.to_bytes()],
            "digests": [full.tobytes()],
            "locators": [locators.tobytes()],
        }
    )


def build_index(distinct: DataFrame, blocks: int) -> DataFrame:
    """``distinct``: digest, locator, one row per digest. One row per block; bounded by the number of blocks."""
    rows = distinct.select(_block(blocks), "digest", "locator")
    return rows.groupBy("block").applyInArrow(_build_block, INDEX_SCHEMA)


def _look_up(new: pa.Table, index: pa.Table) -> pa.Table:
    digests = new.column("digest").to_pylist()
    found = np.full(len(digests), -1, np.int64)
    if len(digests) and index.num_rows:
        hashed = PerfectHash.from_bytes(index.column("hash")[0].as_py())
        stored = np.frombuffer(index.column("digests")[0].as_py(), np.uint8).reshape(-1, 32)
        locators = np.frombuffer(index.column("locators")[0].as_py(), "<i8")
        slots = hashed.slots(keys_of_digests(digests))
        asked = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
        hit = slots >= 0
        hit[hit] = (stored[slots[hit]] == asked[hit]).all(axis=1)
        found[hit] = locators[slots[hit]]
    return pa.table({"digest": pa.array(digests, pa.binary()), "locator": pa.array(found, mask=found < 0)})


def look_up(distinct: DataFrame, index: DataFrame, blocks: int) -> DataFrame:
    """digest and locator (NULL where the digest isn't in the index) of distinct digests."""
    asked = distinct.select(_block(blocks), "digest").groupBy("block")
    return asked.cogroup(index.groupBy("block")).applyInArrow(_look_up, "digest binary, locator long")


def exact_duplicates(docs: DataFrame, is_past: Column, block: int = BLOCK) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and in_past for every row.

    ``is_past``: a condition on doc_id that tells the rows already known from the new ones; the groups and winners
    don't depend on it.
    """
    rows = text_digests(docs).withColumn("past", F.coalesce(is_past, F.lit(False)))
    groups = settle(rows.groupBy("past", "digest").agg(_winner(), F.count("*").alias("n")), "digest-groups")
    past, new = groups.where("past"), groups.where(~F.col("past"))
    blocks = pieces_for(groups.count(), block)
    index = build_index(past.select("digest", F.col("best.row").alias("locator")), blocks)
    asked = look_up(new, index, blocks).withColumnRenamed("digest", "asked")
    located = new.join(asked, new.digest == asked.asked).select(
        "past", "digest", "best", "n", F.coalesce("locator", "best.row").alias("locator")
    )
    located = past.withColumn("locator", F.col("best.row")).select(located.columns).unionByName(located)
    located = settle(located, "digest-locators")
    totals = located.groupBy("locator").agg(F.min("best").alias("winner"), F.sum("n").alias("group_size"))
    of_digest = located.select(F.col("past").alias("p"), F.col("digest").alias("d"), "locator").join(totals, "locator")
    return rows.join(of_digest, (F.col("past") == F.col("p")) & (F.col("digest") == F.col("d"))).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        F.col("past").alias("in_past"),
    )

"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts form a group and share a shard. The number of shards is given, so the fixed capacity is the
smallest that fits: groups larger than an equal share of the rest each fill a shard of their own, and the rest is packed
into the others. Groups above a slice's fair share are packed by one task (there are at most shards * slices of them);
all others are dealt by digest into slices of bounded size, and every slice packs its own groups, largest first, each into
the bin with the least room that still holds it, found in a balanced search tree. A slice may fill each bin up
to its part of what the large groups left, so the slices' sums stay near equal.

NULL text counts as empty: 16 bytes, checksum 0, one group with the empty texts. Repeated rows are one group like other
equal texts, and each has its own slot. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from remitlens.llm.common import pieces_for, settle

#: Bytes added to every row.
ROW_OVERHEAD = 16
#: Groups of a slice, and rows that are numbered together.
SLICE = 100_000
ROOM = 0.0005


class RoomTree:
    """Bins ordered by (room, bin) in a weight-balanced search tree, with the successor search of best fit.

    Nodes are [room, bin, left, right, size]; a subtree that leans beyond 3:1 is rebuilt level.
    """

    def __init__(self, rooms: list[int]):
        self.root = self._level(sorted((room, b) for b, room in enumerate(rooms)))

    def _level(self, keys: list[tuple[int, int]]):
        if not keys:
            return None
        middle = len(keys) // 2
        return [keys[middle], self._level(keys[:middle]), self._level(keys[middle + 1 :]), len(keys)]

    @staticmethod
    def _keys(node) -> list[tuple[int, int]]:
        return [] if node is None else [*RoomTree._keys(node[1]), node[0], *RoomTree._keys(node[2])]

    def _balanced(self, node):
        left, right = (child[3] if child else 0 for child in node[1:3])
        node[3] = left + right + 1
        return self._level(self._keys(node)) if max(left, right) > 3 * min(left, right) + 3 else node

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The bin with the least room of at least ``size``."""
        node, best = self.root, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[1]
            else:
                node = node[2]
        return best

    def roomiest(self) -> tuple[int, int]:
        node = self.root
        while node[2]:
            node = node[2]
        return node[0]

    def add(self, key: tuple[int, int], node=0):
        if node == 0:
            self.root = self.add(key, self.root)
            return None
        if node is None:
            return [key, None, None, 1]
        side = 1 if key < node[0] else 2
        node[side] = self.add(key, node[side])
        return self._balanced(node)

    def remove(self, key: tuple[int, int], node=0):
        if node == 0:
            self.root = self.remove(key, self.root)
            return None
        if key == node[0]:
            if node[1] is None or node[2] is None:
                return node[1] or node[2]
            follower = node[2]
            while follower[1]:
                follower = follower[1]
            node[0], key = follower[0], follower[0]
            node[2] = self.remove(key, node[2])
        else:
            side = 1 if key < node[0] else 2
            node[side] = self.remove(key, node[side])
        return self._balanced(node)


def pack(sizes: np.ndarray, ties: np.ndarray, rooms: list[int]) -> tuple[np.ndarray, list[int]]:
    """Best-fit decreasing: the bin of each item, and the room left. An item that fits nowhere takes the roomiest bin."""
    tree, out = RoomTree(rooms), np.empty(len(sizes), np.int32)
    rooms = list(rooms)
    for i in np.lexsort((ties, -sizes)):
        size = int(sizes[i])
        key = tree.tightest(size) or tree.roomiest()
        tree.remove(key)
        rooms[key[1]] -= size
        tree.add((rooms[key[1]], key[1]))
        out[i] = key[1]
    return out, rooms


def level_rooms(sizes: list[int], total: int, shards: int) -> list[int]:
    """Equal rooms, after the groups larger than an equal share of what remains have shards of their own."""
    rooms, rest = [], total
    for size in sorted(sizes, reverse=True):
        if len(rooms) + 1 < shards and size * (shards - len(rooms)) > rest:
            rooms.append(size)
            rest -= size
        else:
            break
    share = -(-rest // (shards - len(rooms)))
    return rooms + [share] * (shards - len(rooms))


def row_facts(docs: DataFrame) -> DataFrame:
    """doc_id, size, checksum and digest of every row, with a row number; written once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    facts = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    return settle(facts, "shard-rows")


def _packer(rooms: list[int], slices: int):
    def packed(table: pa.Table) -> pa.Table:
        sizes = table.column("group_bytes").to_numpy()
        ties = table.column("tie").to_numpy()
        # The slice's own bytes are shared out in proportion to the room that the bins have left.
        left, need = np.maximum(np.array(rooms, float), 0), float(sizes.sum())
        share = left / left.sum() if left.sum() else np.full(len(left), 1 / len(left))
        own = np.ceil(share * need * (1 + ROOM)).astype(np.int64)
        bins, _ = pack(sizes, ties, own.tolist())
        return pa.table({"digest": table.column("digest"), "shard": pa.array(bins, pa.int32())})

    return packed


def assign_groups(groups: DataFrame, shards: int, slice_rows: int = SLICE) -> DataFrame:
    """digest and shard of every group. ``groups``: digest, group_bytes, tie (one row per digest)."""
    count, total = groups.agg(F.count("*"), F.coalesce(F.sum("group_bytes"), F.lit(0))).first()
    slices = pieces_for(count, slice_rows)
    # What a slice would put into one bin; at most shards * slices groups are as large.
    large_from = max(1, total // (shards * slices)) if slices > 1 else total + 1
    large_from = min(large_from, max(1, total // shards))
    large = groups.where(F.col("group_bytes") >= large_from)
    # Ordered sizes of the largest: only those can exceed a shard's equal share, so as many as there are shards.
    top = [r[0] for r in large.orderBy(F.desc("group_bytes")).select("group_bytes").limit(shards).collect()]
    rooms = level_rooms(top, total, shards)

    def pack_large(table: pa.Table) -> pa.Table:
        sizes, ties = table.column("group_bytes").to_numpy(), table.column("tie").to_numpy()
        return pa.table({"digest": table.column("digest"), "shard": pa.array(pack(sizes, ties, rooms)[0], pa.int32())})

    placed_large = settle(
        large.withColumn("slice", F.lit(0)).groupBy("slice").applyInArrow(pack_large, "digest binary, shard int"),
        "large-groups",
    )
    used = {
        r[0]: r[1]
        for r in placed_large.join(large, "digest").groupBy("shard").agg(F.sum("group_bytes")).collect()
    }
    left = [room - used.get(b, 0) for b, room in enumerate(rooms)]
    small = groups.where(F.col("group_bytes") < large_from)
    slice_of = F.pmod(F.xxhash64("digest"), F.lit(slices)).alias("slice")
    placed_small = small.withColumn("slice", slice_of).groupBy("slice").applyInArrow(
        _packer(left, slices), "digest binary, shard int"
    )
    return placed_large.unionByName(placed_small)


def shard_documents(docs: DataFrame, shards: int = 40, slice_rows: int = SLICE) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 within the shard) of every row."""
    rows = row_facts(docs)
    groups = settle(
        rows.groupBy("digest").agg(F.sum("size").alias("group_bytes"), F.min(F.xxhash64("digest")).alias("tie")),
        "shard-groups",
    )
    assigned = assign_groups(groups, shards, slice_rows)
    placed = settle(rows.join(assigned, "digest").drop("digest"), "shard-assigned")
    # Slots: rows of a shard are numbered in pieces of bounded size, each piece after those before it.
    pieces = pieces_for(placed.count(), slice_rows)
    placed = placed.withColumn("piece", F.pmod(F.xxhash64("row"), F.lit(pieces)))
    counts = placed.groupBy("shard", "piece").count()
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "piece", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "piece").orderBy("doc_id", "row")
    return placed.withColumn("n", F.row_number().over(within)).join(starts, ["shard", "piece"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("n") - 1).alias("slot")
    )

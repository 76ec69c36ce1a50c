"""Near-duplicate documents by min-max hashing, with exact confirmation of every link.

A document is the set of its word shingles. Each hash function gives two signature values, the smallest and the largest
hash of the set, so half as many functions are evaluated; bands of signature values deal documents into buckets.
Equal sets are one node from the start. In a bucket every node meets the bucket's most popular node
(the one that shares most buckets overall), not every other one; links are confirmed on the full sets, and components are
formed. What this leaves undecided are nodes outside
the component of a bucket's leader: they meet the members of other components in their bucket, but only pairs that can
be similar enough leave that join. An odd sketch decides it without error: a set flips one of 2048 bits for each shingle,
so two sketches never differ in more bits than the sets in shingles. No bucket is cut and none is gathered in
one task.

NULL and empty texts and texts without words have no set, link with nothing and are kept. A text with fewer words than
a shingle is one shingle. Rows with equal texts are one component; rows that share a doc_id are told apart
by a row number that is written beside them, and a NULL doc_id is never the smallest of a component that has another.
``drop_near_duplicates`` keeps one row of a component, the first by doc_id (NULL last) and row number. Other columns are
ignored (or kept, in ``drop_near_duplicates``); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import grouped, mix, random_table, same, settle, texts_of
from remitlens.llm.components import components
from remitlens.llm.words import shingle_hashes


@dataclass(frozen=True)
class Likeness:
    """Shingle length, the least similarity as a ratio, and bands x rows signature values.

    A pair at the threshold s is missed by all bands with probability (1 - s**rows)**bands.
    """

    words: int = 5
    least: int = 80
    of: int = 100
    bands: int = 31
    rows: int = 4


#: (1 - 0.8**4)**31 = 8e-8
DEFAULT = Likeness()
#: (1 - 0.85**5)**25 = 4e-7
STRICT = Likeness(words=3, least=85, bands=25, rows=5)

#: Bytes of sets that a worker remembers while it confirms pairs.
KEPT_BYTES = 32 << 20

#: 64-bit words of an odd sketch.
SKETCH_WORDS = 32

NODE = "row long, doc_id long, n_shingles long, d1 long, d2 long, buckets array<long>, sketch array<long>"


def _digest(distinct: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        return tuple(int(mix(distinct, s).sum(dtype=np.uint64).view(np.int64)) for s in (31, 32))


def _odd_sketch(distinct: np.ndarray) -> np.ndarray:
    bits = (mix(distinct, 33) & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64)
    odd = np.bincount(bits, minlength=64 * SKETCH_WORDS).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def _lists(rows: np.ndarray) -> pa.ListArray:
    """The rows of a matrix of integers as lists."""
    offsets = np.arange(rows.shape[0] + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).reshape(-1)))


def _signature_batches(like: Likeness) -> Callable:
    functions = -(-like.bands * like.rows // 2)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, terms = random_table(functions, 41) | np.uint64(1), random_table(functions, 42)
        seeds = random_table(like.bands, 43)
        for batch in batches:
            texts = [t or b"" for t in texts_of(batch)]
            rows, ids = batch.column("row"), batch.column("doc_id")
            for a, b in grouped(texts):
                hashes, numbers = shingle_hashes(texts[a:b], like.words)
                firsts = np.cumsum(numbers) - numbers
                full = numbers > 0
                signature = np.zeros((b - a, 2 * functions), np.uint64)
                if full.any():
                    with np.errstate(over="ignore"):
                        for f in range(functions):
                            values = (hashes ^ terms[f]) * factors[f]
                            signature[full, 2 * f] = np.minimum.reduceat(values, firsts[full])
                            signature[full, 2 * f + 1] = np.maximum.reduceat(values, firsts[full])
                values = mix(signature[:, : like.bands * like.rows]).reshape(b - a, like.bands, like.rows)
                buckets = np.broadcast_to(seeds, (b - a, like.bands))
                with np.errstate(over="ignore"):
                    for r in range(like.rows):
                        buckets = mix(buckets + values[:, :, r], r)
                sizes, digests = [], []
                sketches = np.empty((b - a, SKETCH_WORDS), np.int64)
                for i, (first, number) in enumerate(zip(firsts.tolist(), numbers.tolist(), strict=True)):
                    distinct = np.unique(hashes[first : first + number])
                    sizes.append(len(distinct))
                    digests.append(_digest(distinct))
                    sketches[i] = _odd_sketch(distinct)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows[a:b],
                        ids[a:b],
                        pa.array(sizes, pa.int64()),
                        pa.array([d[0] for d in digests], pa.int64()),
                        pa.array([d[1] for d in digests], pa.int64()),
                        _lists(np.ascontiguousarray(buckets).view(np.int64)),
                        _lists(sketches),
                    ],
                    names=["row", "doc_id", "n_shingles", "d1", "d2", "buckets", "sketch"],
                )

    return signed


def _confirm_batches(like: Likeness) -> Callable:
    """Pairs whose full sets are similar enough. Texts that aren't the node's own (its digest differs) are dropped."""

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[int, int], np.ndarray | None] = {}
        held = 0

        def set_of(node: int, text: bytes, digest: tuple[int, int]) -> np.ndarray | None:
            key = (node, hash(text))
            nonlocal held
            if key not in kept:
                if held > KEPT_BYTES:
                    kept.clear()
                    held = 0
                found = np.unique(shingle_hashes([text], like.words)[0])
                held += found.nbytes + 200
                kept[key] = found if _digest(found) == digest else None
            return kept[key]

        for batch in batches:
            left, right = texts_of(batch, "text_a"), texts_of(batch, "text_b")
            a, b, a1, a2, b1, b2 = (batch.column(c).to_pylist() for c in ("a", "b", "a1", "a2", "b1", "b2"))
            hits = []
            for i in range(len(a)):
                one = set_of(a[i], left[i] or b"", (a1[i], a2[i]))
                two = set_of(b[i], right[i] or b"", (b1[i], b2[i]))
                if one is None or two is None:
                    continue
                common = len(np.intersect1d(one, two, assume_unique=True))
                if like.of * common >= like.least * (len(one) + len(two) - common):
                    hits.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in hits], pa.int64()), pa.array([b[i] for i in hits], pa.int64())], names=["u", "v"]
            )

    return confirmed


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as the column ``doc``, with a row number; written, so that the numbers stay."""
    return settle(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "numbered")


def _texts_of_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, d1, d2 and the text of the row that is the node."""
    texts = rows.select(F.col("row").alias("of_row"), "text")
    return settle(texts.join(nodes, F.col("of_row") == F.col("node")).select("node", "d1", "d2", "text"), "texts")


def _links(pairs: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """Confirmed pairs. ``pairs``: a, b."""
    left = texts.select(
        F.col("node").alias("a"), F.col("d1").alias("a1"), F.col("d2").alias("a2"), F.col("text").alias("text_a")
    )
    right = texts.select(
        F.col("node").alias("b"), F.col("d1").alias("b1"), F.col("d2").alias("b2"), F.col("text").alias("text_b")
    )
    rows = pairs.join(left, "a").join(right, "b")
    rows = rows.select("a", "b", "a1", "a2", "b1", "b2", "text_a", "text_b")
    return settle(rows.mapInArrow(_confirm_batches(like), "u long, v long").distinct(), "links")


def _sized(pairs: DataFrame, like: Likeness) -> DataFrame:
    """Distinct pairs (a < b) whose set sizes allow the similarity. ``pairs``: x, y, nx, ny."""
    small, large = F.least("nx", "ny"), F.greatest("nx", "ny")
    kept = pairs.where((F.col("x") != F.col("y")) & (small * like.of >= large * like.least))
    return kept.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    joined = members.join(roots.withColumnRenamed("node", "key"), F.col("node") == F.col("key"), "left")
    return joined.withColumn("root", F.coalesce("root", "node")).drop("key")


def _leaders(members: DataFrame) -> DataFrame:
    """The most popular node of each bucket, with its size."""
    best = F.max(F.struct("popularity", (-F.col("node")).alias("order"), "n")).alias("lead")
    return members.groupBy(F.col("bucket").alias("of")).agg(best).select(
        "of", (-F.col("lead.order")).alias("leader"), F.col("lead.n").alias("leader_n")
    )


def _may_be_similar(nx: str, ny: str, px: str, py: str, like: Likeness) -> Column:
    """False only if the odd sketches prove that two sets differ in too many shingles."""
    both = F.col(nx) + F.col(ny)
    # Two sets of together ``both`` shingles have at least this many in common, rounded up.
    common = F.call_function("div", both * like.least + like.of + like.least - 1, F.lit(like.of + like.least))
    bits = [F.bit_count(F.get(px, F.lit(i)).bitwiseXOR(F.get(py, F.lit(i)))) for i in range(SKETCH_WORDS)]
    return reduce(add, bits) <= both - common * 2


def _placed(numbered: DataFrame, like: Likeness) -> DataFrame:
    """row, doc_id, n_shingles and root (of the component; NULL without shingles) of every row."""
    rows = numbered.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").cast("string").alias("text"))
    sets = settle(rows.mapInArrow(_signature_batches(like), NODE), "sets")
    full = sets.where("n_shingles > 0")
    classes = settle(full.groupBy("d1", "d2").agg(F.min("row").alias("node")), "classes")
    nodes = full.join(classes.select("node"), F.col("row") == F.col("node"))
    dealt = nodes.select(F.explode("buckets").alias("bucket"), "node", F.col("n_shingles").alias("n"))
    shared = dealt.groupBy(F.col("bucket").alias("of")).agg(F.count("*").alias("c")).where("c > 1")
    # Written, so that both sides of the join are plain shuffles, of which Spark splits a hot bucket's partition.
    shared = settle(shared.select("of", "c"), "buckets")
    shared = dealt.join(shared, F.col("bucket") == F.col("of")).drop("of")
    popularity = shared.groupBy(F.col("node").alias("key")).agg(F.sum("c").alias("popularity"))
    members = shared.join(popularity, F.col("node") == F.col("key")).select("bucket", "node", "n", "popularity")
    members = settle(members, "members")
    wanted = members.select(F.col("node").alias("w")).distinct()
    sketches = nodes.join(wanted, F.col("node") == F.col("w")).select("node", F.col("n_shingles").alias("n"), "sketch")
    sketches = settle(sketches, "sketches")
    texts = _texts_of_nodes(rows, nodes.join(wanted, F.col("node") == F.col("w")).select("node", "d1", "d2"))

    # Stars: one pair for each member of a bucket.
    led = members.join(_leaders(members), F.col("bucket") == F.col("of")).drop("of")
    pairs = led.select(
        F.col("leader").alias("x"), F.col("node").alias("y"), F.col("leader_n").alias("nx"), F.col("n").alias("ny")
    )
    of_x, of_y = (sketches.select(*[F.col(c).alias(f"{c}_{e}") for c in ("node", "n", "sketch")]) for e in "ab")
    stars = _sized(pairs, like).join(of_x, F.col("a") == F.col("node_a")).join(of_y, F.col("b") == F.col("node_b"))
    stars = stars.where(_may_be_similar("n_a", "n_b", "sketch_a", "sketch_b", like)).select("a", "b")
    links = _links(stars, texts, like)
    roots = settle(components(links), "roots")

    # The rest: members of buckets in which a node is outside its leader's component.
    of_leader = roots.select(F.col("node").alias("l"), F.col("root").alias("leader_root"))
    labelled = _labelled(led, roots).join(of_leader, F.col("leader") == F.col("l"), "left")
    labelled = labelled.withColumn("outside", F.col("root") != F.coalesce("leader_root", "leader"))
    labelled = settle(labelled.select("bucket", "node", "root", "outside"), "labelled")
    mixed = labelled.where("outside").select(F.col("bucket").alias("of")).distinct()
    rest = labelled.join(mixed, F.col("bucket") == F.col("of")).drop("of")
    rest = settle(rest.join(sketches.withColumnRenamed("node", "k"), F.col("node") == F.col("k")).drop("k"), "undecided")
    if not rest.isEmpty():
        names = ("node", "n", "root", "sketch")
        left = rest.where("outside").select("bucket", *[F.col(c).alias(f"{c}_x") for c in names])
        right = rest.select("bucket", *[F.col(c).alias(f"{c}_y") for c in names])
        small, large = F.least("n_x", "n_y"), F.greatest("n_x", "n_y")
        pairs = left.join(right, "bucket").where(
            (F.col("root_x") != F.col("root_y"))
            & (small * like.of >= large * like.least)
            & _may_be_similar("n_x", "n_y", "sketch_x", "sketch_y", like)
        )
        pairs = pairs.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()
        more = _links(pairs, texts, like)
        if not more.isEmpty():
            roots = components(links.unionByName(more))
    of_class = _labelled(classes, roots)
    placed = sets.join(of_class.withColumnsRenamed({"d1": "e1", "d2": "e2"}), (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left")
    placed = placed.withColumn("root", F.when(F.col("n_shingles") > 0, F.col("root")))
    return placed.select("row", "doc_id", "n_shingles", "root")


def near_duplicates(docs: DataFrame, like: Likeness = DEFAULT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the component) and kept, for every row."""
    placed = _placed(_numbered(docs.select("doc_id", "text")), like)
    least = placed.where("root is not null").groupBy(F.col("root").alias("of")).agg(F.min("doc_id").alias("least"))
    return placed.join(least, F.col("root") == F.col("of"), "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        same(F.col("doc_id"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, like: Likeness = DEFAULT) -> DataFrame:
    """The rows of ``docs``, all columns, one of each component; rows without shingles all stay."""
    numbered = _numbered(docs)
    placed = _placed(numbered, like).where("root is not null").select("row", "doc_id", "root")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    first = placed.groupBy(F.col("root").alias("of")).agg(first).select("of", F.col("first.row").alias("stays"))
    gone = placed.join(first, F.col("root") == F.col("of")).where(F.col("row") != F.col("stays"))
    return numbered.join(gone.select(F.col("row").alias("gone")), F.col("row") == F.col("gone"), "left_anti").select("doc.*")

"""Mixing sources to target weights by balanced sampling with the cube method.

Sources weigh 1, 2, 3, 1, 2, 3 ... in the order of their names. Their targets share the words of all documents by weight, but
none is above ``CAP`` times its source's words; what is over goes to the others by weight until none is above. Each
document is then taken a whole number of times: the rate target / words rounded down, or once more. Who is taken once more is
a balanced sample:

1. Flight. Every document starts with the fraction of its rate as its inclusion. Three open documents at a time are
   moved along the null-space of the two balances, their words and their number, in a direction and by a step drawn so that
   no inclusion changes in expectation, until one of them is decided. Words and documents of the source stay as they are.
2. Landing. The last documents that are left open at the end of a source are rounded together, so that words and, with less weight,
   documents stay nearest to what they were.

A source's documents are dealt into blocks of bounded size by a hash. Each block is one flight that leaves at most two documents
open, and these are dealt into blocks again, until one block per source is left; so a hot source is as many tasks as it has
blocks, and a level has a thousandth of the rows of the one before. Draws depend on the source, block and level alone:
reruns agree, however the rows are partitioned.

Rows that are equal in (doc_id, source, size) are one unit of n rows until the end; they take the unit's copies in even shares,
so that repeated rows of any number never meet in one block. NULL text has no words and is taken 0 times; NULL source is a source of
its own, the last one; NULL doc_id is an id like others; other columns are ignored whatever their names. In an empty table, or one
without words, nothing is taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import same, settle
from remitlens.operators.ranking import running_totals

WEIGHTS, CAP = (1, 2, 3), 3
#: Documents of one flight, and documents that are rounded together at its end.
BLOCK, LANDING = 2_000, 14
DOCUMENT = 0.01
#: Sources whose names have this many bytes together are broadcast; beyond, they are joined by a shuffle.
BROADCAST_BYTES = 4 << 20
#: Inclusions this near to 0 or 1 are decided.
EPSILON = 1e-9
#: Equal rows that are unfolded at a time.
UNFOLD = 1 << 14


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def units(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the number of rows that have them."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"))
    return rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))


def _level(sources: DataFrame, total: int) -> float:
    """Words per weight of the sources that are not capped; raised until no other source is above its cap."""
    level, capped = 0.0, -1
    above = F.col("weight") * F.lit(0.0) > F.col("most")
    while True:
        row = sources.agg(
            F.count(F.when(above, F.lit(1))).alias("capped"),
            F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if row["capped"] == capped or not row["weight"]:
            return level
        capped, level = row["capped"], (total - row["full"]) / row["weight"]
        above = F.col("weight") * F.lit(level) > F.col("most")


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, its number, units, words and target. ``rows``: ``units``."""
    by_source = rows.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("units")
    )
    numbered = running_totals(by_source, [F.col("source").asc_nulls_last()], {"number": F.lit(1)}, "mix-sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    sources = settle(
        numbered.withColumns({"weight": weight.cast("long"), "most": F.col("source_size") * cap}), "mix-weights"
    )
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = _level(sources, total)
    target = F.least(F.col("weight") * F.lit(level), F.col("most").cast("double"))
    return sources.select("source", "number", "units", "source_size", target.alias("target"))


def flight(sizes: list[float], inclusion: list[float], rng: np.random.Generator, leave: int) -> list[int]:
    """Moves inclusions to 0 or 1 with the words and the number of documents as they were, until ``leave`` (two at least) or fewer are
    open; returns those. Changes ``inclusion``."""
    active: list[int] = []
    waiting, n = 0, len(sizes)
    while True:
        while len(active) < 3 and waiting < n:
            if EPSILON < inclusion[waiting] < 1 - EPSILON:
                active.append(waiting)
            else:
                inclusion[waiting] = round(inclusion[waiting])
            waiting += 1
        if len(active) < 3 or len(active) + n - waiting <= leave:
            return active + [i for i in range(waiting, n) if EPSILON < inclusion[i] < 1 - EPSILON]
        a, b, c = (sizes[i] for i in active)
        direction = (b - c, c - a, a - b) if a != b or b != c else (1, -1, 0)
        up = down = np.inf
        for i, u in zip(active, direction, strict=True):
            p = inclusion[i]
            if u > 0:
                up, down = min(up, (1 - p) / u), min(down, p / u)
            elif u < 0:
                up, down = min(up, -p / u), min(down, (p - 1) / u)
        step = up if rng.random() * (up + down) < down else -down
        still = []
        for i, u in zip(active, direction, strict=True):
            p = inclusion[i] = inclusion[i] + step * u
            if EPSILON < p < 1 - EPSILON:
                still.append(i)
            else:
                inclusion[i] = round(p)
        active = still


def land(sizes: np.ndarray, inclusion: np.ndarray) -> np.ndarray:
    """The rounding of a few inclusions that keeps words and documents nearest; a document weighs ``DOCUMENT`` of their mean size."""
    choices = (np.arange(1 << len(sizes))[:, None] >> np.arange(len(sizes))) & 1
    words = np.abs(choices @ sizes - inclusion @ sizes) / sizes.mean()
    return choices[np.argmin(words + DOCUMENT * np.abs(choices.sum(axis=1) - inclusion.sum()))]


OPEN = ("doc_id", "size", "n", "number", "source_size", "target", "base", "inclusion", "blocks")
FLOWN = "doc_id long, size long, n long, number long, source_size long, target double, base long, inclusion double, blocks long"


def _flyer(level: int, block_rows: int):
    def fly(key: tuple, table: pa.Table) -> pa.Table:
        number, block = (k.as_py() for k in key)
        # Small documents first: a large one that is left alone with small ones can't be rounded without an error of its
        # size, but a few large ones have roundings that cancel. Equal units are one, so the order is settled.
        order = [("size", "ascending"), ("tie", "ascending"), ("doc_id", "ascending")]
        table = table.sort_by(order)
        sizes = table.column("size").to_numpy().astype(float)
        inclusion = table.column("inclusion").to_pylist()
        is_last = table.column("blocks")[0].as_py() == 1
        rng = np.random.default_rng([number, block, level])
        left = flight(sizes.tolist(), inclusion, rng, LANDING if is_last else 2)
        out = np.array(inclusion)
        if is_last and left:
            out[left] = land(sizes[left], out[left])
        blocks = -(-2 * table.column("blocks").to_numpy() // block_rows)
        table = table.select(list(OPEN[:-2]))
        return table.append_column("inclusion", pa.array(out)).append_column("blocks", pa.array(blocks, pa.int64()))

    return fly


def _decided() -> Column:
    return (F.col("inclusion") == 0.0) | (F.col("inclusion") == 1.0)


def sampled(open_units: DataFrame, most_blocks: int, block_rows: int) -> DataFrame:
    """``open_units`` with every inclusion moved to 0 or 1, level by level."""
    done, level = [], 0
    while True:
        tie = F.xxhash64("doc_id", "size", "n")
        dealt = open_units.select(*OPEN, tie.alias("tie"), F.pmod(F.xxhash64(tie, F.lit(level)), F.col("blocks")).alias("block"))
        flown = dealt.groupBy("number", "block").applyInArrow(_flyer(level, block_rows), FLOWN)
        flown = settle(flown, f"mix-level-{level}")
        done.append(flown.where(_decided()))
        if most_blocks == 1:
            break
        open_units = flown.where(~_decided())
        most_blocks, level = -(-2 * most_blocks // block_rows), level + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block_rows: int = BLOCK
) -> DataFrame:
    """doc_id, size, source_size, target (its source's), taken (words, repeats counted) and copies of every row."""
    rows = settle(units(docs), "mix-units")
    sources = settle(targets(rows, weights, cap), "mix-targets")
    named, most_units = sources.agg(
        F.coalesce(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 64), F.lit(0)), F.coalesce(F.max("units"), F.lit(1))
    ).first()
    beside = sources.withColumnRenamed("source", "of_source")
    beside = F.broadcast(beside) if named <= BROADCAST_BYTES else beside
    want = F.coalesce(F.col("n") * F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    base = F.floor(F.col("want") + EPSILON).cast("long")
    planned = rows.join(beside, same(F.col("source"), F.col("of_source"))).withColumn("want", want)
    planned = planned.withColumn("base", base).withColumn("inclusion", F.greatest(F.col("want") - F.col("base"), F.lit(0.0)))
    planned = planned.withColumn("blocks", F.ceil(F.col("units") / block_rows).cast("long"))
    is_open = (F.col("inclusion") > EPSILON) & (F.col("size") > 0)
    planned = settle(planned.select(*OPEN, is_open.alias("is_open")), "mix-planned")
    closed = planned.where(~F.col("is_open")).withColumn("inclusion", F.lit(0.0))
    chosen = sampled(planned.where("is_open"), -(-most_units // block_rows), block_rows)
    both = closed.select(*OPEN).unionByName(chosen)
    copies = both.select("*", (F.col("base") + F.col("inclusion").cast("long")).alias("all_copies"))
    # Equal rows share the copies evenly, in pieces of bounded size.
    pieces = copies.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / UNFOLD))))
    last = F.least(F.col("n"), (F.col("piece") + 1) * UNFOLD) - 1
    rows_again = pieces.withColumn("row", F.explode(F.sequence(F.col("piece") * UNFOLD, last)))
    share = F.floor(F.col("all_copies") / F.col("n")) + (F.col("row") < F.col("all_copies") % F.col("n")).cast("long")
    return rows_again.select(
        "doc_id", "size", "source_size", "target", (share * F.col("size")).cast("long").alias("taken"), share.cast("long").alias("copies")
    )

"""Line deduplication by winnowing, in DataFrame functions only.

Every line is hashed. Of any ``run`` consecutive lines the one with the least hash (the last of several) is the
fingerprint, so two places with the same run of lines have the same fingerprint in it. Fingerprints found at a single
place end there; every window of the others is grouped exactly by the hashes of its lines. Positions are not joined
pairwise and no match is extended. A window whose lines also start at an earlier place is a repeat; overlapping and
touching repeats are one run, and the lines of such runs are deleted.

Places are ordered by doc_id (NULL first), then by text hash and line number. Lines are compared as they are, parted at line feeds. NULL
texts are empty: one empty line. Texts with fewer lines than ``run`` stay as they are. Rows that share doc_id and text
are one place: they keep the same lines. Other columns are ignored (or kept, in ``drop_repeated_lines``); an
empty table gives an empty result. Hashes of ``run`` lines decide together, 64 bits each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from remitlens.llm.common import same, settle

#: Lines of the shortest repeat that is deleted, and of a winnowing window.
RUN = 3


def _lines(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _windows(docs: DataFrame, run: int) -> DataFrame:
    """doc_id, th, first (line number), lines (hashes), fingerprint and its line, of every window."""
    hashed = docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("th"),
        F.transform(_lines("text"), lambda line: F.xxhash64(line)).alias("hashes"),
    ).where(F.size("hashes") >= run)

    def window(i: Column) -> Column:
        inside = F.transform(
            F.sequence(F.lit(0), F.lit(run - 1)), lambda j: F.struct(F.get("hashes", i + j).alias("h"), (-j).alias("back"))
        )
        return F.struct(i.alias("first"), F.array_min(inside).alias("least"), F.slice("hashes", i + 1, run).alias("lines"))

    exploded = hashed.select(
        "doc_id", "th", F.explode(F.transform(F.sequence(F.lit(0), F.size("hashes") - run), window)).alias("w")
    )
    return exploded.select(
        "doc_id",
        "th",
        "w.first",
        "w.lines",
        F.col("w.least.h").alias("fingerprint"),
        (F.col("w.first") - F.col("w.least.back")).alias("line"),
    )


def repeated_runs(docs: DataFrame, run: int = RUN) -> DataFrame:
    """doc_id, th (hash of the text) and the runs to delete (start, stop in lines), one row per text that has any."""
    windows = settle(_windows(docs, run), "line-windows")
    spread = windows.groupBy(F.col("fingerprint").alias("f")).agg(
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("doc_id", "th", "line") for f in (F.min, F.max)],
        F.count("doc_id").alias("named"),
        F.count("*").alias("all"),
    )
    places = [~same(F.col(f"min_{c}"), F.col(f"max_{c}")) for c in ("doc_id", "th", "line")]
    # A NULL doc_id beside others is a second place too.
    spread = spread.where(places[0] | places[1] | places[2] | ((F.col("named") > 0) & (F.col("named") < F.col("all"))))
    # Written, so that both sides of the join are plain shuffles, of which Spark splits a hot line's partition.
    spread = settle(spread.select("f"), "fingerprints")
    joined = windows.join(spread, F.col("fingerprint") == F.col("f"))
    place = F.struct("doc_id", "th", "first")
    joined = settle(joined.select("lines", place.alias("place")), "line-matches")
    first = joined.groupBy(F.col("lines").alias("same_lines")).agg(F.min("place").alias("earliest"), F.max("place").alias("latest"))
    first = settle(first.where(~same(F.col("earliest"), F.col("latest"))).select("same_lines", "earliest"), "first-lines")
    repeats = joined.join(first, F.col("lines") == F.col("same_lines")).where(~same(F.col("place"), F.col("earliest")))
    repeats = repeats.select("place.*").distinct()
    in_text = Window.partitionBy("doc_id", "th").orderBy("first")
    begins = F.coalesce(F.col("first") > F.lag("first").over(in_text) + run, F.lit(True)).cast("int")
    islands = repeats.withColumn("begins", begins).withColumn("island", F.sum("begins").over(in_text))
    runs = islands.groupBy("doc_id", "th", "island").agg(
        F.min("first").alias("start"), (F.max("first") + run).alias("stop")
    )
    return runs.groupBy("doc_id", "th").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("runs"))


def _joined(docs: DataFrame, run: int) -> DataFrame:
    """``docs`` as the column ``doc``, and its runs (NULL if none) as ``runs``."""
    runs = repeated_runs(docs, run).select(F.col("doc_id").alias("run_id"), F.col("th").alias("run_th"), "runs")
    rows = docs.select(F.struct("*").alias("doc"))
    matches = same(F.col("doc.doc_id").cast("long"), F.col("run_id")) & (F.xxhash64("doc.text") == F.col("run_th"))
    return rows.join(runs, matches, "left").select("doc", "runs")


def _kept_text() -> Column:
    def stays(_line: Column, number: Column) -> Column:
        return ~F.exists("runs", lambda r: (number >= r["start"]) & (number < r["stop"]))

    kept = F.array_join(F.filter(_lines("doc.text"), stays), "\n")
    return F.when(F.col("runs").isNull(), F.coalesce(F.col("doc.text"), F.lit(""))).otherwise(kept)


def deduplicated_lines(docs: DataFrame, run: int = RUN) -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs and the text that stays, for every row."""
    removed = F.aggregate("runs", F.lit(0), lambda total, r: total + r["stop"] - r["start"])
    return _joined(docs, run).select(
        "doc.doc_id",
        F.size(_lines("doc.text")).cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("runs"), F.lit(0)).cast("long").alias("n_runs"),
        _kept_text().alias("kept_text"),
    )


def drop_repeated_lines(docs: DataFrame, run: int = RUN) -> DataFrame:
    """``docs`` with the repeated runs cut from the texts; texts with no line left are dropped, others keep all columns."""
    rows = _joined(docs, run)
    whole = F.col("runs").isNotNull() & (
        F.aggregate("runs", F.lit(0), lambda total, r: total + r["stop"] - r["start"]) >= F.size(_lines("doc.text"))
    )
    text = F.when(F.col("runs").isNull(), F.col("doc.text")).otherwise(_kept_text())
    columns = [text.alias("text") if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns]
    return rows.where(~F.coalesce(whole, F.lit(False))).select(*columns)

"""Periodic runs of words: stretches that repeat themselves at least four times, and texts with the repeats collapsed.

A run is a stretch with smallest period q (words q apart are equal) of at least ``max(LEAST, TIMES * q)`` words that no neighbour
extends. Each text is worked on by itself, so the documents need no shuffle:

1. Words are split at white space and numbered by their bytes, so equal numbers are equal words.
2. A screen finds where runs can be. Inside a run, from its first period on, every three neighbouring words have stood
   at most q places before; so a run lies in a stretch of places whose last equal triple is no farther back than
   the stretch allows. Places outside of such stretches hold no run, whatever their words; most texts end here.
3. Such a stretch is made a suffix automaton. Its words are appended one by one: the state of the prefix is accessed in a link-cut
   tree over the suffix links, whose preferred paths are the states with the same last end. Every path segment that the
   access crosses gives its last end and its longest string; if the distance d between that end and the new one
   is within a part of the length, the suffix has period d, d is the smallest one, and the whole stretch is a run as soon as the next
   word breaks it. Then all crossed segments get the new end.
4. Runs that touch the border of the screened stretch are extended in the text.

A word goes if a run contains it behind the run's first q words. A text of n words takes O(n log n) steps, and about 1 KB of
memory per word of its screened stretches, however long it is; the rest takes some 100 bytes a word.

NULL text counts as empty: no words, no runs, an empty collapsed text. Equal rows give equal rows, doc_id is carried
through as it is (NULL included), other columns are ignored whatever their names, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import texts_of

#: A run has at least so many words, and so many times its period.
LEAST, TIMES = 6, 4
#: Rounds of the screen; each narrows the stretches, and any round's stretches hold all runs.
ROUNDS = 8

Run = tuple[int, int, int]


def suffix_automaton(codes: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Longest string and suffix link of each state, and the state of each prefix. State 0 is the empty string."""
    longest, link, follow, prefixes = [0], [-1], [{}], []
    last = 0
    for code in codes:
        state = len(longest)
        longest.append(longest[last] + 1)
        link.append(0)
        follow.append({})
        at, last = last, state
        while at >= 0 and code not in follow[at]:
            follow[at][code] = state
            at = link[at]
        if at >= 0:
            target = follow[at][code]
            if longest[target] == longest[at] + 1:
                link[state] = target
            else:
                twin = len(longest)
                longest.append(longest[at] + 1)
                link.append(link[target])
                follow.append(dict(follow[target]))
                while at >= 0 and follow[at].get(code) == target:
                    follow[at][code] = twin
                    at = link[at]
                link[target] = link[state] = twin
        prefixes.append(state)
    return longest, link, prefixes


class LastEnds:
    """A link-cut tree over suffix links: each preferred path is a splay tree by depth, and holds at its root the last place
    where its strings ended. Node 0, the empty string, stands for no node."""

    def __init__(self, links: list[int]):
        self.up = [max(link, 0) for link in links]
        self.left, self.right, self.end = [0] * len(links), [0] * len(links), [-1] * len(links)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            child = left[p] = right[x]
            right[x] = p
        else:
            child = right[p] = left[x]
            left[x] = p
        if child:
            up[child] = p
        up[p], up[x] = x, g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def _splay(self, x: int) -> None:
        """Makes x the root of its preferred path's tree; the path's last end moves with the root."""
        up, left, right = self.up, self.left, self.right
        root = x
        while (p := up[x]) and (left[p] == x or right[p] == x):
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                root = g
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            else:
                root = p
            self._rotate(x)
        self.end[x] = self.end[root]

    def access(self, x: int, place: int) -> list[tuple[int, int]]:
        """(state, last end) of each segment from x to the top, deepest first; then all of them end at ``place``."""
        found, below = [], 0
        right, end, up = self.right, self.end, self.up
        while x:
            self._splay(x)
            found.append((x, end[x]))
            if cut := right[x]:
                end[cut] = end[x]
            right[x] = below
            below, x = x, up[x]
        end[below] = place
        return found


def _stretch_runs(codes: list[int], times: int, least: int) -> Iterator[Run]:
    """Start, length and smallest period of the runs of one stretch."""
    longest, link, prefixes = suffix_automaton(codes)
    tree, n = LastEnds(link), len(codes)
    for place, state in enumerate(prefixes):
        for node, end in tree.access(state, place):
            period, length = place - end, longest[node]
            if end < 0 or length < (times - 1) * period or length + period < least:
                continue
            if place + 1 == n or codes[place + 1] != codes[place + 1 - period]:
                yield place + 1 - length - period, length + period, period


def _last_equal(ids: np.ndarray) -> np.ndarray:
    """Distance of each triple of neighbouring words to its last equal; 0 where there is none."""
    size = int(ids.max()) + 1
    pairs = ids[:-1] * size + ids[1:]
    if size >= 1 << 21:  # three numbers no longer fit 63 bits; pairs are numbered first
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    triples = pairs[:-1] * size + ids[2:]
    order = np.argsort(triples, kind="stable")
    equal = triples[order[1:]] == triples[order[:-1]]
    out = np.zeros(len(triples), np.int64)
    out[order[1:][equal]] = np.diff(order)[equal]
    return out


def _stretches(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def screened(ids: np.ndarray, times: int = TIMES, least: int = LEAST) -> list[tuple[int, int]]:
    """Disjoint ranges of words that hold every run.

    A run of period q has L >= max(least, times * q) words, and L - 2 - q places from the first period on whose triple stood
    at most q places before. So in a stretch of m such places q is at most (m + 2) / (times - 1).
    """
    if len(ids) < least:
        return []
    distance = _last_equal(ids)
    inside = distance > 0
    # The fewest such places of a run, at the largest period that ``least`` words hold.
    fewest = least - 2 - least // times
    for _ in range(ROUNDS):
        starts, stops = _stretches(inside)
        fits = stops - starts >= fewest
        starts, stops = starts[fits], stops[fits]
        farthest = (stops - starts + 2) // (times - 1)
        keep = np.zeros(len(inside), bool)
        for start, stop, most in zip(starts, stops, farthest, strict=True):
            keep[start:stop] = distance[start:stop] <= most
        if (keep == inside).all():
            break
        inside = keep
    ranges: list[tuple[int, int]] = []
    for start, stop, most in zip(starts.tolist(), stops.tolist(), farthest.tolist(), strict=True):
        low, high = max(0, start - most), min(len(ids), stop + 2)
        if ranges and low <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], max(high, ranges[-1][1]))
        else:
            ranges.append((low, high))
    return ranges


def _reach(ids: np.ndarray, start: int, stop: int, period: int) -> tuple[int, int]:
    """The stretch of that period around [start, stop), as far as the text goes."""
    while stop < len(ids) and ids[stop] == ids[stop - period]:
        stop += 1
    while start and ids[start - 1] == ids[start - 1 + period]:
        start -= 1
    return start, stop


def runs_of(ids: np.ndarray, times: int = TIMES, least: int = LEAST) -> list[Run]:
    """All runs of a sequence of numbered words, by start and period."""
    found: set[Run] = set()
    for low, high in screened(ids, times, least):
        for start, length, period in _stretch_runs(ids[low:high].tolist(), times, least):
            start, stop = low + start, low + start + length
            if start == low or stop == high:
                start, stop = _reach(ids, start, stop, period)
            found.add((start, stop - start, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run repeats, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _finder(times: int, least: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, kept = [], []
            for text in texts_of(batch):
                words = (text or b"").split()  # splits at exactly the six white characters of ASCII
                own = runs_of(numbered(words), times, least)
                runs.append([dict(zip(("start", "length", "period"), run, strict=True)) for run in own])
                kept.append(collapsed(words, own))
            columns = [batch.column("doc_id"), pa.array(runs, pa.list_(_RUN)), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "runs", "collapsed"])

    return find


def periodic_runs(docs: DataFrame, times: int = TIMES, least: int = LEAST) -> DataFrame:
    """doc_id, runs (start, length, period; by start and period) and collapsed text of every row. ``times`` is at least 3."""
    if times < 3 or least < max(times, 4):
        raise ValueError("runs repeat three times at least, and have four words at least")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_finder(times, least), RUNS)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the documents, by a checksum of the id, repeats a stretch of its words up to its end.

    With h the checksum of the id, g = h div 10 and n words, documents with h % 10 = 0 repeat the 1 + (n - a) div (3 + g % 8) words from
    a = g % n on. A NULL id has no checksum and plants nothing.
    """
    text = F.col("text").cast("string")
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words).cast("long")
    check = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(check / 10).cast("long")
    first = g % F.nullif(n, F.lit(0))
    rest = n - first
    period = F.floor(rest / (g % 8 + 3)).cast("long") + 1

    def piece(array: Column, start: Column, length: Column) -> Column:
        return F.slice(array, start.cast("int"), length.cast("int"))

    times = F.ceil(rest / period).cast("int")
    tail = F.flatten(F.array_repeat(piece(words, first + 1, period), times))
    repeated = F.concat(piece(words, F.lit(1), first), piece(tail, F.lit(1), rest))
    is_planted = (check % 10 == 0) & (n > 0)
    return docs.select("doc_id", F.when(is_planted, F.array_join(repeated, " ")).otherwise(text).alias("text"))


def run_facts(found: DataFrame) -> DataFrame:
    """Number of runs, the longest (ties: least start, then period) and digests, from ``periodic_runs``."""
    # The greatest struct is the longest run with the smallest start and period.
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = found.select("doc_id", "runs", "collapsed", best.alias("best"), lines.alias("lines"))
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(F.col("best.l") * 1000 / -F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

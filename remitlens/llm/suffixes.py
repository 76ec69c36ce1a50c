"""Removal of all repeated byte strings of a fixed length, by hash-compared suffix sorting.

Every byte that a string of ``length`` bytes covers is removed if that string also starts anywhere else. To find such
strings without sorting every suffix of the corpus, each string has an anchor: the 64 bytes inside it with the least
hash (the last of several). Equal strings have equal anchors at equal offsets, so:

1. Consecutive strings of a text with the same anchor form a neighbourhood. Neighbourhoods are grouped by anchor. An anchor with one
   place has no repeat; where all neighbourhoods of an anchor are equal, all their strings are repeats.
2. Of the other anchors, each distinct neighbourhood is fetched once. The suffixes that start at the anchors, and the
   reversed prefixes that end there, are merge-sorted; a comparison finds the common extension by binary search over prefix
   polynomial hashes. Neighbours in sorted order have the longest common extensions to the right and to the left. Where one
   neighbour attains each, they give the covered bytes; they are verified byte by byte. Where not, the strings of the
   group are compared one by one.
3. Anchors with very many distinct neighbourhoods are not gathered: their strings are counted as rows by digest.

NULL texts are empty. A text shorter than ``length`` keeps all bytes. Rows that share a doc_id are different documents;
if their texts are equal too, both are removed alike. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import mix, powers, random_table, same, settle, texts_of
from remitlens.llm.spans import cut_spans, text_key

LENGTH = 200
ANCHOR = 64
#: Distinct neighbourhoods of an anchor that one task may hold.
GROUP = 20_000
#: Bytes of neighbourhoods that a task sorts together, whole anchors; prefix hashes take eight times as much, twice.
SORTED_TOGETHER = 2 << 20
#: Strings of unclear groups that are compared at a time.
COMPARED_TOGETHER = 1 << 18
#: A long text is searched in pieces of about this many strings.
PIECE = 1 << 20

_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOW = np.uint64((1 << 20) - 1)

ANCHORS = "doc_id long, key long, a long, n long, low int, high int, at int"
FETCHED = ("copies", "size", "reach", "width", "body")
NEIGHBOURS = "a long, n long, copies long, size long, reach int, width int, body binary"


class PrefixHashes:
    """Polynomial hashes modulo 2**64 of all substrings of a byte string, from the hashes of its prefixes.

    Of many strings one behind the other, ``places`` has the place of each byte in its own, and one more: substrings stay inside
    one, so powers reach no further than the longest. A worker keeps the powers.
    """

    _forward = _backward = np.zeros(0, np.uint64)

    def __init__(self, codes: np.ndarray, seed: int = 61, places: np.ndarray | None = None):
        n = len(codes) + 1 if places is None else int(places.max(initial=0)) + 1
        if len(PrefixHashes._forward) < n:
            PrefixHashes._forward, PrefixHashes._backward = powers(_INVERSE, 2 * n), powers(_BASE, 2 * n)
        self.places = places
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        terms = self.sums[1:]
        with np.errstate(over="ignore"):
            np.multiply(random_table(256, seed)[codes], self._forward[: n - 1] if places is None else self._forward[places[:-1]], out=terms)
            np.cumsum(terms, out=terms)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[stop] - self.sums[start]) * self._backward[start if self.places is None else self.places[start]]


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _neighbourhoods(text: bytes, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, neighbourhood hash, first and last string, and place of the anchor, of each neighbourhood."""
    parts = []
    piece = PIECE - (length - anchor)  # so many strings, that their anchors have at most PIECE places, which the low bits tell apart
    for first in range(0, len(text) - length + 1, piece):
        codes = np.frombuffer(text[first : first + piece + length - 1], np.uint8)
        hashes = PrefixHashes(codes)
        starts = np.arange(len(codes) - anchor + 1)
        grams = mix(hashes.of(starts, starts + anchor))
        # The place breaks ties: the low bits fall as it rises, so the last of equal grams is the least.
        ordered = (grams & ~_LOW) | (_LOW - (starts.astype(np.uint64) & _LOW))
        least = _least_of(ordered, length - anchor + 1)
        edge = np.flatnonzero(least[1:] != least[:-1])
        low = np.concatenate([[0], edge + 1])
        high = np.concatenate([edge, [len(least) - 1]])
        at = low + (((_LOW - (least[low] & _LOW)).astype(np.int64) - low) & int(_LOW))
        body = mix(hashes.of(low, high + length) ^ mix((at - low).astype(np.uint64), 62), 63)
        body = mix(body ^ (high - low).astype(np.uint64), 64)
        parts.append((grams[at].view(np.int64), body.view(np.int64), low + first, high + first, at + first))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _anchor_batches(length: int, anchor: int) -> Callable:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, parts = [], [], []
            for doc_id, key, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), texts_of(batch), strict=True
            ):
                if text and len(text) >= length:
                    parts.append(_neighbourhoods(text, length, anchor))
                    ids += [doc_id] * len(parts[-1][0])
                    keys += [key] * len(parts[-1][0])
            if parts:
                a, n, low, high, at = (np.concatenate(p) for p in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(keys, pa.int64()),
                        pa.array(a),
                        pa.array(n),
                        *[pa.array(x.astype(np.int32)) for x in (low, high, at)],
                    ],
                    names=["doc_id", "key", "a", "n", "low", "high", "at"],
                )

    return found


def _body_batches(length: int) -> Callable:
    """The bytes of the wanted neighbourhoods of each text."""

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in NEIGHBOURS.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        for batch in batches:
            rows = []
            for text, wanted in zip(texts_of(batch), batch.column("wanted").to_pylist(), strict=True):
                rows += [
                    (w["a"], w["n"], w["copies"], w["size"], w["at"] - w["low"], w["high"] - w["low"], text[w["low"] : w["high"] + length])
                    for w in wanted
                ]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

    return fetched


class SuffixSorter:
    """Merge sort of suffixes within groups, compared through prefix hashes.

    ``starts`` and ``stops`` delimit the suffixes in ``codes``; ``sizes`` are the lengths of the groups of consecutive suffixes.
    ``places`` as for PrefixHashes.
    """

    def __init__(self, codes: np.ndarray, starts: np.ndarray, stops: np.ndarray, sizes: np.ndarray, places: np.ndarray | None = None):
        self.codes, self.starts, self.lengths = codes, starts, stops - starts
        self.hashes = PrefixHashes(codes, places=places)
        self.first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.size = np.repeat(sizes, sizes)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes x and y, by binary search."""
        low, high = np.zeros(len(x), np.int64), np.minimum(self.lengths[x], self.lengths[y])
        xs, ys = self.starts[x], self.starts[y]
        for _ in range(int(high.max(initial=0)).bit_length()):
            middle = (low + high + 1) >> 1
            equal = self.hashes.of(xs, xs + middle) == self.hashes.of(ys, ys + middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        length = self.common(x, y)
        x_ends, y_ends = length >= self.lengths[x], length >= self.lengths[y]
        last = len(self.codes) - 1
        by_code = self.codes[np.minimum(self.starts[x] + length, last)] < self.codes[np.minimum(self.starts[y] + length, last)]
        return np.where(y_ends, False, np.where(x_ends, True, by_code))

    def order(self) -> np.ndarray:
        """Suffix numbers, sorted within each group: runs of 1, 2, 4 ... are merged, all pairs of runs at a time."""
        order = np.arange(len(self.starts))
        inside = order - self.first
        width = 1
        while width < self.size.max(initial=0):
            block = inside // (2 * width) * (2 * width)
            left = inside - block < width
            low = self.first + block + np.where(left, width, 0)
            high = np.minimum(low + width, self.first + self.size)
            moving = np.flatnonzero((low < high) & (block + width < self.size))
            begin, low, high = low[moving], low[moving], high[moving]
            mine, is_left = order[moving], left[moving]
            # How many of the other run come before: strictly less for the left run, less or equal for the right one.
            for _ in range(width.bit_length()):
                middle = (low + high) >> 1
                open_ = low < high
                other = order[np.minimum(middle, len(order) - 1)]
                before = np.where(is_left, self.less(other, mine), ~self.less(mine, other))
                low = np.where(open_ & before, middle + 1, low)
                high = np.where(open_ & ~before, middle, high)
            target = self.first[moving] + block[moving] + (inside[moving] - block[moving]) % width + (low - begin)
            order[target] = mine
            width *= 2
        return order

    def nearest(self) -> tuple[np.ndarray, np.ndarray]:
        """For each suffix the longest common extension with another of its group, and with which one; verified."""
        order = self.order()
        one, two = order[:-1], order[1:]
        shared = np.where(self.first[one] == self.first[two], self.common(one, two), 0) if len(order) > 1 else np.zeros(0, np.int64)
        shared = self._verified(one, two, shared)
        best, partner = np.zeros(len(order), np.int64), np.arange(len(order))
        best[two], partner[two] = shared, one
        better = shared > best[one]
        best[one[better]], partner[one[better]] = shared[better], two[better]
        return best, partner

    def _verified(self, x: np.ndarray, y: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The extension cut at the first byte that differs, if equal hashes should have hidden one."""
        out = length.copy()
        last = len(self.codes) - 1
        for j in range(int(length.max(initial=0))):
            at = np.flatnonzero(j < out)
            differ = self.codes[np.minimum(self.starts[x[at]] + j, last)] != self.codes[np.minimum(self.starts[y[at]] + j, last)]
            if differ.any():
                out[at[differ]] = j
        return out


def _places(lengths: np.ndarray) -> np.ndarray:
    """The place of each byte in its own string, of strings one behind the other, and 0 for the end of all."""
    out = np.ones(int(lengths.sum()) + 1, np.int32)
    filled = lengths[lengths > 0]
    out[0] = 0
    out[np.cumsum(filled)] = 1 - filled
    return np.cumsum(out, out=out)


def covered_offsets(
    bodies: list[bytes], reach: np.ndarray, width: np.ndarray, sizes: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest offset of the anchor in a repeated string, of each neighbourhood (1 and 0: no repeat).

    ``reach``: bytes before the anchor; ``width``: strings less one; ``sizes``: lengths of the groups of one anchor.
    """
    codes = np.frombuffer(b"".join(bodies), np.uint8)
    lengths = np.array([len(b) for b in bodies], np.int64)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    anchors = begins + reach
    total = len(codes)
    right = SuffixSorter(codes, anchors, ends, sizes, _places(lengths))
    left = SuffixSorter(codes[::-1], total - anchors, total - begins, sizes, _places(lengths[::-1]))
    most_right, by_right = right.nearest()
    most_left, by_left = left.nearest()
    everyone = np.arange(len(bodies))
    low, high = length - most_right, most_left
    possible = low <= high
    attained = (left.common(everyone, by_right) >= low) & (right.common(everyone, by_left) >= length - high)
    unclear = possible & ~attained
    low, high = np.where(possible, low, 1), np.where(possible, high, 0)
    group = np.repeat(np.arange(len(sizes)), sizes)
    open_groups = np.unique(group[unclear])
    if len(open_groups):
        members = np.flatnonzero(np.isin(group, open_groups))
        exact_low, exact_high = _by_strings(right.hashes, begins[members], reach[members], width[members], group[members], length)
        low[members], high[members] = exact_low, exact_high
    return low, high


def _by_strings(
    hashes: PrefixHashes, begins: np.ndarray, reach: np.ndarray, width: np.ndarray, group: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """The same offsets from all strings of the neighbourhoods. Equal strings have their anchor at equal offsets, so some offsets are
    taken at a time."""
    least, most = np.full(len(begins), np.iinfo(np.int64).max), np.full(len(begins), -1)
    step = max(1, COMPARED_TOGETHER // len(begins))
    for offset in range(int((reach - width).min()), int(reach.max()) + 1, step):
        first = np.maximum(reach - width, offset)
        counts = np.maximum(np.minimum(reach, offset + step - 1) - first + 1, 0)
        owner = np.repeat(np.arange(len(begins)), counts)
        offsets = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = begins[owner] + reach[owner] - offsets
        digest = mix(hashes.of(starts, starts + length) ^ mix(group[owner].astype(np.uint64), 65), 66)
        _, inverse, times = np.unique(digest, return_inverse=True, return_counts=True)
        repeated = times[inverse] > 1
        np.minimum.at(least, owner[repeated], offsets[repeated])
        np.maximum.at(most, owner[repeated], offsets[repeated])
    return np.where(most < 0, 1, least), np.where(most < 0, 0, most)


def _sorted_batches(length: int) -> Callable:
    """Rows of NEIGHBOURS sorted by anchor, a partition at a time: the covered offsets of each."""

    def solved(rows: list[dict]) -> pa.RecordBatch:
        a = np.array([r["a"] for r in rows], np.int64)
        edge = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1], [True]]))
        reach, width = (np.array([r[c] for r in rows], np.int64) for c in ("reach", "width"))
        low, high = covered_offsets([r["body"] for r in rows], reach, width, np.diff(edge), length)
        whole = np.array([r["copies"] for r in rows]) > 1
        low, high = np.where(whole, reach - width, low), np.where(whole, reach, high)
        hit = low <= high
        n = np.array([r["n"] for r in rows], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(a[hit]), pa.array(n[hit]), pa.array(low[hit].astype(np.int32)), pa.array(high[hit].astype(np.int32))],
            names=["a", "n", "least", "most"],
        )

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            rows = batch.to_pylist()
            held += rows
            size += sum(len(r["body"]) for r in rows)
            if size >= SORTED_TOGETHER:
                last = held[-1]["a"]
                cut = next((i for i in range(len(held), 0, -1) if held[i - 1]["a"] != last), 0)
                if cut:
                    yield solved(held[:cut])
                    held = held[cut:]
                    size = sum(len(r["body"]) for r in held)
        if held:
            yield solved(held)

    return offsets


def _string_batches(length: int) -> Callable:
    """Every string of the neighbourhoods as a row: two hashes and the anchor's offset."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = np.frombuffer(row["body"], np.uint8)
                starts = np.arange(row["width"] + 1)
                h1, h2 = (mix(PrefixHashes(codes, s).of(starts, starts + length), s).view(np.int64) for s in (61, 67))
                size = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(size, row["a"])),
                        pa.array(np.full(size, row["n"])),
                        pa.array((row["reach"] - starts).astype(np.int32)),
                        pa.array(h1),
                        pa.array(h2),
                    ],
                    names=["a", "n", "offset", "h1", "h2"],
                )

    return strings


def _mixed_offsets(docs: DataFrame, mixed: DataFrame, length: int, group: int) -> DataFrame:
    """a, n, least and most offset of a repeated string, for the neighbourhoods that have any."""
    place = F.min(F.struct("doc_id", "key", "low", "high", "at")).alias("place")
    distinct = settle(mixed.groupBy("a", "n").agg(F.count("*").alias("copies"), place), "neighbourhoods")
    sizes = settle(distinct.groupBy(F.col("a").alias("of")).agg(F.count("*").alias("size")), "anchor-sizes")
    sized = distinct.join(sizes, F.col("a") == F.col("of"))
    wanted = F.struct("a", "n", "copies", "size", "place.low", "place.high", "place.at")
    by_text = sized.groupBy(F.col("place.doc_id").alias("want_id"), F.col("place.key").alias("want_key")).agg(
        F.collect_list(wanted).alias("wanted")
    )
    texts = docs.select(F.col("doc_id").cast("long"), text_key().alias("key"), F.col("text").cast("string"))
    rows = texts.join(by_text, same(F.col("doc_id"), F.col("want_id")) & (F.col("key") == F.col("want_key")))
    # Rows that repeat in full bring the same neighbourhoods again.
    bodies = rows.select("text", "wanted").mapInArrow(_body_batches(length), NEIGHBOURS)
    bodies = settle(bodies.groupBy("a", "n").agg(*[F.first(c).alias(c) for c in FETCHED]), "bodies")
    few = bodies.where(F.col("size") <= group).repartition("a").sortWithinPartitions("a")
    found = few.mapInArrow(_sorted_batches(length), "a long, n long, least int, most int")
    many = bodies.where(F.col("size") > group)
    if many.isEmpty():
        return found
    strings = many.mapInArrow(_string_batches(length), "a long, n long, offset int, h1 long, h2 long")
    times = strings.groupBy(F.col("h1").alias("g1"), F.col("h2").alias("g2")).count().where("count > 1")
    hits = strings.join(times, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")))
    whole = many.where("copies > 1").select(
        "a", "n", (F.col("reach") - F.col("width")).alias("least"), F.col("reach").alias("most")
    )
    hits = hits.groupBy("a", "n").agg(F.min("offset").alias("least"), F.max("offset").alias("most"))
    both = hits.unionByName(whole).groupBy("a", "n").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    return found.unionByName(both)


def repeated_strings(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, group: int = GROUP) -> DataFrame:
    """span_id, span_key and the spans covered by repeated strings, one row per text that has any."""
    texts = docs.select(F.col("doc_id").cast("long"), text_key().alias("key"), F.col("text").cast("string"))
    anchors = texts.mapInArrow(_anchor_batches(length, anchor), ANCHORS)
    spread = anchors.groupBy(F.col("a").alias("of")).agg(
        F.count("*").alias("c"), F.min("n").alias("n1"), F.max("n").alias("n2")
    )
    spread = spread.where("c > 1").select("of", (F.col("n1") == F.col("n2")).alias("whole"))
    # Written, so that both sides of the join are plain shuffles, of which Spark splits a hot anchor's partition.
    spread = settle(spread, "anchors-shared")
    marks = settle(anchors.join(spread, F.col("a") == F.col("of")).drop("of"), "anchors")
    mixed = marks.where(~F.col("whole"))
    offsets = settle(_mixed_offsets(docs, mixed, length, group), "offsets").withColumnsRenamed({"a": "b", "n": "m"})
    partly = mixed.join(offsets, (F.col("a") == F.col("b")) & (F.col("n") == F.col("m")))
    spans = partly.select(
        "doc_id", "key", (F.col("at") - F.col("most")).alias("start"), (F.col("at") - F.col("least") + length).alias("stop")
    ).unionByName(
        marks.where("whole").select("doc_id", "key", F.col("low").alias("start"), (F.col("high") + length).alias("stop"))
    )
    return spans.groupBy(F.col("doc_id").alias("span_id"), F.col("key").alias("span_key")).agg(
        F.collect_set(F.struct("start", "stop")).alias("spans")
    )


def cut_repeated_strings(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, group: int = GROUP, keep: bool = False
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes with ``keep``) of every row."""
    return cut_spans(docs, settle(repeated_strings(docs, length, anchor, group), "string-spans"), keep=keep)

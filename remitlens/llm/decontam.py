"""Benchmark decontamination: passages of test items in documents, found with a bounded number of edits.

An item of m letters may differ in e = floor(m * error_rate) edits. It is split into e + 1 pieces; of any copy with
at most e edits at least one piece is left unchanged. One automaton over the pieces of a block of items finds all exact hits
in a text; hits of one item on neighbouring diagonals are one place, and Myers' bit-parallel algorithm gives the least
edit distance of the item to any substring there. Texts and items are compared in lower case with runs of characters
other than letters and digits as one blank.

Items are sent to the workers in blocks of a bounded number of bytes, each against all documents; texts are never
shuffled. NULL or empty texts contain nothing, and an item without letters or digits is found nowhere. Equal items are
found each for itself; repeated documents give repeated rows. Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import pieces_for

ERROR_RATE = 0.05
#: Bytes of item text that are sent to the workers at a time.
BLOCK_BYTES = 16 << 20

HITS = "item_id:long,distance:int,places:int"


def _kept_byte(code: int) -> int:
    return code if code >= 128 or chr(code).isalnum() else 32


#: ASCII other than letters and digits becomes a blank.
_BLANKED = bytes(map(_kept_byte, range(256)))


def plain(text: str | None) -> bytes:
    """Lower case, with one blank for each run of other characters than letters and digits (beyond ASCII all stay)."""
    return b" ".join((text or "").lower().encode().translate(_BLANKED).split())


def pieces(pattern: bytes, errors: int) -> list[tuple[int, bytes]]:
    """``errors`` + 1 pieces of nearly equal length, with their offsets."""
    edges = [i * len(pattern) // (errors + 1) for i in range(errors + 2)]
    return [(a, pattern[a:b]) for a, b in zip(edges, edges[1:], strict=False) if b > a]


class Pattern:
    """Edit distance of a pattern to the substrings of a text, all pattern positions in one machine word of any length."""

    def __init__(self, pattern: bytes):
        self.length = len(pattern)
        self.places = [0] * 256
        for i, code in enumerate(pattern):
            self.places[code] |= 1 << i

    def least_distance(self, text: bytes, limit: int) -> int | None:
        """The least distance to any substring of ``text``, or None if it exceeds ``limit``."""
        top = 1 << (self.length - 1)
        everything = (top << 1) - 1
        rises, falls, score, least = everything, 0, self.length, self.length
        for code in text:
            equal = self.places[code]
            vertical = equal | falls
            diagonal = (((equal & rises) + rises) ^ rises) | equal
            up = falls | ~(diagonal | rises) & everything
            down = rises & diagonal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
                least = min(least, score)
            # A substring may begin anywhere, so nothing is carried in from above the first row.
            up = (up << 1) & everything
            down = (down << 1) & everything
            rises = down | ~(vertical | up) & everything
            falls = up & vertical
        return least if least <= limit else None


class ItemFinder:
    """The items of a block: (item_id, plain text)."""

    def __init__(self, items: list[tuple[int | None, bytes]], error_rate: float):
        import ahocorasick

        self.as_key = (lambda b: b.decode("latin-1")) if ahocorasick.unicode else (lambda b: b)
        self.items = items
        self.errors = [int(len(text) * error_rate) for _, text in items]
        self.patterns: dict[int, Pattern] = {}
        owners: dict[bytes, list[tuple[int, int]]] = {}
        for number, (_, text) in enumerate(items):
            for offset, piece in pieces(text, self.errors[number]):
                owners.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, found in owners.items():
            self.automaton.add_word(self.as_key(piece), (len(piece), found))
        if owners:
            self.automaton.make_automaton()

    def _places(self, text: bytes) -> dict[int, list[tuple[int, int]]]:
        """For each item, the disjoint ranges of diagonals with piece hits."""
        diagonals: dict[int, set[int]] = {}
        for end, (size, found) in self.automaton.iter(self.as_key(text)):
            for number, offset in found:
                diagonals.setdefault(number, set()).add(end - size + 1 - offset)
        ranges: dict[int, list[tuple[int, int]]] = {}
        for number, hits in diagonals.items():
            own: list[tuple[int, int]] = []
            for d in sorted(hits):
                if own and d - own[-1][1] <= 2 * self.errors[number] and d - own[-1][0] <= self.length_of(number):
                    own[-1] = (own[-1][0], d)
                else:
                    own.append((d, d))
            ranges[number] = own
        return ranges

    def length_of(self, number: int) -> int:
        return len(self.items[number][1])

    def find(self, text: bytes) -> list[dict]:
        if not len(self.automaton) or not text:
            return []
        out = []
        for number, ranges in sorted(self._places(text).items()):
            item_id, pattern = self.items[number]
            errors = self.errors[number]
            if number not in self.patterns:
                self.patterns[number] = Pattern(pattern)
            distances = []
            for low, high in ranges:
                region = text[max(0, low - errors) : high + len(pattern) + errors]
                if pattern in region:
                    distances.append(0)
                elif errors and (found := self.patterns[number].least_distance(region, errors)) is not None:
                    distances.append(found)
            if distances:
                out.append({"item_id": item_id, "distance": min(distances), "places": len(distances)})
        return out


def _item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, bytes]]]:
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where(F.length("text") > 0)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = pieces_for(size, block_bytes // 2)
    for number in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number) if blocks > 1 else rows
        found = [(item_id, plain(text)) for item_id, text in own.collect()]
        yield sorted((x for x in found if x[1]), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


def _hits(docs: DataFrame, block: list, error_rate: float) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = ItemFinder(block, error_rate)
        for batch in batches:
            ids, hits = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = finder.find(plain(text))
                ids += [doc_id] * len(own)
                hits += own
            columns = [pa.array(ids, pa.int64())]
            columns += [pa.array([h[k] for h in hits], t) for k, t in (("item_id", pa.int64()), ("distance", pa.int32()), ("places", pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "distance", "places"])

    return docs.mapInArrow(found, "doc_id long, item_id long, distance int, places int")


def contaminations(
    docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, item_id, distance (of the closest copy) and places (disjoint copies) of every item found in a document."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for block in _item_blocks(items, block_bytes):
        found = _hits(rows, block, error_rate)
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(
    docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text contains no item."""

    def clean(block: list, frame: DataFrame) -> DataFrame:
        def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = ItemFinder(block, error_rate)
            for batch in batches:
                yield batch.filter(pa.array([not finder.find(plain(t)) for t in batch.column("text").to_pylist()], pa.bool_()))

        return frame.mapInArrow(kept, frame.schema)

    for block in _item_blocks(items, block_bytes):
        docs = clean(block, docs)
    return docs

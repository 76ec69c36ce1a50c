"""SentencePiece encoding with the N best segmentations, and decoding.

The lattice of a text has an edge for every piece of the vocabulary and, for characters outside it, a chain of byte pieces.
Forward Viterbi gives the best score of every prefix; those scores are the exact heuristic of an A-star search from the
end, which finishes segmentations in falling order of their scores. No piece crosses from another character to
a blank, or between signs and letters, so a text falls apart into units (blanks and the word or the signs behind them) and
its N best segmentations are the N best combinations of its units' ones. Workers remember units.

The text gets a blank in front, as the model's normaliser does, and keeps all its blanks; decoding takes that blank off. A
character that the vocabulary writes blanks with is encoded by its bytes, so every text comes back unchanged. NULL and
empty texts have no pieces, score 0, no second segmentation, and decode to the empty text. Equal scores are ordered by
the longer last pieces. Repeated rows are encoded alike; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import texts_of

#: Fixed value: the character that stands for a blank in vocabularies.
BLANK_MARK = "▁"
#: Scores from here down mark pieces that are never merged; they count as the worst other score less one.
NEVER_MERGED = -1e6
#: A byte piece scores this much below the worst other piece.
BYTE_PENALTY = 10.0
#: Units that a worker remembers during a task, and from one task to the next (some 90 MB).
REMEMBERED, KEPT = 600_000, 300_000
_LETTER = re.compile(r"[^\W\d_]")

ENCODED = (
    "doc_id long, ids binary, n_pieces long, score double, text_sha256 string, "
    "alternatives array<struct<score:double,ids:binary>>"
)
ID = np.dtype("<u4")


class PieceModel:
    """Pieces and scores of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.byte_ids = [-1] * 256
        self.output = [b""] * model.vocab_size()
        for i in range(model.vocab_size()):
            if model.is_byte(i):
                code = int(model.id_to_piece(i)[3:5], 16)
                self.byte_ids[code], self.output[i] = i, bytes([code])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = model.id_to_piece(i).replace(BLANK_MARK, " ")
                self.pieces[text] = (i, model.get_score(i))
                self.output[i] = text.encode()
        if min(self.byte_ids) < 0:
            raise ValueError("the vocabulary has no byte pieces")
        # Vocabularies score pieces that they never merge far below all others.
        worst = min(score for _, score in self.pieces.values() if score > NEVER_MERGED)
        self.pieces = {text: (i, max(score, worst - 1)) for text, (i, score) in self.pieces.items()}
        self.byte_score = worst - BYTE_PENALTY
        self.longest = max(map(len, self.pieces))
        if any(re.search("[^ ] ", piece) for piece in self.pieces):
            raise ValueError("a piece crosses from a character to a blank")
        self.root: dict = {}
        self.units = self._unit_pattern()
        self.known: dict[str, tuple[bytes, float, float]] = {}
        self.older: dict[str, tuple[bytes, float, float]] = {}

    def _tree(self) -> dict:
        """The pieces as a tree of letters; a node that ends a piece has its score and id under the empty letter."""
        root: dict = {}
        for text, (i, score) in self.pieces.items():
            node = root
            for letter in text:
                node = node.setdefault(letter, {})
            node[""] = (score, (i,))
        return root

    def _unit_pattern(self) -> re.Pattern:
        """Units end where no piece of this vocabulary goes on: before blanks, and between letters and other characters.

        Characters that stand next to a letter in some piece count as letters, and so on.
        """
        pairs = [p for piece in self.pieces for p in zip(piece, piece[1:], strict=False) if p[0] != " "]
        used = {c for piece in self.pieces for c in piece}
        like_letters = {c for c in used if c.isalpha()}
        while more := {c for a, b in pairs if (a in like_letters) != (b in like_letters) for c in (a, b)} - like_letters:
            like_letters |= more
        added = "".join(sorted(c for c in like_letters if not _LETTER.match(c)))
        barred = "".join(sorted(c for c in used - like_letters if _LETTER.match(c)))
        letter = r"[^\W\d_" + re.escape(barred) + "]"
        letter = f"(?:{letter}|[{re.escape(added)}])" if added else letter
        return re.compile(f" *{letter}+| *(?:(?!{letter})[^ ])+| +")

    def lattice(self, unit: str) -> tuple[list[list[tuple[int, float, tuple[int, ...]]]], list[float]]:
        """Edges (start, score, ids) by their end, and the best score of every prefix."""
        if not self.root:
            self.root = self._tree()
        size, longest, root = len(unit), self.longest, self.root
        ending: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
        best = [0.0] + [-1e30] * size
        for i in range(size):
            base, node, j = best[i], root, i
            for letter in unit[i : i + longest]:
                node = node.get(letter)
                if node is None:
                    break
                j += 1
                found = node.get("")
                if found is not None:
                    score = found[0]
                    ending[j].append((i, score, found[1]))
                    if base + score > best[j]:
                        best[j] = base + score
            if unit[i] not in self.pieces:
                codes = unit[i].encode()
                score = self.byte_score * len(codes)
                ending[i + 1].append((i, score, tuple(self.byte_ids[c] for c in codes)))
                best[i + 1] = max(best[i + 1], base + score)
        return ending, best

    def nbest(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a unit: (score, ids)."""
        ending, best = self.lattice(unit)
        push, pop = heapq.heappush, heapq.heappop
        # Heap entries: -(best prefix + suffix), order of entry, position, suffix score, suffix as a linked list. Of equal
        # entries the latest goes first, so that one of many tied segmentations is finished before others are begun.
        heap = [(-best[-1], 0, len(unit), 0.0, None)]
        entered, out = 0, []
        while heap and len(out) < n:
            _, _, at, behind, suffix = pop(heap)
            if at == 0:
                ids: list[int] = []
                while suffix is not None:
                    ids += suffix[0]
                    suffix = suffix[1]
                out.append((behind, tuple(ids)))
                continue
            for start, score, piece in reversed(ending[at]):
                entered -= 1
                total = score + behind
                push(heap, (-(best[start] + total), entered, start, total, (piece, suffix)))
        return out

    def unit(self, text: str) -> tuple[bytes, float, float]:
        """Best ids, their score, and by how much the second segmentation is worse (infinite if there is none)."""
        found = self.nbest(text, 2)
        gap = found[0][0] - found[1][0] if len(found) > 1 else float("inf")
        return struct.pack(f"<{len(found[0][1])}I", *found[0][1]), found[0][0], gap

    def encode(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """The n best segmentations of a text: (score, ids)."""
        if not text:
            return []
        units = self.units.findall(" " + text)
        if len(self.known) > REMEMBERED // 2:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        rows = list(map(known.get, units))
        if None in rows:
            for i, row in enumerate(rows):
                if row is None:
                    unit = units[i]
                    row = known.get(unit) or older.get(unit) or self.unit(unit)
                    rows[i] = known[unit] = row
        ids, scores, gaps = zip(*rows, strict=True)
        score = sum(scores)
        out = [(score, b"".join(ids))]
        if n > 1:
            out += self._runners_up(units, ids, gaps, score, n)
        return out

    def _runners_up(self, units: list[str], ids: tuple, gaps: tuple, score: float, n: int) -> list[tuple[float, bytes]]:
        """The other n - 1 segmentations: only the n - 1 units whose second segmentation costs least can differ."""
        open_units = [i for i in heapq.nsmallest(n - 1, range(len(gaps)), key=gaps.__getitem__) if gaps[i] != float("inf")]
        choices = [self.nbest(units[i], n) for i in open_units]
        heap = [(0.0, (0,) * len(choices))]
        seen, out = {heap[0][1]}, []
        while heap and len(out) < n:
            cost, chosen = heapq.heappop(heap)
            out.append((cost, chosen))
            for k in range(len(chosen)):
                nxt = (*chosen[:k], chosen[k] + 1, *chosen[k + 1 :])
                if nxt[k] < len(choices[k]) and nxt not in seen:
                    seen.add(nxt)
                    heapq.heappush(heap, (sum(c[0][0] - c[j][0] for c, j in zip(choices, nxt, strict=True)), nxt))
        result = []
        for cost, chosen in out[1:]:
            own = list(ids)
            for i, options, j in zip(open_units, choices, chosen, strict=True):
                own[i] = np.array(options[j][1], ID).tobytes()
            result.append((score - cost, b"".join(own)))
        return result

    def forget(self) -> None:
        """Free what was remembered beyond ``KEPT`` units; a worker calls it after each task, as it may serve other operators next. The
        units that came first are kept: common ones come early."""
        self.known = dict(itertools.islice(self.known.items(), KEPT))
        self.older = dict(itertools.islice(self.older.items(), KEPT - len(self.known)))

    def decode(self, ids: bytes) -> bytes:
        text = b"".join(map(self.output.__getitem__, np.frombuffer(ids, ID).tolist()))
        return text[1:] if text[:1] == b" " else text


_MODELS: dict[str, PieceModel] = {}


def _model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _segmented(
    batches: Iterator[pa.RecordBatch], path: str, n_best: int
) -> Iterator[tuple[pa.RecordBatch, list[tuple[bytes, list[tuple[float, bytes]]]]]]:
    """Each batch with the bytes and the n best segmentations of its texts."""
    pieces = _model(path)
    try:
        for batch in batches:
            texts = [data or b"" for data in texts_of(batch)]
            yield batch, [(data, pieces.encode(data.decode(), n_best) or [(0.0, b"")]) for data in texts]
    finally:
        pieces.forget()


def encode(docs: DataFrame, model: str, n_best: int = 2) -> DataFrame:
    """doc_id, ids (little-endian 32-bit) of the best segmentation, their number and score, the text's digest, and the
    following segmentations. ``model``: the vocabulary file, on every machine."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.binary())]))
        for batch, rows in _segmented(batches, model, n_best):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([f[0][1] for _, f in rows], pa.binary()),
                    pa.array([len(f[0][1]) // ID.itemsize for _, f in rows], pa.int64()),
                    pa.array([f[0][0] for _, f in rows], pa.float64()),
                    pa.array([hashlib.sha256(data).hexdigest() for data, _ in rows], pa.string()),
                    pa.array([[{"score": s, "ids": i} for s, i in f[1:]] for _, f in rows], kind),
                ],
                names=["doc_id", "ids", "n_pieces", "score", "text_sha256", "alternatives"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(encoded, ENCODED)


def decode(rows: DataFrame, model: str) -> DataFrame:
    """doc_id and text of encoded rows (doc_id, ids)."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(model)
        for batch in batches:
            texts = [pieces.decode(ids or b"").decode() for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, text string")


def checked(docs: DataFrame, model: str, n_best: int = 2) -> DataFrame:
    """Encoded documents with the digests of their ids and of the text that the ids decode to.

    Columns: doc_id, n_pieces, score, second_score (NULL if there is no second segmentation), ids_sha256, text_sha256,
    decoded_sha256, round_trip.
    """

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(model)
        for batch, rows in _segmented(batches, model, n_best):
            ids = [f[0][1] for _, f in rows]
            texts = [hashlib.sha256(data).hexdigest() for data, _ in rows]
            decoded = [hashlib.sha256(pieces.decode(x)).hexdigest() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(x) // ID.itemsize for x in ids], pa.int64()),
                    pa.array([f[0][0] for _, f in rows], pa.float64()),
                    pa.array([f[1][0] if len(f) > 1 else None for _, f in rows], pa.float64()),
                    pa.array(texts, pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array(decoded, pa.string()),
                ],
                names=["doc_id", "n_pieces", "score", "second_score", "text_sha256", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        compared,
        "doc_id long, n_pieces long, score double, second_score double, text_sha256 string, "
        "ids_sha256 string, decoded_sha256 string",
    )
    return rows.withColumn("round_trip", F.col("text_sha256") == F.col("decoded_sha256"))

"""Token ids in files of their own format, with a minimal perfect hash for keyed access.

A token file is a table with one row per segment, written by Spark (so it works on any storage and a repeated task
leaves no second copy). A segment holds a bounded number of ids of consecutive documents:

    part, segment   its place; segments in this order hold ascending doc_ids
    inside    ids of the part before the segment
    first_key, last_key   the smallest and largest doc_id (the directory of keyed access)
    n_docs, n_ids
    keys      doc_id, occurrence (0 unless a doc_id repeats) and a NULL mark, as little-endian 64-bit integers
    hash      minimal perfect hash of the keys
    slots     for each slot of the hash: fingerprint of the key, offset and length in ids (little-endian 64-bit)
    width     bytes of an id (2 if the vocabulary allows it, else 4)
    payload   the raw ids, little-endian

Every document ends with the end id. NULL text is empty: the end id alone. NULL doc_ids come first; rows that share a
doc_id follow one another in the order of their texts and are told apart by their occurrence. Other columns are
ignored; an empty table gives an empty file and result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from remitlens.llm.common import mix, pieces_for
from remitlens.llm.mph import PerfectHash
from remitlens.session import scratch_path

#: Ids of a segment; a document is never divided.
SEGMENT_IDS = 1 << 20
#: Bytes of text of a part of the file.
PART_BYTES = 16 << 20
#: Encoded pieces that a worker remembers, and that the library gets as one text.
REMEMBERED = 1_200_000
JOINED = 2_000
#: Pieces are remembered up to this many bytes.
LONGEST = 64
#: Fixed value: how byte-level vocabularies write the space.
SPACE_LETTER = "\u0120"
#: The bases of so many parts of a file are sent to every worker; beyond that they are joined.
BASES_SENT = 1_000_000

FILE_SCHEMA = (
    "part int, segment int, inside long, first_key long, last_key long, n_docs long, n_ids long, "
    "keys binary, hash binary, slots binary, width int, payload binary"
)


_BYTES = np.arange(256)
_IS_LETTER = ((_BYTES | 32) >= ord("a")) & ((_BYTES | 32) <= ord("z")) & (_BYTES < 128)
_IS_REST = (_BYTES < 128) & ~_IS_LETTER
_IS_SEEN = (_BYTES > 32) & (_BYTES < 127)


def _cuts(data: np.ndarray, letters: bool) -> np.ndarray:
    """Whether UTF-8 may be cut before each byte but the first: before a space behind a character other than white space, and, with
    ``letters``, before any ASCII character but a letter behind an ASCII letter or one from U+00C0 to U+024F."""
    here, before = data[1:], data[:-1]
    rest = _IS_REST[here] if letters else here == 32
    cut = rest & _IS_LETTER[before] | (here == 32) & _IS_SEEN[before]
    # Behind a character of several bytes; at least two, of which the last is before the cut.
    at = np.flatnonzero(rest & (before >= 128))
    last, second, third = data[at], data[at - 1], data[np.maximum(at - 2, 0)]
    latin = (second >= 0xC3) & (second <= 0xC9) & ~((second == 0xC3) & ((last == 0x97) | (last == 0xB7)))
    latin &= (second < 0xC9) | (last <= 0x8F)
    white = (second == 0xC2) & ((last == 0x85) | (last == 0xA0)) | (third == 0xE2) & ((second == 0x80) | (second == 0x81))
    white |= (third == 0xE3) & (second == 0x80) & (last == 0x80) | (third == 0xE1) & ((second == 0x9A) | (second == 0xA0))
    cut[at] = latin | ~white & (here[at] == 32)
    return cut


class WordEncoder:
    """Encodes texts with a byte-level BPE of the tokenizers library, each distinct piece once.

    The tokenizer cuts a text before any space that follows a character other than white space, whatever comes next. With the pattern
    of GPT-2, letters also end where another character follows. So a text may be cut there, and its pieces encoded apart: "One, two"
    is "One", "," and " two". Texts that contain an added token such as <|endoftext|> go to the library whole.
    Each distinct piece of a batch is looked up once. New pieces with one space, which they start with, go to the library many at a
    time, as one text; the ids of a piece are those from one that starts with the space to the next.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        cutter = self.tokenizer.pre_tokenizer
        self.letters = isinstance(cutter, pre_tokenizers.ByteLevel) and cutter.use_regex and not self.tokenizer.normalizer
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.starts = np.array([(self.tokenizer.id_to_token(i) or "").startswith(SPACE_LETTER) for i in range(size)])
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values() if token.content]
        # An added token may also be looked for in the normalized text.
        self.normalize = self.tokenizer.normalizer.normalize_str if self.added and self.tokenizer.normalizer else None

    def _has_added(self, text: str) -> bool:
        if any(content in text for content in self.added):
            return True
        if self.normalize is None:
            return False
        normal = self.normalize(text)
        return any(content in normal or self.normalize(content) in normal for content in self.added)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [np.array(e.ids, self.dtype) for e in encode(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of new pieces; short ones are remembered."""
        texts = [piece.decode() for piece in pieces]
        one_space = [text[0] == " " and " " not in text[1:] and not text[-1].isspace() for text in texts]
        numbers = [i for i, one in enumerate(one_space) if one]
        groups = [numbers[i : i + JOINED] for i in range(0, len(numbers), JOINED)]
        out = [b""] * len(pieces)
        for group, ids in zip(groups, self._library(["".join([texts[i] for i in group]) for group in groups]), strict=True):
            edges = np.append(np.flatnonzero(self.starts[ids]), len(ids)) * self.dtype.itemsize
            data, edges = ids.tobytes(), edges.tolist()
            if len(edges) != len(group) + 1:
                raise ValueError("the tokenizer does not start each word with its space")
            for i, a, b in zip(group, edges, edges[1:], strict=False):
                out[i] = data[a:b]
        alone = [i for i, one in enumerate(one_space) if not one]
        for i, ids in zip(alone, self._library([texts[i] for i in alone]), strict=True):
            out[i] = ids.tobytes()
        self.known.update((piece, ids) for piece, ids in zip(pieces, out, strict=True) if len(piece) <= LONGEST)
        return out

    def _ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pieces."""
        if len(self.known) > REMEMBERED // 2:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        out = list(map(known.get, pieces))
        fresh = []
        for i in [i for i, ids in enumerate(out) if ids is None] if None in out else ():
            piece = pieces[i]
            ids = older.get(piece)
            if ids is None:
                fresh.append(i)
            else:
                out[i] = known[piece] = ids
        for i, ids in zip(fresh, self._learn([pieces[i] for i in fresh]), strict=True):
            out[i] = ids
        return out

    def _cut(self, texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The distinct pieces of all texts, the number of each text's pieces in order, and where the texts begin and end in these."""
        array = pa.array(texts, pa.string())
        _, offsets, buffer = array.buffers()
        edges = np.frombuffer(offsets, np.int32)[: len(texts) + 1]
        size = int(edges[-1])
        if not size:
            return [], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        marks = np.zeros(size + 1, bool)
        marks[1:-1] = _cuts(np.frombuffer(buffer, np.uint8)[:size], self.letters)
        marks[edges] = True
        bounds = np.flatnonzero(marks).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), buffer]).dictionary_encode()
        _, offsets, buffer = coded.dictionary.buffers()
        ends, data = np.frombuffer(offsets, np.int32)[: len(coded.dictionary) + 1].tolist(), buffer.to_pybytes()
        pieces = [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        return pieces, coded.indices.to_numpy(), np.searchsorted(bounds, edges)

    def encode(self, texts: list[str]) -> list[bytes]:
        apart = [number for number, text in enumerate(texts) if self._has_added(text)]
        whole = dict(zip(apart, self._library([texts[number] for number in apart]), strict=True))
        pieces, numbers, edges = self._cut(["" if number in whole else text for number, text in enumerate(texts)])
        ids = self._ids_of(pieces)
        # The ids of each piece are copied to their places, all at once.
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        starts, taken = np.cumsum(lengths) - lengths, lengths[numbers]
        ends = np.cumsum(taken)
        at = np.repeat(starts[numbers] - (ends - taken), taken)
        at += np.arange(len(at))
        data = np.frombuffer(b"".join(ids), self.dtype)[at].tobytes()
        bounds = (np.append(0, ends)[edges] * self.dtype.itemsize).tolist()
        return [whole[i].tobytes() if i in whole else data[a:b] for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _hashable(keys: np.ndarray) -> np.ndarray:
    """(n, 3) keys as (n, 2) 64-bit numbers; the first is a bijection of doc_id."""
    keys = keys.astype("<i8").view("<u8").reshape(-1, 3)
    return np.stack([mix(keys[:, 0]), mix(keys[:, 1] * np.uint64(2) + keys[:, 2], 1)], axis=1)


def _fingerprints(hashed: np.ndarray) -> np.ndarray:
    return mix(hashed[:, 0] ^ mix(hashed[:, 1], 7), 8)


def _segment(part: int, number: int, inside: int, keys: list[tuple], ids: list[bytes], width: int) -> dict:
    array = np.array(keys, "<i8").reshape(-1, 3)
    lengths = np.array([len(x) // width for x in ids], np.int64)
    offsets = np.cumsum(lengths) - lengths
    hashed = _hashable(array)
    index = PerfectHash.build(hashed)
    slots = np.empty((len(keys), 3), "<u8")
    slots[index.slots(hashed)] = np.stack([_fingerprints(hashed), offsets.view("u8"), lengths.view("u8")], axis=1)
    named = [int(k[0]) for k in keys if not k[2]]
    return {
        "part": part,
        "segment": number,
        "inside": inside,
        "first_key": named[0] if named else None,
        "last_key": named[-1] if named else None,
        "n_docs": len(keys),
        "n_ids": int(lengths.sum()),
        "keys": array.tobytes(),
        "hash": index.to_bytes(),
        "slots": slots.tobytes(),
        "width": width,
        "payload": b"".join(ids),
    }


def _file_arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (field.split() for field in FILE_SCHEMA.split(", "))])


def _writer(path: str, end_id: int, segment_ids: int) -> Callable:
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, schema = TaskContext.get().partitionId(), 0, _file_arrow_schema()
        encoder = _encoder(path)
        width = encoder.dtype.itemsize
        end = np.array([end_id], encoder.dtype).tobytes()
        keys: list[tuple] = []
        ids: list[bytes] = []
        held = inside = 0
        last = None

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_segment(part, number, inside, keys, ids, width)], schema)

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            encoded = encoder.encode(texts)
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                key = (doc_id or 0, 0, int(doc_id is None))
                if last and (last[0], last[2]) == (key[0], key[2]):
                    key = (key[0], last[1] + 1, key[2])
                keys.append(key)
                ids.append(found + end)
                held, last = held + len(ids[-1]) // width, key
                if held >= segment_ids:
                    yield full()
                    keys, ids, held, number, inside = [], [], 0, number + 1, inside + held
        if keys:
            yield full()

    return segments


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, parts: int | None = None, segment_ids: int = SEGMENT_IDS
) -> None:
    """Encode the texts and write them in ascending doc_id order. ``tokenizer``: the file, on every machine."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if parts is None:
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        parts = pieces_for(size, PART_BYTES)
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    segments = ordered.mapInArrow(_writer(tokenizer, end_id, segment_ids), FILE_SCHEMA)
    segments.write.option("compression", "zstd").parquet(path)


def _read_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every key of a segment looked up through its perfect hash."""
    for batch in batches:
        for row in batch.to_pylist():
            keys = np.frombuffer(row["keys"], "<i8").reshape(-1, 3)
            offsets, lengths = locate(row, keys)
            ids = np.frombuffer(row["payload"], f"<u{row['width']}")
            sums = [zlib.crc32(ids[a : a + n].astype("<u4")) for a, n in zip(offsets.tolist(), lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[:, 0], mask=keys[:, 2] == 1),
                    pa.array(row["base"] + offsets),
                    pa.array(lengths),
                    pa.array(sums, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def locate(segment: dict, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offset and length (-1 where absent) of keys (doc_id, occurrence, NULL mark) in a segment, in constant time each."""
    hashed = _hashable(keys)
    slots = np.frombuffer(segment["slots"], "<u8").reshape(-1, 3)
    at = PerfectHash.from_bytes(segment["hash"]).slots(hashed)
    hit = at >= 0
    hit[hit] = slots[at[hit], 0] == _fingerprints(hashed[hit])
    offsets, lengths = np.full(len(keys), -1, np.int64), np.full(len(keys), -1, np.int64)
    offsets[hit], lengths[hit] = slots[at[hit], 1].view("i8"), slots[at[hit], 2].view("i8")
    return offsets, lengths


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document in the file."""
    file = _read_file(spark, path)
    # One row per part of the file: bytes of text / PART_BYTES.
    per_part = file.groupBy(F.col("part").alias("of")).agg(F.sum("n_ids").alias("ids"))
    earlier = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("of", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before"))
    if per_part.count() <= BASES_SENT:
        bases = F.broadcast(bases)
    rows = file.join(bases, F.col("part") == F.col("of")).withColumn("base", F.col("before") + F.col("inside"))
    rows = rows.select("base", "keys", "hash", "slots", "width", "payload")
    return rows.mapInArrow(_read_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _places(row: dict, doc_id: int, is_null: int) -> list[tuple[int, int]]:
    """Offset and length of every row of an id in a segment. Its rows are numbered, and those of a segment follow each other; each
    number is one look-up."""
    first = np.frombuffer(row["first"], "<i8")
    number = int(first[1]) if (first[0], first[2]) == (doc_id, is_null) else 0
    found, at_once = [], 4
    while True:
        keys = np.array([(doc_id, number + i, is_null) for i in range(at_once)], "<i8")
        offsets, lengths = locate(row, keys)
        hits = int(np.argmin(np.append(offsets >= 0, False)))
        found += zip(offsets[:hits].tolist(), lengths[:hits].tolist(), strict=True)
        if hits < at_once:
            return found
        number, at_once = number + at_once, min(at_once * 2, 4096)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["payload"], f"<u{row['width']}")
            asked = [(k, k, 0) for k in row["asked"]] + ([(None, 0, 1)] if row["with_null"] else [])
            found = [(name, ids[a : a + n].tolist()) for name, k, null in asked for a, n in _places(row, k, null)]
            yield pa.RecordBatch.from_pylist(
                [{"doc_id": k, "ids": v} for k, v in found],
                pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))]),
            )


def fetch(spark: SparkSession, path: str, doc_ids: list[int], with_null: bool = False) -> DataFrame:
    """The ids of all rows with some doc_ids, and of those without one if ``with_null``.

    The directory columns name the parts that can hold them, at most one per doc_id and the first for NULL; only row groups of these
    are read, and a segment's hash gives the offsets.
    """
    wanted = F.array(*[F.lit(int(k)) for k in sorted(set(doc_ids))]).cast("array<bigint>")
    inside = F.filter(wanted, lambda k: (k >= F.col("first_key")) & (k <= F.col("last_key")))
    file = _read_file(spark, path).withColumns({"asked": F.coalesce(inside, F.array().cast("array<bigint>")), "with_null": F.lit(with_null)})
    named = F.size("asked") > 0
    parts = [row[0] for row in file.where(named).select("part").distinct().collect()]
    if with_null:  # they sort first
        parts.append(file.agg(F.min("part")).first()[0])
        named = named | (F.col("part") == F.lit(parts[-1]))
    rows = file.where(F.col("part").isin([part for part in parts if part is not None])).where(named)
    columns = ("asked", "with_null", "hash", "slots", "width", "payload", F.substring("keys", 1, 24).alias("first"))
    return rows.select(*columns).mapInArrow(_fetch, "doc_id long, ids array<long>")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the files to the shared folder and read every document back from them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_token_files(docs, path, tokenizer, end_id)
    return read_documents(spark, path)

"""The text operators against plain versions, on hostile rows and on a supplied table."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import public_tokenizers
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from remitlens.llm import decontam, exact, language, lines, minhash, sentencepieces, sharding, substrings, suffixes, tokens
from remitlens.llm.common import prepare
from remitlens.llm.components import components
from remitlens.llm.mph import PerfectHash

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Names that the operators use inside.
CLASHING = (
    "row node n root bucket key digest shard slot spans span_id lang_pred score d1 d2 a b c h count kept runs doc of best place past "
    "locator start stop item_id text_key of_id run_id gone_id want_id"
).split()


def _phrase(rng, n):
    return " ".join("".join(rng.choice("aeioubcdst") for _ in range(rng.randint(2, 7))) for _ in range(n))


def _rows():
    rng = random.Random(7)
    shared, base = _phrase(rng, 70), _phrase(rng, 120).split()
    rows = [(i, "\n".join(_phrase(rng, rng.randint(3, 30)) for _ in range(rng.randint(1, 8)))) for i in range(20)]
    for i in range(20, 40):  # near copies
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = _phrase(rng, 1)
        rows.append((i, " ".join(words)))
    rows += [(i, f"{_phrase(rng, 40)}\n{shared}\n{_phrase(rng, 40)}") for i in range(40, 50)]
    rows += [(50, None), (51, ""), (52, " \n\t "), (None, "nobody has this"), (None, None), (53, "Thé ▁ café\n漢字 🙂")]
    rows += [(54, "x" * 5000), (55, "ab" * 3000), (56, rows[3][1]), (57, rows[3][1].replace(" ", "  "))]
    rows += [(58, (_phrase(rng, 50) + "\n") * 40), (59, _phrase(rng, 20_000)), (60, "one"), (61, "one"), (62, "ONE two")]
    rows += [(63, "\n".join(["a", "b", "c", "d"] * 5)), (64, "\n\n\n\n\n")]
    return rows


ROWS = _rows()
REPEATED = [*ROWS, ROWS[3], ROWS[3], (None, None), (4, "another text under the same id")]


def frame(spark, rows, extra=True):
    prepare(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return docs.select("*", *[F.lit("x").alias(c) for c in CLASHING]) if extra else docs


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def want(rows):
    return sorted(map(tuple, rows), key=repr)


SPAN_COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("rows", [ROWS, REPEATED], ids=["rows", "repeated"])
@pytest.mark.parametrize(("length", "anchor", "group"), [(200, 64, 20_000), (40, 16, 3)])
def test_suffix_dedup(spark, rows, length, anchor, group):
    found = suffixes.cut_repeated_strings(frame(spark, rows), length, anchor, group)
    assert got(found, *SPAN_COLUMNS) == want(plain.repeated_strings(rows, length))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40).map(lambda b: bytes(c % 2 + 97 for c in b)), min_size=1, max_size=12))
def test_suffix_order(texts):
    codes = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    half = len(texts) // 2
    sizes = np.array([n for n in (half, len(texts) - half) if n])
    sorter = suffixes.SuffixSorter(codes, ends - [len(t) for t in texts], ends, sizes)
    order = sorter.order().tolist()
    first = texts[:half]
    assert [texts[i] for i in order[:half]] == sorted(first)
    assert [texts[i] for i in order[half:]] == sorted(texts[half:])


def _neighbourhood_rows(groups, size, length=200):
    """Rows of the sorter, ``size`` neighbourhoods of each anchor that share some bytes on either side."""
    rng = random.Random(11)
    for a in range(groups):
        middle = rng.randbytes(64)
        left, right = rng.randbytes(136), rng.randbytes(136)
        for n in range(size):
            reach, behind = rng.randint(70, 136), rng.randint(70, 136)
            x, y = rng.randint(0, reach), rng.randint(0, behind)
            body = rng.randbytes(reach - x) + left[136 - x :] + middle + right[:y] + rng.randbytes(behind - y)
            yield {"a": a, "n": n, "copies": 1, "size": size, "reach": reach, "width": len(body) - length, "body": body}


@pytest.mark.parametrize(("groups", "size"), [(4_500, 8), (3, 3_000)])
def test_sorted_neighbourhoods_fit_a_worker(groups, size):
    """Bytes are held, not rows: a worker of a few hundred MB has room for whatever comes."""
    sort, rows = suffixes._sorted_batches(200), list(_neighbourhood_rows(groups, size))
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 500]) for i in range(0, len(rows), 500)]
    tracemalloc.start()
    try:
        found = [r for batch in sort(iter(batches)) for r in batch.to_pylist()]
        assert tracemalloc.get_traced_memory()[1] < 150e6
    finally:
        tracemalloc.stop()
    starts = [(r["a"], r["body"][i : i + 200], r["n"], r["reach"] - i) for r in rows for i in range(r["width"] + 1)]
    times = Counter((a, s) for a, s, _, _ in starts)
    hits = {}
    for a, s, n, offset in starts:
        if times[a, s] > 1:
            hits.setdefault((a, n), []).append(offset)
    assert {(r["a"], r["n"]): (r["least"], r["most"]) for r in found} == {k: (min(v), max(v)) for k, v in hits.items()}


@pytest.mark.parametrize("together", [1, 300, 1 << 18])
def test_strings_are_compared_some_offsets_at_a_time(monkeypatch, together):
    rows = list(_neighbourhood_rows(4, 12))
    reach, width = (np.array([r[c] for r in rows], np.int64) for c in ("reach", "width"))
    ends = np.cumsum([len(r["body"]) for r in rows])
    begins = ends - [len(r["body"]) for r in rows]
    group = np.array([r["a"] for r in rows])
    hashes = suffixes.PrefixHashes(np.frombuffer(b"".join(r["body"] for r in rows), np.uint8))
    monkeypatch.setattr(suffixes, "COMPARED_TOGETHER", together)
    low, high = suffixes._by_strings(hashes, begins, reach, width, group, 200)
    expected = suffixes.covered_offsets([r["body"] for r in rows], reach, width, np.full(4, 12), 200)
    assert [(a, b) for a, b in zip(low, high, strict=True) if a <= b] == [(a, b) for a, b in zip(*expected, strict=True) if a <= b]


def test_near_duplicates(spark):
    for rows in (ROWS, REPEATED):
        found = minhash.near_duplicates(frame(spark, rows), minhash.STRICT)
        expected = plain.near_components(rows, 3, 85, 100)
        expected = [(d, n, c if n else d) for d, n, c in expected]
        assert got(found, "doc_id", "n_shingles", "component_id") == want(expected)
        assert all(r.kept == (r.doc_id == r.component_id) for r in found.collect())


def test_one_row_of_each_component_stays(spark):
    """NULL and repeated ids: copies beside an id and among NULLs, two texts under one id, rows repeated in full."""
    rng = random.Random(13)
    a, b, c, d, e = (_phrase(rng, 100) for _ in range(5))
    near = a.rsplit(" ", 1)[0] + " changed"
    rows = [(None, a), (None, near), (3, near), (1, a), (0, b), (2, b), (2, c), (5, d), (5, d), (5, d), (None, e), (None, e)]
    wordless = [(9, ""), (9, ""), (None, None)]
    left = minhash.drop_near_duplicates(frame(spark, rows + wordless))
    assert left.columns == ["doc_id", "text", *CLASHING]
    assert got(left, "doc_id", "text") == want([(1, a), (0, b), (2, c), (5, d), (None, e), *wordless])


def test_near_duplicates_without_leaders(spark, monkeypatch):
    """Copies of copies, none of them like all others, and the exact comparison of what leaders leave."""
    rng = random.Random(3)
    words, rows = _phrase(rng, 100).split(), []
    for i in range(60):
        words[(7 * i) % 100] = f"w{i}"
        rows.append((i, " ".join(words)))
    found = minhash.near_duplicates(frame(spark, rows), minhash.STRICT)
    assert got(found, "doc_id", "n_shingles", "component_id") == want(plain.near_components(rows, 3, 85, 100))


def test_near_duplicates_of_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = minhash.near_duplicates(docs)
    assert got(found, "doc_id", "n_shingles", "component_id") == want(plain.near_components(rows, 5, 80, 100))


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {x: find(x) for x in root if find(x) != x}


@pytest.mark.parametrize("rows", [ROWS, REPEATED], ids=["rows", "repeated"])
def test_exact_dedup(spark, rows):
    is_past = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = exact.exact_duplicates(frame(spark, rows), is_past, block=7)
    expected, kept = plain.exact_groups(rows)
    assert got(found, "doc_id", "keep_id", "group_size", "text_sha256") == want(expected)
    assert found.where("kept").count() == kept
    for past in (F.lit(True), F.lit(False)):  # all known, nothing known
        again = exact.exact_duplicates(frame(spark, rows), past)
        assert got(again, "doc_id", "keep_id", "group_size", "text_sha256") == want(expected)


def test_lines(spark):
    rows = [r for r in ROWS if r[0] is not None]
    found = lines.deduplicated_lines(frame(spark, rows))
    assert got(found, "doc_id", "n_lines", "n_removed", "kept_text") == want(plain.repeated_lines(rows, lines.RUN))
    again = lines.deduplicated_lines(frame(spark, REPEATED))
    assert again.count() == len(REPEATED)
    left = lines.drop_repeated_lines(frame(spark, REPEATED))
    assert left.columns == ["doc_id", "text", *CLASHING]
    texts = {r.doc_id: r.text for r in left.where("doc_id is not null").collect()}
    assert 56 not in texts and texts[3] == ROWS[3][1] and texts[50] is None and texts[51] == ""


@pytest.mark.parametrize("run", [1, 2, 4])
def test_lines_of_other_runs(spark, run):
    rows = [r for r in ROWS if r[0] is not None]
    found = lines.deduplicated_lines(frame(spark, rows), run)
    assert got(found, "doc_id", "n_lines", "n_removed", "kept_text") == want(plain.repeated_lines(rows, run))


def _chunk_facts(rows, radius, least_run):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: plain.first(r[0])):
        data = (text or "").encode()
        edges = [0, *substrings.cuts(data, radius).tolist(), len(data)]
        gone, own = bytearray(len(data)), set()
        for a, b in zip(edges, edges[1:], strict=False):
            if data[a:b] in seen or data[a:b] in own:
                gone[a:b] = b"\x01" * (b - a)
            own.add(data[a:b])
        seen |= own
        run = 0
        for i in range(len(gone) + 1):
            if i < len(gone) and gone[i]:
                run += 1
            else:
                if 0 < run < least_run:
                    gone[i - run : i] = bytes(run)
                run = 0
        out.append((doc_id, *plain.cut(data, gone)))
    return out


def test_substring_dedup(spark):
    rows = [r for r in ROWS if r[0] is not None] + [(None, "nobody has this")]
    found = substrings.deduplicated_substrings(frame(spark, rows), substrings.RADIUS, substrings.LEAST_RUN)
    assert got(found, *SPAN_COLUMNS) == want(_chunk_facts(rows, substrings.RADIUS, substrings.LEAST_RUN))
    removed = {r.doc_id: r.n_removed for r in found.collect()}
    # The passage of 70 words in ten documents goes from all but the first; near and exact copies lose their repeats.
    assert removed[40] == 0 and all(removed[i] > 200 for i in range(41, 50))
    assert removed[56] == len(ROWS[3][1].encode())
    assert substrings.deduplicated_substrings(frame(spark, REPEATED)).count() == len(REPEATED)


def test_cuts_move_with_the_text_and_pieces_agree(monkeypatch):
    rng = random.Random(1)
    data = bytes(rng.randrange(97, 123) for _ in range(20_000))
    whole = substrings.cuts(data)
    assert 300 < len(whole) < 500
    moved = substrings.cuts(b"inserted words " + data) - 15
    assert set(whole[2:]) <= set(moved)
    monkeypatch.setattr(substrings, "PIECE_BYTES", 1000)
    assert substrings.cuts(data).tolist() == whole.tolist()


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    for number, rows in enumerate((ROWS, REPEATED)):
        path = str(tmp_path / f"file{number}")
        tokens.write_token_files(frame(spark, rows), path, BPE, parts=4, segment_ids=500)
        expected, at = [], 0
        for doc_id, text in sorted(rows, key=lambda r: (plain.first(r[0]), r[1] is not None, r[1] or "")):
            ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
            expected.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
        assert got(tokens.read_documents(spark, path), "doc_id", "start", "n_tokens", "ids_crc32") == want(expected)
    fetched = {r.doc_id: r.ids for r in tokens.fetch(spark, path, [0, 53, 59, 777]).collect()}
    assert set(fetched) == {0, 53, 59}
    text = next(t for d, t in ROWS if d == 53)
    assert fetched[53][-1] == 0 and library.decode(fetched[53][:-1]) == text
    # All rows of a repeated id, and of NULL, also where they go on in the next segment.
    rows = [*REPEATED, *[(7, f"copy {i} " * 60) for i in range(40)], *[(None, f"nameless {i} " * 60) for i in range(9)]]
    path = str(tmp_path / "repeated")
    tokens.write_token_files(frame(spark, rows), path, BPE, parts=3, segment_ids=300)
    found = tokens.fetch(spark, path, [3, 4, 7, 777], with_null=True)
    expected = [(d, (*library.encode(t or "", add_special_tokens=False).ids, 0)) for d, t in rows if d in (3, 4, 7, None)]
    assert Counter((r.doc_id, tuple(r.ids)) for r in found.collect()) == Counter(expected)
    plan = tokens.fetch(spark, path, [7])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(part" in plan or "PushedFilters: [EqualTo(part" in plan or "EqualTo(part" in plan
    assert tokens.fetch(spark, path, []).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=["a", " ", "\n", "\t", "é", "'", "s", "1", "　", "\xa0", "漢", "\x1c"], max_size=25), max_size=5))
def test_words_encode_like_the_text(texts):
    encoder = tokens._encoder(BPE)
    expected = [np.array(e.ids, encoder.dtype).tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == expected


EDGES = [*"aZ ,.'s1_~@[\x7f\n\t\x01\x85\xa0²×÷ÀÖØöøÿɏɐԀéя漢の🙂", "\u0301", "\u1680", "\u180e", "\u2003", "\u2028", "\u205f", "\u3000", "ll", "  "]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(EDGES), max_size=30).map("".join), max_size=6))
def test_pieces_encode_like_the_text(texts):
    encoder = tokens._encoder(BPE)
    expected = [np.array(e.ids, encoder.dtype).tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == expected == encoder.encode(texts)


def test_a_known_word_is_not_encoded_again_with_its_punctuation(monkeypatch):
    encoder, sent = tokens.WordEncoder(BPE), []
    library = encoder._library
    monkeypatch.setattr(encoder, "_library", lambda texts: sent.extend(texts) or library(texts))
    first, second = "Gezuhfns ofanonorsh cióncioel", "Ofanonorsh ofanonorsh, cióncioel.\nGezuhfns ofanonorsh***"
    encoder.encode([first])
    sent.clear()
    expected = np.array(encoder.tokenizer.encode(second, add_special_tokens=False).ids, encoder.dtype).tobytes()
    assert encoder.encode([second]) == [expected]
    assert sorted(text for text in sent if text) == sorted(["Ofanonorsh", ",", ".\nGezuhfns", "***"])


def test_words_of_any_length_do_not_fill_a_worker():
    encoder = tokens.WordEncoder(BPE)
    text = " ".join("ab" * 5_000 + str(i) for i in range(5))
    assert np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert sum(map(len, encoder.known)) < 1_000


def test_added_tokens_encode_as_the_tokenizer_does(spark, tmp_path):
    from tokenizers import Tokenizer

    mark = "<|endoftext|>"
    texts = [f"a {mark} b", mark, f"x{mark}y z", f"{mark} {mark}{mark}\n{mark}", f"end {mark}", f"a  {mark}  b", "<|endoftext |> a", "a b"]
    fresh = Tokenizer.from_file(BPE)
    expected = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert expected[0] == [64, 220, 50256, 275]
    encoder = tokens.WordEncoder(BPE)
    for _ in range(2):  # new words, known words
        assert [np.frombuffer(ids, encoder.dtype).tolist() for ids in encoder.encode(texts)] == expected
    path = str(tmp_path / "marked")
    tokens.write_token_files(frame(spark, list(enumerate(texts))), path, BPE)
    facts = [(i, len(ids) + 1, zlib.crc32(np.array([*ids, 0], "<u4").tobytes())) for i, ids in enumerate(expected)]
    assert got(tokens.read_documents(spark, path), "doc_id", "n_tokens", "ids_crc32") == want(facts)


def test_perfect_hash():
    keys = np.random.default_rng(2).integers(0, 1 << 63, (5000, 2), dtype=np.uint64)
    index = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    assert sorted(index.slots(keys).tolist()) == list(range(5000))
    assert len(PerfectHash.build(keys[:0]).slots(keys)) == 5000
    with pytest.raises(ValueError, match="distinct"):
        PerfectHash.build(np.concatenate([keys, keys[:1]]))


@pytest.mark.parametrize("slice_rows", [100_000, 9])
def test_sharding(spark, slice_rows):
    found = sharding.shard_documents(frame(spark, REPEATED), 8, slice_rows).collect()
    assert len(found) == len(REPEATED)
    facts = [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in REPEATED]
    assert want((r.doc_id, r["size"], r.text_crc32) for r in found) == want(facts)
    slots, shards = {}, {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
        shards.setdefault((r["size"], r.text_crc32), set()).add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())


def test_shards_are_equal_in_bytes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = [r[1] for r in sharding.shard_documents(docs, 40).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 40 and max(sizes) - min(sizes) < 0.03 * max(sizes)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=40), st.lists(st.integers(0, 100), min_size=1, max_size=9))
def test_best_fit_takes_the_tightest_bin(sizes, rooms):
    bins, left = sharding.pack(np.array(sizes), np.arange(len(sizes)), rooms)
    room = list(rooms)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(r, b) for b, r in enumerate(room) if r >= sizes[i]]
        expected = min(fits)[1] if fits else max((r, b) for b, r in enumerate(room))[1]
        assert bins[i] == expected
        room[expected] -= sizes[i]
    assert room == left


def test_decontamination(spark):
    rng = random.Random(11)
    items = [(i, _phrase(rng, 30)) for i in range(12)] + [(12, None), (13, "..."), (None, "an item without any id, found all the same"), (14, "Ça va")]
    edited = [items[0][1].upper(), items[1][1].replace(" ", " -- ", 2), items[2][1][:50] + "zz" + items[2][1][52:]]
    far = " ".join(w[::-1] for w in items[3][1].split())
    rows = [
        (0, f"{_phrase(rng, 50)} {edited[0]} {_phrase(rng, 50)}"),
        (1, edited[1]),
        (2, f"{_phrase(rng, 500)} {edited[2]}"),
        (3, far),
        (4, items[5][1] + "\n" + items[6][1] + "\n" + items[5][1]),
        (5, None),
        (6, ""),
        (None, items[7][1]),
        (7, items[8][1][: len(items[8][1]) // 2]),
        (8, "an item, without any id; found ALL the same"),
        (9, "ça va"),
    ]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit(1))
    expected = []
    for doc_id, text in rows:
        for item_id, item in items:
            pattern, body = decontam.plain(item), decontam.plain(text)
            if pattern and body and (d := plain.substring_distance(pattern, body)) <= int(len(pattern) * decontam.ERROR_RATE):
                expected.append((doc_id, item_id, d))
    assert len(expected) == 8
    for block_bytes in (decontam.BLOCK_BYTES, 600):
        found = decontam.contaminations(frame(spark, rows), table, block_bytes=block_bytes)
        assert got(found, "doc_id", "item_id", "distance") == want(expected)
    left = decontam.drop_contaminated(frame(spark, rows), table, block_bytes=600)
    assert sorted(r.doc_id for r in left.collect()) == [3, 5, 6, 7] and left.columns == ["doc_id", "text", *CLASHING]


@settings(max_examples=200, deadline=None)
@given(st.text("ab ", min_size=1, max_size=12), st.text("ab ", max_size=25))
def test_bit_parallel_distance(pattern, text):
    expected = plain.substring_distance(pattern.encode(), text.encode())
    assert decontam.Pattern(pattern.encode()).least_distance(text.encode(), 99) == expected


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="the anés▁漢", min_size=1, max_size=6))
def test_nbest_segmentations(text):
    model = sentencepieces._model(PIECES)
    every = sorted(plain.all_segmentations(" " + text, model.pieces, model.byte_score, model.byte_ids), key=lambda x: -x[0])
    found = model.encode(text, 5)
    assert [s for s, _ in found] == pytest.approx([s for s, _ in every[:5]])
    paths = {ids: s for s, ids in every}
    for score, ids in found:
        assert paths[tuple(np.frombuffer(ids, "<u4").tolist())] == pytest.approx(score)
        assert model.decode(ids).decode() == text
    assert len({ids for _, ids in found}) == len(found)


def test_pieces_round_trip(spark):
    docs = frame(spark, REPEATED)
    found = sentencepieces.checked(docs, PIECES).collect()
    assert len(found) == len(REPEATED) and all(r.round_trip for r in found)
    empty = [r for r in found if r.doc_id in (50, 51)]
    assert all((r.n_pieces, r.score, r.second_score) == (0, 0.0, None) for r in empty)
    encoded = sentencepieces.encode(docs, PIECES, 3)
    texts = {r.doc_id: r.text for r in sentencepieces.decode(encoded, PIECES).collect()}
    assert all(texts[d] == (t or "") for d, t in ROWS if d is not None and d != 4)
    assert all(len(r.alternatives) == 2 for r in encoded.where("doc_id between 0 and 3").collect())


def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prepare(spark)
    model = language.train(docs.where(language.learnable()))
    found = language.identify(docs.where(~language.learnable()), model)
    right = found.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98
    by_lang = {r.lang: r.text for r in docs.where("length(text) > 2000 and length(text) < 3000").dropDuplicates(["lang"]).collect()}
    mixed = by_lang["de"][:600] + " " + by_lang["es"][:500] + " 漢字 " + by_lang["fr"][:300]
    rows = [*REPEATED, (900, mixed), (901, "12 345 !?"), (902, "漢字漢字"), (903, "½ ²")]
    result = {r.doc_id: r for r in language.identify(frame(spark, rows), model).collect()}
    assert {s.lang for s in result[900].spans} == {"de", "es", "fr"} and result[900].lang_pred == "de"
    assert 0.3 < result[900].score < 0.6 and abs(result[900].spans[0].stop - 600) < 30
    assert all((result[d].lang_pred, result[d].score) == ("und", 0.0) for d in (50, 51, 52, 901, 903))
    assert result[902].lang_pred in model.languages
    kept = language.keep_identified(frame(spark, rows), model)
    assert kept.columns == ["doc_id", "text", *CLASHING]
    assert not {50, 51, 52, 901, 900} & {r.doc_id for r in kept.collect()}
    nothing = language.train(docs.where("lang = 'none'"))
    assert {r.lang_pred for r in language.identify(frame(spark, ROWS), nothing).collect()} == {"und"}


def test_repeats_around_a_megabyte(spark):
    """Runs of several periods that begin before, at and behind the place where a long text is cut into pieces."""
    rng, rows = np.random.default_rng(12), []
    for number, (period, start) in enumerate([(1, 1_048_476), (1, (1 << 20) - 65), (2, (1 << 20) + 3), (7, (1 << 20) - 700), (90, (1 << 21) - 400)]):
        noise = rng.integers(97, 123, start + 300, dtype=np.uint8).tobytes().decode()
        unit = rng.integers(65, 91, period, dtype=np.uint8).tobytes().decode()
        rows.append((number, noise[:start] + (unit * 1000)[:1000] + noise[start:]))
    found = suffixes.cut_repeated_strings(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_removed, r.n_spans) for r in found) == [(i, 1000, 1) for i in range(5)]


def test_texts_without_an_id_keep_their_own_spans(spark):
    """Many texts share NULL; the rows that hold a repeat lose it, and no other row loses anything."""
    rng = random.Random(3)
    alone = [_phrase(rng, 60) for _ in range(300)]
    shared = _phrase(rng, 80)
    texts = [*alone, *[f"{_phrase(rng, 5)} {shared} {_phrase(rng, 5)}" for _ in range(4)], *alone[:2]]
    rows = [(None, text) for text in texts]
    found = suffixes.cut_repeated_strings(frame(spark, rows))
    assert got(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want(plain.repeated_strings(rows, 200))


def test_language_scripts(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("добрый день мир", "ru"), ("good day world", "en"), ("καλημέρα κόσμε", "el")] * 3)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = [(0, "мир"), (1, "κόσμε world"), (2, "world мир мир мир")]
    result = {r.doc_id: r for r in language.identify(frame(spark, asked), model, switch=3.0).collect()}
    assert [result[i].lang_pred for i in range(3)] == ["ru", "el", "ru"]
    assert [s.lang for s in result[2].spans] == ["en", "ru"]


def test_letters_are_counted_one_by_one_and_foreign_ones_speak_for_no_language(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("guten tag welt", "de"), ("good day world", "en")] * 3)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = [(0, "x² y²"), (1, "H₂O"), (2, "добрый день"), (3, "good day добрый"), (4, "12 ²³ _"), (5, "漢字"), (6, "good " * 300_000)]
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(frame(spark, asked), model).collect()}
    assert all(found[i][0] in ("de", "en") and found[i][1] > 0 for i in (0, 1))
    assert found[2] == found[5] == ("de", 0.0) and found[4] == ("und", 0.0) and found[6] == ("en", 1.0)
    assert found[3] == ("en", 7 / 13)
    kept = {r.doc_id for r in language.keep_identified(frame(spark, asked), model).collect()}
    assert not {2, 4, 5} & kept and {0, 1, 3, 6} <= kept


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(*[st.integers(-9, 0)] * 3), max_size=12), min_size=1, max_size=5), st.integers(0, 6))
def test_viterbi_is_optimal(sequences, switch):
    lengths = np.array([len(s) for s in sequences])
    scores = np.array([row for s in sequences for row in s], float).reshape(-1, 3)
    labels = language.viterbi(scores, lengths, switch)
    at = 0
    for sequence in sequences:
        own = labels[at : at + len(sequence)].tolist()
        if sequence:
            total = sum(row[k] for row, k in zip(sequence, own, strict=True))
            total -= switch * sum(a != b for a, b in zip(own, own[1:], strict=False))
            assert total == plain.best_path(sequence, switch)
        at += len(sequence)


def test_empty_tables(spark):
    docs = frame(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    model = language.LanguageModel(("en",), np.zeros((1, language.BUCKETS), np.float32), np.ones((len(language.SCRIPTS), 1), bool))
    results = [
        language.identify(docs, model),
        lines.deduplicated_lines(docs),
        lines.drop_repeated_lines(docs),
        sentencepieces.checked(docs, PIECES),
        tokens.token_table(docs, BPE),
        decontam.contaminations(docs, items),
        decontam.contaminations(frame(spark, ROWS), items),
        suffixes.cut_repeated_strings(docs),
        substrings.deduplicated_substrings(docs),
        minhash.near_duplicates(docs),
        minhash.drop_near_duplicates(docs),
        sharding.shard_documents(docs, 40),
        exact.exact_duplicates(docs, F.lit(True)),
    ]
    assert [df.count() for df in results] == [0] * len(results)
    assert decontam.drop_contaminated(frame(spark, ROWS), items).count() == len(ROWS)

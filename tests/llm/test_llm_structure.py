"""Periodic runs, conversation repair and source mixing against plain versions."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import plain
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_llm_operators import CLASHING, REPEATED, frame

from remitlens.llm import conversations, mixing, periods
from remitlens.llm.queries import QUERIES


def bag(df, *names):
    return Counter(tuple(row[name] for name in names) for row in df.collect())


# --- periodic runs -------------------------------------------------------------------------------------------
RUN_COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


@st.composite
def word_numbers(draw):
    words = draw(st.lists(st.integers(0, draw(st.integers(0, 4))), max_size=60))
    for _ in range(draw(st.integers(0, 3))):
        piece = draw(st.lists(st.integers(0, 3), min_size=1, max_size=6))
        at = draw(st.integers(0, len(words)))
        words[at:at] = (piece * 8)[: draw(st.integers(1, 40))]
    return words


@settings(max_examples=400, deadline=None)
@given(word_numbers(), st.sampled_from([(4, 6), (3, 4), (5, 9), (3, 12)]))
def test_runs_of_words(words, rule):
    assert periods.runs_of(np.array(words, np.int64), *rule) == plain.periodic_runs(words, *rule)


@settings(max_examples=200, deadline=None)
@given(word_numbers())
def test_every_suffix_has_its_last_end(words):
    """The segments that an access crosses are the suffixes by the place where they last ended."""
    longest, link, prefixes = periods.suffix_automaton(words)
    tree = periods.LastEnds(link)
    for place, state in enumerate(prefixes):
        found = [(longest[node], end) for node, end in tree.access(state, place) if end >= 0]
        want = {}
        for length in range(1, place + 1):
            ends = [e for e in range(length - 1, place) if words[e - length + 1 : e + 1] == words[place - length + 1 : place + 1]]
            if ends:
                want[max(ends)] = length
        assert sorted(found) == sorted((length, end) for end, length in want.items())


def test_words_beyond_the_packed_triples():
    """More than 2**21 different words: pairs are numbered before triples."""
    many = np.concatenate([np.arange(1 << 21), np.tile([5, 6, 7], 10), np.arange(1 << 21) + (1 << 21)])
    assert periods.runs_of(many) == [((1 << 21), 30, 3)]


def test_run_facts_of_hostile_rows(spark):
    rng = random.Random(3)
    tenth = [i for i in range(1000, 1400) if plain.zlib.crc32(str(i).encode()) % 10 == 0][:12]
    rows = [*REPEATED, *[(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))) for i in range(100, 160)]]
    rows += [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 300)))) for i in tenth]
    rows += [(tenth[0], None), (tenth[1], " \n"), (tenth[2], "one"), (None, "x y " * 9), (None, "x y " * 9)]
    rows += [(2000, "A a " * 5 + " ".join("b" * 9)), (2001, "z\x0bz\x0cz\rz\tz z\nz"), (2002, "漢 字 " * 7)]
    found = periods.run_facts(periods.periodic_runs(periods.planted(frame(spark, rows))))
    assert found.columns == list(RUN_COLUMNS)
    assert bag(found, *RUN_COLUMNS) == Counter(plain.run_facts(*row) for row in rows)


def test_runs_in_very_long_texts(spark):
    """3 MB with a run at the start, one across the middle and one that ends with the text; and one word of 2 MB."""
    rng = random.Random(5)
    noise = [f"w{rng.randrange(10**9)}" for _ in range(120_000)]
    words = ["s"] * 9 + noise[:60_000] + [f"m{i % 700}" for i in range(70_000)] + noise[60_000:] + ["e", "f"] * 50
    row = periods.periodic_runs(frame(spark, [(1, " ".join(words)), (2, "x" * 2_000_000)])).orderBy("doc_id").collect()
    want = [(0, 9, 1), (60_009, 70_000, 700), (len(words) - 100, 100, 2)]
    assert [tuple(r) for r in row[0].runs] == want and len(row[0].collapsed.split()) == len(words) - 8 - 69_300 - 98
    assert row[1].runs == [] and row[1].collapsed == "x" * 2_000_000


def test_op11_over_the_supplied_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert bag(QUERIES["op11_periodic_runs"](spark, SMALL), *RUN_COLUMNS) == Counter(plain.run_facts(*r) for r in rows)


# --- conversation repair -------------------------------------------------------------------------------------
REPAIR_COLUMNS = (
    "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from(["", "", "truncated", "blank"]), st.integers(1, 9)), max_size=9))
def test_cheapest_edits(runs):
    symbols = [(initial, fault) for initial, fault, n in runs for _ in range(n)]
    coded = [(conversations.DOOMED if f == "blank" else i.upper() if f else i, n) for i, f, n in runs]
    assert conversations.cheapest_edits(coded) == plain.cheapest_repair(symbols)


def test_a_run_of_a_million_rows():
    cost, audit = conversations.cheapest_edits([("s", 1), ("u", 1_000_000), ("a", 1)])
    small = plain.cheapest_repair([("s", "")] + [("u", "")] * 40 + [("a", "")])
    assert small[0] == 19 * 3 + 3 and cost == 499_999 * 3 + 3
    assert Counter(audit) == {"K": 500_003, "R": 499_999, "I": 1} and audit[:30] == small[1][:30] and audit[-5:] == small[1][-5:]


CHAT = "conv_id long, turn long, role string, text string"


def _chats():
    rng = random.Random(11)
    texts = ["Hello there.", "Why?", "no end", "", " \t\n", "Yes!  ", None, "a. b", "same.", "Ünïcödé 漢字。", "x" * 50_000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "s", "USER"]
    rows = [(i, t, rng.choice(roles[:5]), rng.choice(texts)) for i in range(150) for t in range(rng.randint(1, 9))]
    rows += [(i, rng.choice([None, *range(5)]), rng.choice(roles), rng.choice(texts)) for i in range(150, 260) for _ in range(rng.randint(1, 7))]
    rows += [(None, t, rng.choice(roles), rng.choice(texts)) for t in range(12)]
    rows += [(300, t, "user" if t % 2 == 0 else "assistant", f"text {t % 700}.") for t in range(3000)]
    rows += [(301, None, "user", "again.")] * 40 + [(302, 7, "user", "again.")] * 40 + [(303, -5, "user", "a."), (303, 9, "assistant", "b.")]
    dropped = [t for t in range(400) if plain.zlib.crc32(f"400:{t}".encode()) % 20 == 0]
    return rows + [(400, t, "user", "gone.") for t in dropped]


def chats(spark, rows):
    df = spark.createDataFrame(rows, CHAT).repartition(3)
    names = {*CLASHING, "audit", "copies", "seen", "blank", "truncated", "of_conv", "of_role", "edit", "gaps", "cost"}
    return df.select("*", *[F.lit("x").alias(name) for name in sorted(names)])


def test_repaired_conversations(spark):
    rows = _chats()
    found = conversations.repaired_conversations(chats(spark, rows))
    assert found.columns == list(REPAIR_COLUMNS)
    assert bag(found, *REPAIR_COLUMNS) == Counter(plain.repaired(rows))


def test_repaired_rows_are_what_the_digest_says(spark):
    hurt = conversations.damaged(chats(spark, _chats()))
    found = conversations.audits(hurt)
    lines = defaultdict(list)
    for row in conversations.repaired_rows(hurt, found).orderBy("place").collect():
        assert row.place == len(lines[row.conv_id])
        lines[row.conv_id].append(f"{row.role}:{row.text}")
        initials = "".join(line[0] for line in lines[row.conv_id])
        assert plain.re.fullmatch("s?(ua)*u?", initials)
    for row in conversations.repair(hurt).collect():
        assert row.repaired_sha256 == plain.sha("\n".join(lines[row.conv_id]).encode())


def test_no_conversations(spark):
    assert conversations.repaired_conversations(chats(spark, [])).count() == 0
    assert conversations.repaired_rows(chats(spark, []), conversations.audits(chats(spark, []))).count() == 0


# --- mixing --------------------------------------------------------------------------------------------------
def _mixable():
    rng = random.Random(2)
    rows = [(i, " ".join("w" * 3 for _ in range(int(rng.paretovariate(1.1) * 5) % 3000)), f"s{rng.randrange(4)}") for i in range(1500)]
    rows += [(i, "hot words here", "hot") for i in range(2000, 3000)]
    rows += [(None, "repeated row of six words", "twice")] * 300 + [(7, "tiny", "a-tiny")] + [(8, None, None), (None, "no source", None)]
    rows += [(9, None, "empty"), (10, " \n", "empty"), (11, "é 漢 字 x", "é"), (12, "upper", "Z"), (13, "z", "")]
    return rows


def mixable(spark, rows, partitions=3):
    from remitlens.llm.common import prepare

    prepare(spark)
    names = ("number", "n", "size", "target", "taken", "weight", "most", "units", "base", "inclusion", "blocks", "row", "piece", "lang")
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(partitions)
    return df.select("*", *[F.lit("x").alias(name) for name in names])


def sizes_of(rows):
    sizes = Counter({source: 0 for _, _, source in rows})
    for _, text, source in rows:
        sizes[source] += len(plain.WORD.findall(text or ""))
    return sizes


@pytest.mark.parametrize("block_rows", [40, 20_000])
def test_mixing(spark, block_rows):
    rows = _mixable()
    found = mixing.mixed(mixable(spark, rows), block_rows=block_rows)
    assert found.columns == ["doc_id", "size", "source_size", "target", "taken", "copies"]
    sizes, want = sizes_of(rows), plain.source_targets(sizes_of(rows))
    out, by_target = found.collect(), defaultdict(list)
    assert Counter((r.doc_id, r.size) for r in out) == Counter((d, len(plain.WORD.findall(t or ""))) for d, t, _ in rows)
    for row in out:
        by_target[row.source_size, round(row.target, 6)].append(row)
        assert row.taken == row.copies * row.size <= 3 * row.size
        rate = row.target / row.source_size if row.source_size else 0
        assert int(rate - 1e-6) <= row.copies <= int(rate + 1 + 1e-6)
    told = Counter({(sizes[s], round(float(want[s]), 6)): 0 for s in sizes})
    for source in sizes:
        told[sizes[source], round(float(want[source]), 6)] += sum(s == source for _, _, s in rows)
    assert told == Counter({key: len(members) for key, members in by_target.items()})
    for (size, target), members in by_target.items():
        largest = max(m.size for m in members)
        sources = sum((sizes[s], round(float(want[s]), 6)) == (size, target) for s in sizes)
        assert abs(sum(m.taken for m in members) - sources * target) <= sources * max(largest / 2, 0.002 * target) + 1e-6


def test_mixing_does_not_depend_on_partitions(spark):
    rows = _mixable()
    columns = ("doc_id", "size", "source_size", "target", "taken")
    first = bag(mixing.mixed(mixable(spark, rows), block_rows=64), *columns)
    assert first == bag(mixing.mixed(mixable(spark, rows[::-1], 7), block_rows=64), *columns)


def test_targets_with_caps_after_caps(spark):
    sizes = {"a": 1000, "b": 10, "c": 1, "d": 5, "e": 300, "f": 2, None: 90, "": 0}
    rows = [(i, "w " * n, source) for i, (source, n) in enumerate(sizes.items())]
    found = {r.source: r.target for r in mixing.targets(mixing.units(mixable(spark, rows))).collect()}
    want = plain.source_targets(sizes)
    assert found.keys() == want.keys() and all(found[s] == pytest.approx(float(want[s])) for s in want)
    assert sum(found.values()) == pytest.approx(sum(sizes.values()))


def test_nothing_to_mix(spark):
    assert mixing.mixed(mixable(spark, [])).count() == 0
    silent = mixing.mixed(mixable(spark, [(1, None, "a"), (2, "", "b"), (None, None, None)])).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in silent] == [(0, 0, 0.0, 0)] * 3


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 500), st.floats(0, 1)), max_size=60), st.integers(0, 2**32))
def test_flight_keeps_both_balances(documents, seed):
    sizes, inclusion = [float(s) for s, _ in documents], [p for _, p in documents]
    before = list(inclusion)
    left = mixing.flight(sizes, inclusion, np.random.default_rng(seed), 2)
    assert len(left) <= 2 and all(p in (0, 1) for i, p in enumerate(inclusion) if i not in left)
    assert sum(inclusion) == pytest.approx(sum(before), abs=1e-6)
    assert np.dot(sizes, inclusion) == pytest.approx(np.dot(sizes, before), rel=1e-6, abs=1e-3)


def test_flight_changes_no_inclusion_in_expectation():
    rng = np.random.default_rng(0)
    sizes, start = [3.0, 9, 4, 100, 7, 7, 50, 2, 11, 30], [0.1, 0.5, 0.9, 0.3, 0.5, 0.5, 0.7, 0.2, 0.8, 0.5]
    total = np.zeros(10)
    for _ in range(4000):
        inclusion = list(start)
        mixing.flight(sizes, inclusion, rng, 2)
        total += inclusion
    assert np.abs(total / 4000 - start).max() < 0.04


def test_landing_is_the_nearest_rounding():
    assert mixing.land(np.array([100.0, 60, 40]), np.array([0.5, 0.5, 0.5])).sum() in (1, 2)
    chosen = mixing.land(np.array([100.0, 60, 40]), np.array([0.5, 0.5, 0.5]))
    assert chosen @ np.array([100, 60, 40]) == 100


def test_op13_over_the_supplied_documents(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want, source = plain.source_targets(sizes_of(rows)), {d: s for d, _, s in rows}
    taken = Counter()
    for row in QUERIES["op13_source_mixing"](spark, SMALL).collect():
        taken[source[row.doc_id]] += row.taken
        assert row.target == pytest.approx(float(want[source[row.doc_id]])) and row.taken <= 3 * row.size
    for name, target in want.items():
        assert abs(taken[name] - target) <= 0.2 * target

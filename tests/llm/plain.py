"""Plain versions of the text operators, for small inputs: dictionaries and loops over (doc_id, text) rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def first(doc_id):
    """Sort key with NULL before all."""
    return (doc_id is not None, doc_id or 0)


def cut(data: bytes, gone: bytearray) -> tuple:
    kept = bytes(c for c, x in zip(data, gone, strict=True) if not x)
    return len(data), sum(gone), len(re.findall(b"\x01+", bytes(gone))), sha(kept)


def repeated_strings(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row."""
    texts = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    starts = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for doc_id, data in texts:
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if starts[data[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        out.append((doc_id, *cut(data, gone)))
    return out


def shingles(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < k else [tuple(words[i : i + k]) for i in range(len(words) - k + 1)])


def near_components(rows, k, least, of):
    """(doc_id, n_shingles, component_id) of each row."""
    sets = [shingles(text, k) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and of * len(a & b) >= least * len(a | b):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        members[find(i)].append(doc_id)
    return [
        (doc_id, len(s), min((d for d in members[find(i)] if d is not None), default=None))
        for i, ((doc_id, _), s) in enumerate(zip(rows, sets, strict=True))
    ]


def exact_groups(rows):
    """(doc_id, keep_id, group_size, text_sha256) of each row, and the number of rows kept."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[SPACE.sub("", text or "")].append((-len(text or ""), first(doc_id), doc_id))
    out = [
        (doc_id, min(groups[bare])[2], len(groups[bare]), sha(bare.encode()))
        for doc_id, bare in ((d, SPACE.sub("", t or "")) for d, t in rows)
    ]
    return out, len(groups)


def repeated_lines(rows, run):
    """The kept lines of each row; rows must differ in (doc_id, text)."""
    places = defaultdict(list)
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        for i in range(len(lines) - run + 1):
            places[tuple(lines[i : i + run])].append((first(doc_id), i))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = set()
        for i in range(len(lines) - run + 1):
            if min(places[tuple(lines[i : i + run])]) < (first(doc_id), i):
                gone.update(range(i, i + run))
        out.append((doc_id, len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


def substring_distance(pattern: bytes, text: bytes) -> int:
    """Least edit distance of the pattern to any substring of the text."""
    row = [0] * (len(text) + 1)
    for i, code in enumerate(pattern, 1):
        before, row[0] = row[0], i
        for j, other in enumerate(text, 1):
            before, row[j] = row[j], min(before + (code != other), row[j] + 1, row[j - 1] + 1)
    return min(row)


def all_segmentations(unit, pieces, byte_score, byte_ids):
    """(score, ids) of every path through the piece lattice."""
    if not unit:
        return [(0.0, ())]
    out = []
    for j in range(1, len(unit) + 1):
        edges = []
        if unit[:j] in pieces:
            i, score = pieces[unit[:j]]
            edges.append((score, (i,)))
        elif j == 1:
            codes = unit[0].encode()
            edges.append((byte_score * len(codes), tuple(byte_ids[c] for c in codes)))
        for score, ids in edges:
            out += [(score + s, ids + rest) for s, rest in all_segmentations(unit[j:], pieces, byte_score, byte_ids)]
    return out


def best_path(scores, switch):
    """Viterbi by dynamic programming over one sequence: the best total."""
    value = list(scores[0])
    for row in scores[1:]:
        top = max(value) - switch
        value = [max(v, top) + s for v, s in zip(value, row, strict=True)]
    return max(value)


def planted_words(doc_id, text):
    words = WORD.findall(text or "")
    if doc_id is not None and words:
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def periodic_runs(words, times=4, least=6):
    """(start, length, smallest period) of every maximal run, by trying all periods."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def run_facts(doc_id, text):
    """The whole row of a document."""
    words = planted_words(doc_id, text)
    runs = periodic_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    told = (*best, best[1] * 1000 // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *told, sha(lines.encode()), sha(kept.encode()))


def cheapest_repair(symbols):
    """(cost, audit) over (role initial, fault) symbols: every sequence of edits, kept as the best per state and row."""
    best = {"": (0, "")}  # by the initials given so far, as far as they matter

    def offer(to, state, cost, audit):
        if (cost, audit) < to.get(state, (10**9, "")):
            to[state] = (cost, audit)

    def turn(state):
        return "a" if state == "u" else "u"

    def inserted(states):
        for _ in range(3):
            for state, (cost, audit) in list(states.items()):
                offer(states, turn(state), cost + 3, audit + "I")
        return states

    for initial, fault in symbols:
        after = {}
        for state, (cost, audit) in inserted(best).items():
            offer(after, state, cost + 4, audit + "D")
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault == "truncated" else 0
            if (initial == "s" and state == "") or (initial in "ua" and initial == turn(state)):
                offer(after, initial, cost + extra, audit + "K")
            offer(after, turn(state), cost + 3 + extra, audit + "R")
        best = after
    return min(inserted(best)[state] for state in ("", "a") if state in best)


def repaired(rows):
    """Rows (conv_id, turn, role, text) as given: by conv_id, the facts of the damaged conversation and its repaired lines."""
    damaged = defaultdict(list)
    for conv_id, turn, role, text in rows:
        damaged[conv_id] += []
        role, text = " " if role is None else role, " " if text is None else text
        named = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(named.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        damaged[conv_id] += [(turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    out = []
    for conv_id, own in damaged.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha(r[2].encode())))
        faults, seen = [], set()
        for _, role, text in own:
            bare = text.strip(" \t\n\v\f\r")
            faults.append(
                "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            )
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = cheapest_repair(zip([i if i in ("s", "u", "a") else "x" for i in initials], faults, strict=True))
        lines, state, left = [], "", list(own)
        for edit in audit:
            role, text = left.pop(0)[1:] if edit != "I" else (None, "")
            if edit != "D":
                state = role[:1] if edit == "K" else "a" if state == "u" else "u"
                lines.append(f"{role if edit == 'K' else {'a': 'assistant', 'u': 'user'}[state]}:{text}")
        counts = Counter(faults)
        out.append(
            (conv_id, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha("\n".join(lines).encode()))
        )
    return out


def source_targets(sizes, cap=3):
    """Target by source of a dictionary of word totals, by removing capped sources until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    out, free, rest = {}, set(order), Fraction(sum(sizes.values()))
    while free:
        level = rest / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > cap * sizes[s]}
        if not above:
            out |= {s: weight[s] * level for s in free}
            break
        out |= {s: Fraction(cap * sizes[s]) for s in above}
        rest -= sum(cap * sizes[s] for s in above)
        free -= above
    return out

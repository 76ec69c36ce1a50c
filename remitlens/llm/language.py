"""Language identification of whole texts, with spans for texts in several languages.

A model holds, for every learned language, the log-probabilities of hashed letter n-grams and the scripts in which the
language is written. Each word of a text is scored in all languages at once: the ranges of its letters name a script,
the script narrows the candidates, and the n-grams of the word score them. Viterbi over the words, with a penalty for
each change of language, labels the spans; the language with most letters names the text.

NULL texts and texts without letters are ``und`` with score 0 and no spans. Letters are counted one by one, also in words with
other signs (``x²``). A word in a script of no learned language scores alike in all and speaks for none: its letters lower the score of the
text, to 0 if there are no others. A text of any length is labelled whole. Ties go to the language first in alphabetical order. Repeated rows are labelled alike;
other columns are ignored; an empty table gives an empty result. Without any labelled row nothing is learned, and
every text is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import grouped, mix

UNKNOWN = "und"
#: Hash buckets of letter n-grams, by language.
BUCKETS = 1 << 16
GRAMS = (1, 2, 3, 4)
#: Bound of the training sample: about so many texts of each language.
SAMPLE_TEXTS = 4_000
#: A language is a candidate for a script that has this share of its letters.
SCRIPT_SHARE = 0.01
#: What a change of language costs, in units of log-probability.
SWITCH = 12.0
#: The n-gram orders see the same letters, so their evidence counts in part.
WEIGHT = 0.5
EXCLUDED = -50.0
#: Bytes of a model that is sent to every worker.
MODEL_BYTES = 256 << 20
REMEMBERED = 300_000
TEXT_BYTES = 6 << 20

#: First code points of ranges and the script of their letters, in the order of Unicode blocks.
SCRIPT_RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
    (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "burmese"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"),
    (0x1800, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"),
    (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"),
)
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})
_RANGE_STARTS = np.array([start for start, _ in SCRIPT_RANGES])
_RANGE_SCRIPTS = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES])

_WORD = re.compile(r"[^\W\d_]+")
_SPACE = np.uint32(32)

SPANS = "array<struct<start:int,stop:int,lang:string>>"


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and word number of every n-gram of blank-enclosed words."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), "<u4")
    blank = codes == _SPACE
    number = np.cumsum(blank) - 1
    buckets, owners = [], []
    with np.errstate(over="ignore"):
        total = np.zeros(len(codes), np.uint64)
        for n in range(1, max(GRAMS) + 1):
            size = len(codes) - n + 1
            if size <= 0:
                break
            total = mix(total[:size] + codes[n - 1 :][:size].astype(np.uint64), n)
            if n not in GRAMS:
                continue
            # A blank may stand first or last in an n-gram, not inside and not alone.
            whole = np.ones(size, bool)
            for j in range(n):
                if 0 < j < n - 1 or n == 1:
                    whole &= ~blank[j : j + size]
            if n == 2:
                whole &= ~(blank[:size] & blank[1 : 1 + size])
            at = np.flatnonzero(whole)
            buckets.append((total[at] & np.uint64(BUCKETS - 1)).astype(np.int64))
            owners.append(number[at])
    return np.concatenate(buckets), np.concatenate(owners)


def _scripts(words: list[str]) -> np.ndarray:
    first = np.array([ord(word[0]) for word in words])
    return _RANGE_SCRIPTS[np.searchsorted(_RANGE_STARTS, first, side="right") - 1]


@dataclass(frozen=True)
class LanguageModel:
    """``log_probs``: (languages, buckets); ``candidates``: (scripts, languages)."""

    languages: tuple[str, ...]
    log_probs: np.ndarray
    candidates: np.ndarray


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams, and behind them of letters by script, for each language of the partition."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            words = [w for w in _WORD.findall((text or "").lower()) if w.isalpha()]
            if words:
                own = counts.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                own[:BUCKETS] += np.bincount(_grams(words)[0], minlength=BUCKETS)
                letters = np.array([len(w) for w in words])
                own[BUCKETS:] += np.bincount(_scripts(words), letters, len(SCRIPTS)).astype(np.int64)
    for lang, own in counts.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])],
            names=["lang", "bucket", "n"],
        )


def train(labelled: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> LanguageModel:
    """Learn from ``labelled`` (text, lang). Of a language with more than ``sample_texts`` rows, about that many are
    taken by a hash of the whole text; counts of rows cover all."""
    rows = labelled.where(F.col("lang").isNotNull()).select(F.col("text").cast("string"), F.col("lang").cast("string"))
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    languages = tuple(sorted(sizes))
    if 4 * BUCKETS * len(languages) > MODEL_BYTES:
        raise ValueError(f"{len(languages)} languages make a model beyond {MODEL_BYTES} bytes")
    if not languages:
        return LanguageModel((), np.zeros((0, BUCKETS), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    scale = 1 << 20
    share = F.create_map(
        *[F.lit(x) for lang in languages for x in (lang, min(scale, sample_texts * scale // sizes[lang] + 1))]
    )
    chosen = rows.where(F.pmod(F.xxhash64("text"), F.lit(scale)) < share[F.col("lang")])
    counted = chosen.mapInArrow(_count_batches, "lang string, bucket int, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    totals = np.zeros((len(languages), BUCKETS + len(SCRIPTS)))
    row = found["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(dtype=np.int64)
    totals[row, found["bucket"].to_numpy()] = found["n"].to_numpy()
    grams, letters = totals[:, :BUCKETS] + 0.5, totals[:, BUCKETS:]
    log_probs = np.log(grams / grams.sum(axis=1, keepdims=True)) * WEIGHT
    candidates = letters.T >= SCRIPT_SHARE * np.maximum(letters.sum(axis=1), 1)
    candidates &= letters.T > 0
    return LanguageModel(languages, log_probs.astype(np.float32), candidates)


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """The best path of each sequence: labels, in the order of ``scores`` (words of one text after another).

    All sequences advance together, the longest first, so that those still running are always the leading ones.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    longest = int(lengths.max(initial=0))
    running = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    width = scores.shape[1]
    came = np.zeros(scores.shape, np.int8 if width < 128 else np.int16)
    own = np.arange(width, dtype=came.dtype)
    labels = np.zeros(len(scores), came.dtype)
    if not longest:
        return labels
    value = scores[starts[: running[0]]].astype(np.float64)
    for t in range(1, longest):
        n = running[t]
        now = value[:n]
        best = now.argmax(axis=1)
        leap = now[np.arange(n), best] - switch
        stay = now >= leap[:, None]
        at = starts[:n] + t
        came[at] = np.where(stay, own, best[:, None].astype(came.dtype))
        value[:n] = np.where(stay, now, leap[:, None]) + scores[at]
    label = value.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = running[t]
        at = starts[:n] + t
        labels[at] = label[:n]
        if t:
            label[:n] = came[at, label[:n]]
    return labels


class Labeller:
    """Scores of words, remembered, and the labels of texts."""

    def __init__(self, model: LanguageModel, switch: float):
        self.model, self.switch = model, switch
        self.barred = np.where(model.candidates, 0.0, EXCLUDED).astype(np.float32)
        self.barred[~model.candidates.any(axis=1)] = 0
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)), np.float32)
        self.letters = np.zeros((0, 2), np.int64)

    def _learn(self, words: set[str]) -> None:
        if len(self.numbers) > REMEMBERED:
            self._forget()
        fresh = [word for word in words if word not in self.numbers]
        if not fresh:
            return
        size = len(fresh)
        buckets, owners = _grams(fresh)
        scripts = _scripts(fresh)
        scores = np.zeros((size, len(self.model.languages)))
        for language, probs in enumerate(self.model.log_probs):
            scores[:, language] = np.bincount(owners, probs[buckets], size)
        scores += self.barred[scripts]
        known = self.model.candidates.any(axis=1)[scripts]
        scores = np.where(known[:, None], scores - scores.max(axis=1, keepdims=True, initial=-np.inf), 0)
        self.numbers.update(zip(fresh, range(len(self.numbers), len(self.numbers) + size), strict=True))
        self.scores = np.concatenate([self.scores, scores.astype(np.float32)])
        # Letters, and those of them that speak for a language: a word in a script of none speaks for none.
        letters = np.array([len(word) if word.isalpha() else sum(map(str.isalpha, word)) for word in fresh])
        self.letters = np.concatenate([self.letters, np.stack([letters, np.where(known, letters, 0)], axis=1)])

    def label(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The label of each word of each text, and its letters: all of them, and those that speak for a language."""
        split = [_WORD.findall(text.lower()) for text in texts]
        self._learn(set().union(*split))
        lengths = np.array([len(words) for words in split], np.int64)
        get = self.numbers.__getitem__
        numbers = np.fromiter((n for words in split for n in map(get, words)), np.int64, int(lengths.sum()))
        letters = self.letters[numbers]
        labels = viterbi(self.scores[numbers], lengths, self.switch) if len(self.model.languages) else numbers * 0
        cuts = np.cumsum(lengths)[:-1]
        return np.split(labels, cuts), np.split(letters, cuts)


def _spans(text: str, labels: np.ndarray, languages: tuple[str, ...]) -> list[dict]:
    """Runs of words with one label, as code point ranges from the first word's start to the last one's end."""
    if not len(labels):
        return []
    edges = np.flatnonzero(np.diff(labels)) + 1
    firsts, lasts = [0, *edges.tolist()], [*(edges - 1).tolist(), len(labels) - 1]
    places = [m.span() for m in _WORD.finditer(text)]
    if len(places) != len(labels):  # lower-casing moved a word border: the words of the lowered text count
        places = [m.span() for m in _WORD.finditer(text.lower())]
    return [
        {"start": places[a][0], "stop": places[b][1], "lang": languages[int(labels[a])]}
        for a, b in zip(firsts, lasts, strict=True)
    ]


def _decisions(labels: np.ndarray, letters: np.ndarray, languages: tuple[str, ...]) -> tuple[str, float]:
    total, speaking = int(letters[:, 0].sum()), letters[:, 1]
    if not total or not languages:
        return UNKNOWN, 0.0
    by_language = np.bincount(labels, speaking, len(languages))
    best = int(by_language.argmax())
    return languages[best], float(by_language[best] / total)


def _labelled_texts(labeller: Labeller, batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, str, float]]:
    texts = [t or "" for t in batch.column("text").to_pylist()]
    for a, b in grouped(texts, TEXT_BYTES):
        for text, labels, letters in zip(texts[a:b], *labeller.label(texts[a:b]), strict=True):
            yield text, labels, *_decisions(labels, letters, labeller.model.languages)


def identify(docs: DataFrame, model: LanguageModel, switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score (the language's share of the letters) and the spans of every row."""

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model, switch)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())]))
        for batch in batches:
            found = list(_labelled_texts(labeller, batch))
            spans = [_spans(text, labels, model.languages) if lang != UNKNOWN else [] for text, labels, lang, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([f[2] for f in found], pa.string()),
                    pa.array([f[3] for f in found], pa.float64()),
                    pa.array(spans, kind),
                ],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    rows = docs.select("doc_id", F.col("text").cast("string"))
    return rows.mapInArrow(identified, f"doc_id long, lang_pred string, score double, spans {SPANS}")


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.5, switch: float = SWITCH) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with at least ``least`` of its letters."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model, switch)
        for batch in batches:
            found = _labelled_texts(labeller, batch)
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for _, _, lang, score in found], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def learnable(doc_id: str = "doc_id") -> Column:
    """The rows that may be learned from: two thirds by a checksum of the id; the others are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 != 1, F.lit(False))

"""Cutting spans of bytes out of texts, and the facts that are reported about it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import same, texts_of

CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def text_key() -> Column:
    """Tells texts apart that share a doc_id, by 64 bits."""
    return F.xxhash64("text")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of sorted (start, stop) spans; touching spans are one."""
    out: list[tuple[int, int]] = []
    for start, stop in spans:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def _cutter(least_run: int, keep: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in texts_of(batch)]
            rows = []
            for text, spans in zip(texts, batch.column("spans").to_pylist(), strict=True):
                runs = merged(sorted((s["start"], s["stop"]) for s in spans or ()))
                runs = [(a, b) for a, b in runs if b - a >= least_run]
                edges = [0, *(x for run in runs for x in run), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if runs else text
                rows.append((len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept if keep else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]],
                names=["doc_id", *names],
            )

    return cut


def cut_spans(docs: DataFrame, spans: DataFrame, least_run: int = 1, keep: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and (with ``keep``) the kept bytes of every row.

    ``spans``: span_id, span_key and an array of (start, stop) in bytes, one row per text that has any.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    matches = same(F.col("doc_id"), F.col("span_id")) & (text_key() == F.col("span_key"))
    rows = rows.join(spans, matches, "left").select("doc_id", "text", "spans")
    out = rows.mapInArrow(_cutter(least_run, keep), CUT)
    return out if keep else out.drop("kept")

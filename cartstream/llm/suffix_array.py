"""Byte runs that repeat across documents, by distributed prefix doubling.

A position's rank at some width names the bytes that follow it; the rank at twice the width comes from the pair of ranks at
the position and one width further. Spark sorts (rank, document) rows; who is alone in its class drops out, and the rest are
ranked again at a larger offset until they are unique or past the threshold. Three things keep this small:

- up to 16 bytes ranks are hashes, equal for equal bytes, so no exchange is needed;
- at 16 bytes only sampled positions are sorted, chosen by content so that each string of `width` bytes has one, and equal blocks of
  positions around a sampled one are ranked as one (`repeats`);
- only the first document of each class goes on. Spark sorts these blocks' bytes by their 16-byte rank; strings that are equal
  share it, so the pairs of ranks at `width` bytes are compared within a run of the sorted rows. Where a run is long, its
  pairs become rows of their own, which Spark sorts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.llm.common import id_and_text
from cartstream.llm.repeats import PAIRS, Blocks, Doubling, by_document, covered, listed, mark_blocks, member_keys, names, pair_rows
from cartstream.llm.textarrays import U, byte_values, flatten, mix
from cartstream.session import cut_lineage

GRAM = 16


def _hashes(data: np.ndarray) -> np.ndarray:
    return byte_values(7, False)[data]


def _pairs(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flatten(batch.column(1))
            yield pair_rows(batch.column(0), Blocks(_hashes(data), offsets, width, GRAM))

    return run


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its count."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _window_name(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * U(3) ^ mix(right)).view(np.int64)


def _block_bytes(width: int):
    """The bytes of the blocks that are to be compared: anchor, doc_id, bytes. Input: doc_id, text, whole, partly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flatten(batch.column(1))
            blocks = Blocks(_hashes(data), offsets, width, GRAM)
            own = member_keys(blocks.text, names(blocks.anchor, blocks.block))
            chosen = np.flatnonzero(np.isin(own, listed(batch.column(3))))
            chosen = chosen[np.unique(own[chosen], return_index=True)[1]]
            begin, sizes = blocks.start[chosen], blocks.count[chosen] + width - 1
            ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
            raw = np.ascontiguousarray(data[_spread(begin, sizes)])
            parts = pa.Array.from_buffers(pa.binary(), len(chosen), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
            ids = batch.column(0).to_numpy()[blocks.text[chosen]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks.anchor[chosen].view(np.int64)), pa.array(ids), parts], names=["anchor", "doc_id", "bytes"]
            )

    return run


CHUNK_ROWS = 8192
LONG_RUN = 1 << 18  # pairs of one anchor that a task keeps; those of a longer run are sorted by Spark
RESOLVED = "doc_id long, window long, left long, right long"
_NONE = np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int64)


def _classes(left: np.ndarray, right: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by (left, right, doc), and in that order which rows are the first of their rank pair."""
    order = np.lexsort((doc, right, left))
    opens = np.ones(len(order), bool)
    opens[1:] = (left[order][1:] != left[order][:-1]) | (right[order][1:] != right[order][:-1])
    return order, opens


def _resolve(width: int):
    """Of blocks sorted by (anchor, doc_id): the windows that an earlier document has.

    A row has either a window's name (found), or a rank pair (of a long run, for Spark to sort). Between chunks the
    windows of the last anchor are kept with their first document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, kept_anchor, long_run = _NONE, None, False
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                anchors = part.column(0).to_numpy()
                data, offsets = flatten(part.column(2))
                sizes = np.diff(offsets) - width + 1
                left, right = Doubling(_hashes(data)).pairs(width, _spread(offsets[:-1], sizes))
                rows = left, right, np.repeat(part.column(1).to_numpy(), sizes)
                anchor = np.repeat(anchors, sizes)
                if anchors[0] != kept_anchor:
                    kept, long_run = _NONE, False
                put_off = (anchor == anchors[0]) & long_run
                sent = [x[put_off] for x in rows]
                own = [np.concatenate([k, x[~put_off]]) for k, x in zip(kept, rows, strict=True)]
                order, opens = _classes(*own)
                first = own[2][order][np.maximum.accumulate(np.where(opens, np.arange(len(order)), 0))] if len(order) else own[2]
                found = order[own[2][order] != first]
                if anchors[-1] != kept_anchor:
                    kept_anchor, kept, long_run = anchors[-1], _NONE, False
                if not long_run:
                    last = [np.concatenate([k, x[anchor == kept_anchor]]) for k, x in zip(kept, rows, strict=True)]
                    order, opens = _classes(*last)
                    kept = tuple(x[order[opens]] for x in last)
                    if len(kept[0]) > LONG_RUN:
                        # From here on Spark compares this anchor's windows, the known ones among them.
                        sent = [np.concatenate([x, k]) for x, k in zip(sent, kept, strict=True)]
                        kept, long_run = _NONE, True
                n, m = len(found), len(sent[0])
                is_pair = np.arange(n + m) >= n
                window = np.append(_window_name(own[0][found], own[1][found]), np.zeros(m, np.int64))
                pair = [np.append(np.zeros(n, np.int64), x.view(np.int64)) for x in sent[:2]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(own[2][found], sent[2])), pa.array(window, mask=is_pair), *(pa.array(x, mask=~is_pair) for x in pair)],
                    names=["doc_id", "window", "left", "right"],
                )

    return run


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (left, right, doc_id): those whose class has a smaller document."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right, doc = (c.to_numpy() for c in batch.columns)
        opens = np.ones(len(left), bool)
        opens[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        if last is not None:
            opens[0] = (left[0], right[0]) != last[:2]
        lead = np.maximum.accumulate(np.where(opens, np.arange(len(left)), -1))
        first = np.where(lead >= 0, doc[np.maximum(lead, 0)], last[2] if last else 0)
        last = (left[-1], right[-1], first[-1])
        found = doc != first
        name = _window_name(left[found].view(U), right[found].view(U))
        yield pa.RecordBatch.from_arrays([pa.array(doc[found]), pa.array(name)], names=["doc_id", "window"])


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def _cut(width: int, keep: bool):
    """Input: doc_id, text, whole, partly, windows."""

    def gone_of(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        whole, partly, windows = (listed(batch.column(k)) for k in (2, 3, 4))
        if not len(whole) and not len(windows):
            return np.zeros(len(data), bool)
        hashes = _hashes(data)
        blocks = Blocks(hashes, offsets, width, GRAM)
        own = member_keys(blocks.text, names(blocks.anchor, blocks.block))
        all_of = np.isin(own, whole)
        starts, counts = blocks.start[all_of], blocks.count[all_of]
        some = np.flatnonzero(np.isin(own, partly))
        if len(windows) and len(some):
            at = _spread(blocks.start[some], blocks.count[some])
            text = np.repeat(blocks.text[some], blocks.count[some])
            found = np.zeros(len(at), bool)
            for k in range(0, len(at), 1 << 18):
                part = slice(k, k + (1 << 18))
                begin, end = at[part].min(), at[part].max() + width
                pair = Doubling(hashes[begin:end]).pairs(width, at[part] - begin)
                found[part] = np.isin(member_keys(text[part], _window_name(*pair)), windows)
            starts, counts = np.append(starts, at[found]), np.append(counts, np.ones(found.sum(), np.int64))
        return covered(len(data), starts, counts, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flatten(batch.column(1))
            gone = gone_of(batch, data, offsets)
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
            opens[firsts] = gone[firsts]
            removed, spans = (np.diff(np.append(0, np.cumsum(x))[offsets]) for x in (gone, opens))
            kept, digests = [], []
            for begin, end, n in zip(offsets[:-1].tolist(), offsets[1:].tolist(), removed.tolist(), strict=True):
                own = data[begin:end]
                raw = (own[~gone[begin:end]] if n else own).tobytes()
                kept.append(raw if keep else None)
                digests.append(hashlib.sha256(raw).hexdigest())
            numbers = [pa.array(c, pa.int64()) for c in (np.diff(offsets), removed, spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *numbers, pa.array(kept, pa.binary()), pa.array(digests, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    return run


def remove_repeated_bytes(docs: DataFrame, width: int = 50, keep: bool = True) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (with `keep`), kept_sha256.

    Removes each byte covered by a string of `width` bytes that also starts in a document with a smaller doc_id; strings are
    judged on the input. A null text is empty, shorter texts are kept. Rows of one doc_id are one document: none of them
    counts as smaller than the others, and each gives a row. A null doc_id is smaller than none: its text is kept whole and
    removes nothing. Other columns are ignored; an empty table gives none.

    `width` is 32 or more, so that a window always has a sampled position.
    """
    if width < 2 * GRAM:
        raise ValueError(f"width must be at least {2 * GRAM}")
    rows = id_and_text(docs)
    named = rows.filter("doc_id is not null")
    marks = cut_lineage(by_document(mark_blocks(named.mapInArrow(_pairs(width), PAIRS))), compression="zstd")
    # The texts and marks are joined twice, over the same columns, so that both joins share their exchanges.
    texts = named.join(marks, "doc_id", "left").select("doc_id", "text", "whole", "partly")
    blocks = texts.filter(F.size("partly") > 0).mapInArrow(_block_bytes(width), "anchor long, doc_id long, bytes binary")
    resolved = blocks.repartition("anchor").sortWithinPartitions("anchor", "doc_id").mapInArrow(_resolve(width), RESOLVED)
    put_off = resolved.filter("left is not null").select("left", "right", "doc_id")
    later = put_off.repartition("left", "right").sortWithinPartitions("left", "right", "doc_id").mapInArrow(_later, "doc_id long, window long")
    windows = (
        resolved.filter("window is not null").select("doc_id", "window").unionByName(later)
        .groupBy("doc_id").agg(F.collect_set("window").alias("windows"))
    )
    none = F.lit(None).cast("array<long>")
    whole = texts.join(windows, "doc_id", "left").select("doc_id", "text", "whole", "partly", "windows")
    nameless = rows.filter("doc_id is null").select("doc_id", "text", none.alias("whole"), none.alias("partly"), none.alias("windows"))
    out = whole.unionByName(nameless).mapInArrow(_cut(width, keep), SCHEMA)
    return out if keep else out.drop("kept")

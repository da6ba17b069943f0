"""Runs that repeat across documents: what the byte and the word operator share.

Every window of a fixed width has an anchor: the place of its smallest hashed k-gram. Neighbouring windows mostly
share theirs; such a run of windows is a block. Equal text around a place has equal anchors and, but for the ends of a passage,
equal blocks. Each document sends its distinct (anchor, block) pairs, Spark sorts them, and one look at each sorted
partition tells what is repeated:

- a block that an earlier document (smaller doc_id) has too is repeated as a whole;
- a block whose anchor occurs with other blocks too may repeat in part: the first document of each such block is sent on,
  and its windows are compared one by one;
- all else is unique and drops out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.llm.textarrays import U, mix, window_minimum

_INDEX = U(0xFFFFFFFF)
_LEFT, _RIGHT = U(0xC2B2AE3D27D4EB4F), U(0x9FB21C651E98DF25)
PIECE = 1 << 18  # symbols looked at together; longer texts are looked at piece by piece


class Doubling:
    """Ranks of the runs of a power-of-two width, each from the pair of ranks of its halves; other widths from two overlapping runs."""

    def __init__(self, hashes: np.ndarray):
        self.levels = {1: hashes}

    def level(self, width: int) -> np.ndarray:
        if width not in self.levels:
            half = self.level(width // 2)
            self.levels[width] = self._pair(half[: len(half) - width // 2], half[width // 2 :])
        return self.levels[width]

    @staticmethod
    def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        right = right ^ (right >> U(32))
        right *= _RIGHT
        right += left * _LEFT
        return right

    def runs(self, width: int) -> np.ndarray:
        """Ranks of all runs of `width`."""
        power = 1 << (width.bit_length() - 1)
        own, shift = self.level(power), width - power
        return self._pair(own[: len(own) - shift], own[shift:]) if shift else own

    def pairs(self, width: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two ranks that name the runs of `width` at some places."""
        power = 1 << (width.bit_length() - 1)
        own = self.level(power)
        return own[at], own[at + width - power]


def pieces(first: np.ndarray, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts texts into parts of bounded size that have each window once: begin, end, text numbers, begin of each text's part."""
    at, texts = 0, len(first) - 1
    while at < texts:
        stop = int(np.searchsorted(first, first[at] + PIECE, side="right")) - 1
        if stop > at:
            yield int(first[at]), int(first[stop]), np.arange(at, stop), first[at : stop + 1] - first[at]
            at = stop
            continue
        for begin in range(int(first[at]), int(first[at + 1]), PIECE):
            end = min(begin + PIECE + width - 1, int(first[at + 1]))
            yield begin, end, np.array([at]), np.array([0, end - begin])
        at += 1


class Blocks:
    """The blocks of some symbol sequences: text number, first window, number of windows, anchor and block hash.

    Where a long text is cut into pieces a block may be cut too; it then is another block of the same anchor, and its windows are
    compared one by one.
    """

    FIELDS = ("text", "start", "count", "anchor", "block")

    def __init__(self, hashes: np.ndarray, first: np.ndarray, width: int, gram: int):
        found: list[tuple[np.ndarray, ...]] = []
        for begin, end, texts, own in pieces(first, width):
            ranks = Doubling(hashes[begin:end])
            part = self._find(ranks, end - begin, own, width, gram)
            if part is not None:
                text, start, *rest = part
                found.append((texts[text], start + begin, *rest))
        kinds = (np.int64, np.int64, np.int64, U, U)
        for k, (name, kind) in enumerate(zip(self.FIELDS, kinds, strict=True)):
            setattr(self, name, np.concatenate([f[k] for f in found]) if found else np.zeros(0, kind))

    @staticmethod
    def _find(ranks: Doubling, size: int, first: np.ndarray, width: int, gram: int):
        n = size - width + 1
        inside = np.maximum(0, np.diff(first) - width + 1)
        if n <= 0 or not inside.any():
            return None
        begins = first[:-1][inside > 0]
        edges = np.zeros(n + 1, np.int8)
        edges[begins] += 1
        edges[begins + inside[inside > 0]] -= 1
        valid = np.cumsum(edges, dtype=np.int8)[:n] > 0
        keys = ranks.runs(gram)
        packed = (keys & ~_INDEX) | np.arange(len(keys), dtype=U)
        place = window_minimum(packed, width - gram + 1) & _INDEX
        opens = valid.copy()
        opens[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
        start = np.flatnonzero(opens)
        text = np.searchsorted(first, start, side="right") - 1
        # A block ends before the next one, or with the last window of its text.
        count = np.minimum(np.append(start[1:], n), first[text] + inside[text]) - start
        anchor = place[start].astype(np.int64)
        # The first and the last window have all symbols of the block.
        name = np.zeros(len(start), U)
        for rank in (*ranks.pairs(width, start), *ranks.pairs(width, start + count - 1), (count * 65536 + anchor - start).astype(U)):
            name = mix(name * _LEFT + rank)
        return text, start, count, mix(keys[anchor]), name


HALF = U(48)


def packed(anchor: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48 bits of the anchor and 48 of the block in a long and an int: what is sorted, in as few bytes as do."""
    rest = block >> (U(64) - HALF)
    return ((anchor >> (U(64) - HALF)) << U(16) | rest >> U(32)).view(np.int64), (rest & _INDEX).astype(np.uint32).view(np.int32)


def names(anchor: np.ndarray, block: np.ndarray) -> np.ndarray:
    """One number that names a block within its document."""
    high, low = packed(anchor, block)
    return name_of(high, low)


def name_of(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix(high.view(U) * _LEFT + low.view(np.uint32).astype(U)).view(np.int64)


def pair_rows(doc_ids: pa.Array, blocks: Blocks) -> pa.RecordBatch:
    """The distinct (anchor, block) pairs of each document of a batch."""
    ids = doc_ids.to_numpy(zero_copy_only=False)
    high, low = packed(blocks.anchor, blocks.block)
    order = np.lexsort((low, high, blocks.text))
    text, high, low = blocks.text[order], high[order], low[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    return pa.RecordBatch.from_arrays(
        [pa.array(high[fresh]), pa.array(low[fresh]), pa.array(ids[text[fresh]].astype(np.int64))], names=["high", "low", "doc_id"]
    )


PAIRS = "high long, low int, doc_id long"
WHOLE, PARTLY = 0, 1
MARKS = "doc_id long, block long, mark int"


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks sorted (high, low, doc_id) rows: copies of an earlier document's block, and first blocks of mixed anchors.

    Keeps one row between batches, and the first blocks of the present anchor that wait for a second one: one at most.
    """
    anchor = block = doc = None  # of the row before
    waiting: tuple[int, int] | None = None  # document and name of the anchor's only block so far
    for batch in batches:
        if not batch.num_rows:
            continue
        high, low, d = (c.to_numpy() for c in batch.columns)
        a, b = high >> 16, name_of(high, low)
        prior_a = np.append(a[0] if anchor is None else anchor, a[:-1])
        prior_b = np.append(b[0] if block is None else block, b[:-1])
        new_anchor, new_block = a != prior_a, (a != prior_a) | (b != prior_b)
        if anchor is None:
            new_anchor[0] = new_block[0] = True
        # The first document of each row's block.
        lead = np.maximum.accumulate(np.where(new_block, np.arange(len(a)), -1))
        first_doc = np.where(lead >= 0, d[np.maximum(lead, 0)], doc if doc is not None else 0)
        copies = ~new_block & (d != first_doc)
        doc = int(first_doc[-1])
        # Blocks of an anchor that has several.
        leads = np.flatnonzero(new_block)
        group = np.cumsum(new_anchor)[leads]
        # The anchor of the batch before goes on with another block: its blocks are mixed.
        goes_on = len(leads) > 0 and group[0] == 0
        carried = goes_on and waiting is not None
        mixed = np.bincount(group)[group] > 1 if len(leads) else np.zeros(0, bool)
        if goes_on:
            mixed[group == 0] = True
        partly = leads[mixed]
        docs, blocks = [d[copies], d[partly]], [b[copies], b[partly]]
        marks = [np.full(copies.sum(), WHOLE, np.int32), np.full(len(partly), PARTLY, np.int32)]
        if carried:
            docs.append(np.array([waiting[0]]))
            blocks.append(np.array([waiting[1]]))
            marks.append(np.array([PARTLY], np.int32))
        if len(leads):
            waiting = None if mixed[-1] else (int(d[leads[-1]]), int(b[leads[-1]]))
        anchor, block = a[-1], b[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x)) for x in (docs, blocks, marks)], names=["doc_id", "block", "mark"]
        )


def mark_blocks(pairs: DataFrame) -> DataFrame:
    """doc_id, block (its name), mark for the rows of `pair_rows`.

    WHOLE: an earlier document has the block. PARTLY: the first document of a block whose anchor has other blocks too. A
    document has a pair once at most, so the most frequent anchor has as many rows as there are documents with it; they
    are read in order, one batch at a time, never gathered.
    """
    dealt = pairs.repartition(F.shiftright("high", 16))
    return dealt.sortWithinPartitions("high", "low", "doc_id").mapInArrow(_mark, MARKS)


def by_document(marks: DataFrame) -> DataFrame:
    """doc_id with its repeated blocks (`whole`) and blocks to compare (`partly`): as many as the document has, at most."""
    return marks.groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("mark") == WHOLE, F.col("block"))).alias("whole"),
        F.collect_list(F.when(F.col("mark") == PARTLY, F.col("block"))).alias("partly"),
    )


def covered(n: int, starts: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """Which of n symbols lie in one of the windows that begin in [start, start + count)."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + counts - 1 + width, n), -1)
    return np.cumsum(edges)[:n] > 0


def member_keys(text: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values that stay apart when they belong to different texts of a batch."""
    return mix(values.view(U) + text.astype(U) * _RIGHT)


def listed(column: pa.Array) -> np.ndarray:
    """`member_keys` of a list column, one list for each text; null lists have none."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), pa.compute.list_value_length(column).fill_null(0).to_numpy()
    return member_keys(np.repeat(np.arange(len(column)), sizes), flat) if len(flat) else np.zeros(0, U)

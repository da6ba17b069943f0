"""Word runs that repeat across documents, by repeated-phrase automata.

1. Blocks of windows that an earlier document has too are found by sorting (`repeats`); copies inherit what their block's first
   document gets.
2. Blocks that share an anchor with other blocks are the places where passages begin, end or differ. Their texts are dealt to
   shards by anchor. In a shard the windows that occur in several texts are confirmed word by word and compiled into an
   Aho-Corasick automaton; all texts of the shard are streamed through it, which locates every occurrence.

A window's anchor follows from its words, so all its occurrences meet in one shard, and no document has to visit the
others. An anchor with very many blocks is split into shards of windows, by their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartstream.llm.common import doc_id
from cartstream.llm.repeats import PAIRS, Blocks, by_document, covered, listed, mark_blocks, member_keys, names, pair_rows
from cartstream.llm.textarrays import Words, flatten
from cartstream.session import cut_lineage

GRAM = 5
AUTOMATON_TEXTS = 4096
HOT_BLOCKS = 2048


def _pairs(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(*flatten(batch.column(1)), fold=False)
            yield pair_rows(batch.column(0), Blocks(words.hash, words.first, width, GRAM))

    return run


def _block_texts(width: int):
    """The words of the blocks that are to be compared, each word between single spaces. Input: doc_id, text, whole, partly, carried."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flatten(batch.column(1))
            words = Words(data, offsets, fold=False)
            blocks = Blocks(words.hash, words.first, width, GRAM)
            own = names(blocks.anchor, blocks.block)
            keys = member_keys(blocks.text, own)
            chosen = np.flatnonzero(np.isin(keys, listed(batch.column(3))))
            chosen = chosen[np.unique(keys[chosen], return_index=True)[1]]
            raw, texts = data.tobytes(), []
            starts, stops = words.start.tolist(), words.stop.tolist()
            for first, count in zip(blocks.start[chosen].tolist(), blocks.count[chosen].tolist(), strict=True):
                span = range(first, first + count + width - 1)
                texts.append(b" ".join([b"", *[raw[starts[w] : stops[w]] for w in span], b""]).decode())
            ids = batch.column(0).to_numpy()[blocks.text[chosen]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks.anchor[chosen].view(np.int64)), pa.array(own[chosen]), pa.array(ids), pa.array(texts, pa.string())],
                names=["anchor", "block", "doc_id", "words"],
            )

    return run


def _windows_of(text: str, width: int) -> list[tuple[int, str]]:
    """Where each window of a block's text begins, and the window with a space at either end."""
    spaces = [k for k, c in enumerate(text) if c == " "]
    return [(spaces[k], text[spaces[k] : spaces[k + width] + 1]) for k in range(len(spaces) - width)]


def _split_hot(width: int):
    """Texts as they are, or one row per window with a shard of its own where the anchor has very many blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for anchor, block, doc, text, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shards = -(-n // HOT_BLOCKS)
                if shards == 1:
                    rows.append((anchor, 0, block, doc, 0, text))
                else:
                    for k, (_, window) in enumerate(_windows_of(text, width)):
                        shard = int.from_bytes(hashlib.blake2b(window.encode(), digest_size=8).digest()) % shards
                        rows.append((anchor, shard, block, doc, k, window))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["anchor", "shard", "block", "doc_id", "at", "words"],
            )

    return run


FOUND = "doc_id long, block long, mask long"


def _locate(width: int):
    """Streams the texts of sorted shards through automata of their confirmed phrases.

    Texts come by document within a shard, so a phrase's first text has its smallest document. A batch of texts is one
    automaton; where a shard is cut by the end of a batch, the first documents of its windows are carried on.
    """

    def occurrences(rows: list[tuple], earliest: dict[str, int]) -> list[tuple[int, int, int]]:
        confirmed: set[str] = set()
        for _, doc, _, text in rows:
            for _, window in _windows_of(text, width):
                if earliest.setdefault(window, doc) != doc:
                    confirmed.add(window)
        if not confirmed:
            return []
        automaton = ahocorasick.Automaton()
        for window in confirmed:
            automaton.add_word(window, (earliest[window], len(window)))
        automaton.make_automaton()
        out = []
        for block, doc, at, text in rows:
            mask, places = 0, None
            for end, (first, length) in automaton.iter(text):
                if first < doc:
                    if places is None:
                        places = {begin: k for k, (begin, _) in enumerate(_windows_of(text, width))}
                    mask |= 1 << (at + places[end - length + 1])
            if mask:
                out.append((doc, block, mask))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        since = 0  # where the texts of the present shard begin in rows
        shard = None
        earliest: dict[str, int] = {}

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal earliest, since
            columns = list(zip(*occurrences(rows, earliest), strict=True)) or [()] * 3
            if not last:
                if since:
                    own = {window for _, _, _, text in rows[since:] for _, window in _windows_of(text, width)}
                    earliest = {window: earliest[window] for window in own}
                since = 0
                rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "block", "mask"])

        for batch in batches:
            for anchor, own, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(rows) >= AUTOMATON_TEXTS:
                    yield flush(last=False)
                if (anchor, own) != shard:
                    shard, since = (anchor, own), len(rows)
                rows.append(tuple(row))
        yield flush(last=True)

    return run


def _cut(width: int):
    """Input: doc_id, text, whole, partly, carried, parts."""

    def gone_of(batch: pa.RecordBatch, words: Words) -> np.ndarray:
        whole, parts = listed(batch.column(2)), batch.column(5)
        flat = parts.flatten()
        if not len(whole) and not len(flat):
            return np.zeros(len(words.start), bool)
        blocks = Blocks(words.hash, words.first, width, GRAM)
        keys = member_keys(blocks.text, names(blocks.anchor, blocks.block))
        all_of = np.isin(keys, whole)
        starts, counts = blocks.start[all_of], blocks.count[all_of]
        if len(flat):
            sizes = pa.compute.list_value_length(parts).fill_null(0).to_numpy()
            named = member_keys(np.repeat(np.arange(len(parts)), sizes), flat.field("block").to_numpy())
            masks = flat.field("mask").to_numpy()
            # A block's masks from several shards add up.
            order = np.argsort(named, kind="stable")
            firsts = np.flatnonzero(np.append(True, named[order][1:] != named[order][:-1]))
            known, merged = named[order][firsts], np.bitwise_or.reduceat(masks[order], firsts)
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            some = np.flatnonzero(known[at] == keys)
            for j in range(int(blocks.count[some].max(initial=0))):
                hit = some[(merged[at[some]] >> j & 1 > 0) & (j < blocks.count[some])]
                starts, counts = np.append(starts, blocks.start[hit] + j), np.append(counts, np.ones(len(hit), np.int64))
        return covered(len(words.start), starts, counts, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flatten(batch.column(1))
            words = Words(data, offsets, fold=False)
            gone = gone_of(batch, words)
            # A removed word takes the white space behind it along, up to the next word or the end of its text.
            behind = np.append(words.start[1:], len(data))
            last = words.first[1:][words.first[1:] > words.first[:-1]] - 1
            behind[last] = offsets[1:][words.first[1:] > words.first[:-1]]
            edges = np.zeros(len(data) + 1, np.int8)
            np.add.at(edges, words.start[gone], 1)
            np.add.at(edges, behind[gone], -1)
            stays = np.cumsum(edges, dtype=np.int8)[:-1] == 0
            removed = np.diff(np.append(0, np.cumsum(gone))[words.first])
            rows: list[tuple] = []
            for k, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                own = data[begin:end]
                text = (own[stays[begin:end]] if removed[k] else own).tobytes()
                # The words that stay are those of the text that stays.
                kept = b" ".join(text.split())
                rows.append((kept.decode(), hashlib.sha256(kept).hexdigest(), text.decode()))
            kept, digests, texts = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(words.first)), pa.array(removed), pa.array(kept, pa.string()), pa.array(digests, pa.string()),
                 pa.array(texts, pa.string()), batch.column(4)],
                names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256", "text", "carried"],
            )

    return run


def remove_repeated_words(docs: DataFrame, width: int = 13, carry: Sequence[str] = ()) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept (words joined by one space), kept_sha256, text (what is left of it), carried.

    carried is a struct of the columns named by `carry`, unchanged.

    Removes each word covered by a window of `width` words that also starts in a document with a smaller doc_id; windows
    are judged on the input. A null text has no words, shorter texts are kept. Rows of one doc_id are one document: none of them
    counts as smaller than the others, and each gives a row. A null doc_id is smaller than none: its text is
    kept whole and removes nothing. Other columns are ignored; an empty table gives none.
    """
    if width < GRAM + 1 or width > 2 * GRAM + 50:
        raise ValueError(f"width must be between {GRAM + 1} and {2 * GRAM + 50}")
    rows = docs.select(
        doc_id(docs), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.struct(F.lit(True).alias("row"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(carry)]).alias("carried"),
    )
    named = rows.filter("doc_id is not null")
    pairs = named.select("doc_id", "text").mapInArrow(_pairs(width), PAIRS)
    marks = cut_lineage(by_document(mark_blocks(pairs)), compression="zstd")
    texts = named.join(marks, "doc_id", "left").select("doc_id", "text", "whole", "partly", "carried")
    compared = cut_lineage(
        texts.filter(F.size("partly") > 0).mapInArrow(_block_texts(width), "anchor long, block long, doc_id long, words string"),
        compression="zstd",
    )
    sizes = compared.groupBy("anchor").agg(F.count("*").alias("n"))
    shards = compared.join(sizes, "anchor").select("anchor", "block", "doc_id", "words", "n").mapInArrow(
        _split_hot(width), "anchor long, shard int, block long, doc_id long, at int, words string"
    )
    found = (
        shards.repartition("anchor", "shard").sortWithinPartitions("anchor", "shard", "doc_id")
        .mapInArrow(_locate(width), FOUND).groupBy("doc_id").agg(F.collect_list(F.struct("block", "mask")).alias("parts"))
    )
    whole = texts.join(found, "doc_id", "left").select("doc_id", "text", "whole", "partly", "carried", "parts")
    none = F.lit(None).cast("array<long>")
    nameless = rows.filter("doc_id is null").select(
        "doc_id", "text", none.alias("whole"), none.alias("partly"), "carried", F.lit(None).cast("array<struct<block:long,mask:long>>").alias("parts")
    )
    result = StructType([
        *StructType.fromDDL("doc_id long, n_words long, n_removed long, kept string, kept_sha256 string, text string"),
        rows.schema["carried"],
    ])
    out = whole.unionByName(nameless).mapInArrow(_cut(width), result)
    return out.withColumn("carried", F.struct(*[F.col("carried")[f"c{k}"].alias(c) for k, c in enumerate(carry)]) if carry else F.lit(None))

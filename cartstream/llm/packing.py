"""Concatenate and cut: documents as one token stream, cut into sequences of a fixed width.

Pass 1 tokenizes and keeps, for each input partition, the running offset of its documents. Pass 2 turns the token
totals of the partitions into global offsets by a prefix sum and cuts the stream at the multiples of the width; a
document that crosses a cut becomes several boundary records. Only the last sequence needs padding.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartstream.session import cut_lineage

# The file README's splitting pattern; fixed by the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Letters beyond these blocks may be classed differently by the two libraries' Unicode tables.
_UNUSUAL = regex.compile(r"[^\x00-ɏͰ-ӿ -⁯₠-₿]")


class ByteBPE:
    """Ids of a byte-level BPE vocabulary given both as a `tokenizers` file and as a rank file.

    The rank file is read by the faster library, which gives the same ids; texts with unusual characters
    go to the `tokenizers` file itself.
    """

    def __init__(self, json_path: str, ranks_path: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(json_path)
        self.exact.encode_special_tokens = True

    def encode(self, text: str) -> list[int]:
        if _UNUSUAL.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


_LOADED: dict[tuple[str, str], ByteBPE] = {}


def tokenizer(json_path: str, ranks_path: str) -> ByteBPE:
    """One tokenizer per Python worker and vocabulary."""
    if (json_path, ranks_path) not in _LOADED:
        _LOADED[json_path, ranks_path] = ByteBPE(json_path, ranks_path)
    return _LOADED[json_path, ranks_path]


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def tokenize(docs: DataFrame, json_path: str, ranks_path: str, end_id: int) -> DataFrame:
    """doc_id, part (input partition), at (tokens of the partition before the document), n, ids (32-bit, little-endian)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, at = tokenizer(json_path, ranks_path), 0
        for batch in batches:
            starts, sizes, ids = [], [], []
            for text in batch.column(1).to_pylist():
                own = bpe.encode(text or "")
                own.append(end_id)
                starts.append(at)
                sizes.append(len(own))
                ids.append(np.asarray(own, "<u4").tobytes())
                at += len(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(ids, pa.binary())],
                names=["doc_id", "part", "at", "n", "ids"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.spark_partition_id().alias("part"))
    return rows.mapInArrow(run, "doc_id long, part int, at long, n long, ids binary")


def pack(
    docs: DataFrame, json_path: str, ranks_path: str, width: int = 2048, end_id: int = 1, with_ids: bool = True
) -> DataFrame:
    """Pieces of documents and their places in sequences of `width` tokens.

    Returns per piece: doc_id, start (ids of its document before it), length, ids_crc32, doc_tokens,
    sequence_id, offset, and with `with_ids` the ids themselves. Each document ends with `end_id`, so an empty or
    null text is one token. A null doc_id stays null; repeated rows are packed each; other columns are ignored;
    an empty table gives no pieces.

    The tokens are written once to the checkpoint folder, which also fixes the order inside partitions for retried tasks.
    The broadcast offsets are one row per input partition, whatever the number of documents.
    """
    tokens = cut_lineage(tokenize(docs, json_path, ranks_path, end_id), compression="zstd")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        tokens.groupBy("part").agg(F.sum("n").alias("total"))
        .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).cast("long").alias("base"))
    )
    placed = tokens.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("place"), "ids"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, place, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total, done = len(ids) // 4, 0
                while done < total:
                    sequence, offset = divmod(place + done, width)
                    length = min(width - offset, total - done)
                    piece = ids[4 * done : 4 * (done + length)]
                    rows.append((doc, done, length, zlib.crc32(piece), total, sequence, offset, piece if with_ids else None))
                    done += length
            kinds = [pa.int64()] * 7 + [pa.binary()]
            columns = list(zip(*rows, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    pieces = placed.mapInArrow(cut, PIECES)
    return pieces if with_ids else pieces.drop("ids")

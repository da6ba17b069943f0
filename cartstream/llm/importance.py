"""Importance resampling towards a target: documents drawn by the ratio of hashed word counts, ranked by a radix sort.

Words and runs of words are counted by the remainder of their CRC, over all documents and over the target. The log ratio of each
bucket is one array of fixed size, and a document weighs what its features' entries add up to. Weights with Gumbel noise are drawn
from the top, which is sampling without replacement.

The order comes from a radix sort of the composite key (score down, id up), from the least digit to the greatest. Rows stand at
positions, cut into blocks of fixed size. A pass counts the rows of each digit in each block; prefix sums over digits, then
blocks, give where each of these runs goes, and a row's place in its run is its place in the block. So every pass is stable and
no task holds more than its share of blocks. After the last pass the position is the rank.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartstream.llm.common import id_and_text
from cartstream.session import cut_lineage, scratch

BUCKETS = 10_000
DIGIT_BITS = 11
BLOCK = 1 << 18  # rows of a block
PIECE = 1 << 20  # bytes of a text split into words at once
MEMO = 1 << 18  # features whose bucket a task remembers

# A-Z become a-z; bytes outside 0-9, a-z and UTF-8's upper half part words.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


class BucketOf(dict):
    """Bucket of a feature, remembered; the whole memory is dropped when full."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[feature] = out = zlib.crc32(feature) % self.buckets
        return out


def word_lists(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    letters, at = raw.translate(_LETTERS), 0
    while at < len(letters):
        end = letters.find(b" ", at + PIECE)
        end = len(letters) if end < 0 else end
        yield letters[at:end].split()
        at = end


def feature_lists(raw: bytes, longest: int, of: BucketOf) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in them) for each part of a text."""
    tail: list[bytes] = []
    for words in word_lists(raw):
        lists = [words]
        for k in range(2, longest + 1):
            joined = tail[len(tail) - k + 1 :] + words if len(tail) >= k - 1 else tail + words
            lists.append([b" ".join(joined[i : i + k]) for i in range(len(joined) - k + 1)])
        tail = (tail + words)[-(longest - 1) :] if longest > 1 else tail
        features = lists[0] if longest == 1 else [f for own in lists for f in own]
        yield len(words), np.fromiter(map(of.__getitem__, features), np.int64, len(features))


def bucket_counts(texts: DataFrame, buckets: int, longest: int) -> np.ndarray:
    """Features in each bucket over all texts. Each task sends at most `buckets` counts, and so does the sum to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = BucketOf(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, found in feature_lists((text or "").encode(), longest, of):
                    if len(found) > buckets:
                        total += np.bincount(found, minlength=buckets)
                    else:
                        np.add.at(total, found, 1)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    counts = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counts.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the corpus."""
    size = len(corpus)
    all_s, all_t = float(corpus.sum() + size), float(target.sum() + size)
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * all_s / ((float(s) + 1) * all_t)))
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    ], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """The document's Gumbel noise, in thousandths; a null id draws as the word null."""
    h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORED = "doc_id long, n_features long, weight long, score long, part int, at long"


def score_documents(docs: DataFrame, gain: np.ndarray, longest: int, min_words: int, seed: int) -> DataFrame:
    """doc_id, n_features, weight, score, part (input partition) and `at`: place among its documents of enough words, else null."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, place = BucketOf(buckets), 0
        for batch in batches:
            ids, n_features, weights, scores, places = batch.column(0).to_pylist(), [], [], [], []
            for doc, text in zip(ids, batch.column(1).to_pylist(), strict=True):
                words = features = weight = 0
                for n, found in feature_lists(text.encode(), longest, of):
                    words, features, weight = words + n, features + len(found), weight + int(gain[found].sum())
                n_features.append(features)
                weights.append(weight)
                scores.append(weight + noise(doc, seed))
                places.append(place if words >= min_words else None)
                place += words >= min_words
            numbers = [pa.array(c, pa.int64()) for c in (ids, n_features, weights, scores)]
            yield pa.RecordBatch.from_arrays(
                [*numbers, batch.column(2), pa.array(places, pa.int64())], names=["doc_id", "n_features", "weight", "score", "part", "at"]
            )

    return id_and_text(docs).withColumn("part", F.spark_partition_id()).mapInArrow(run, SCORED)


def _digits(value: Column) -> list[Column]:
    """A signed number's digits from the least, ordered as the number is."""
    unsigned = value.bitwiseXOR(F.lit(-(1 << 63)))
    return [
        F.shiftrightunsigned(unsigned, k).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)) for k in range(0, 64, DIGIT_BITS)
    ]


def radix_pass(rows: DataFrame, digit: Column, block: int) -> DataFrame:
    """Rows with `pos` moved to their places in the stable order of one digit.

    The windows hold one row per digit, one per block, and the rows of one digit in one block.
    """
    dealt = rows.select("*", digit.cast("int").alias("_digit"), F.floor(F.col("pos") / block).alias("_block"))
    runs = dealt.groupBy("_digit", "_block").agg(F.count("*").alias("_n"))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = runs.groupBy("_digit").agg(F.sum("_n").alias("_n")).select("_digit", before(Window.orderBy("_digit")).alias("_base"))
    offsets = (
        runs.select("_digit", "_block", before(Window.partitionBy("_digit").orderBy("_block")).alias("_before"))
        .join(F.broadcast(bases), "_digit")  # at most 2 ** DIGIT_BITS rows
        .select("_digit", "_block", (F.col("_base") + F.col("_before")).alias("_to"))
    )
    inside = F.row_number().over(Window.partitionBy("_block", "_digit").orderBy("pos"))
    kept = [c for c in rows.columns if c != "pos"]
    return (
        dealt.withColumn("_nth", inside).join(offsets, ["_block", "_digit"])
        .select((F.col("_to") + F.col("_nth") - 1).alias("pos"), *kept)
    )


def radix_ranked(rows: DataFrame, digits: list[Column], block: int = BLOCK) -> DataFrame:
    """`rows`, whose `pos` is 0, 1, 2… in any order, with `pos` as in the order of the digits, the least one first.

    Digits that are the same in all rows need no pass. Every pass is written to the checkpoint folder, so a lost executor costs one pass.
    """
    if not digits:
        return rows
    low_high = rows.agg(*[f(d).alias(f"{n}{k}") for k, d in enumerate(digits) for n, f in (("low", F.min), ("high", F.max))]).first()
    held = None
    for k, digit in enumerate(digits):
        if low_high[f"low{k}"] == low_high[f"high{k}"]:
            continue
        moved = scratch(radix_pass(rows, digit, block), compression="zstd")
        if held is not None:
            held.drop()
        held, rows = moved, moved.df
    return rows


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, longest: int = 1, buckets: int = BUCKETS,
    seed: int = 2024, block: int = BLOCK,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is null for those that are not drawn.

    `target` is a table with a text column. Of the N documents of at least `min_words` words floor(percent N / 100) are drawn, the highest
    scores first, equal ones by smaller doc_id, a null doc_id last; repeated rows of one doc_id are separate documents, whose
    order among equals is arbitrary. A null text has no words; without target texts all gains follow from the corpus
    alone; an empty table gives no rows; other columns are ignored.
    """
    own, wanted = id_and_text(docs), target.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    gain = gains(bucket_counts(own, buckets, longest), bucket_counts(wanted, buckets, longest))
    scored = cut_lineage(score_documents(docs, gain, longest, min_words, seed), compression="zstd")
    result = ["doc_id", "n_features", "weight", "score"]

    enough = scored.filter("at IS NOT NULL")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        enough.groupBy("part").agg(F.count("*").alias("_n"))
        .select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    )
    # One row per input partition, whatever the number of documents.
    placed = enough.join(F.broadcast(bases), "part").select((F.col("_base") + F.col("at")).alias("pos"), *result)
    score_down = _digits(F.bitwise_not(F.col("score")))
    digits = [*_digits(F.coalesce(F.col("doc_id"), F.lit(0))), F.col("doc_id").isNull().cast("int"), *score_down]
    ranked = radix_ranked(placed, digits, block)
    drawn = enough.count() * percent // 100
    rank = F.when(F.col("pos") < drawn, F.col("pos") + 1)
    return ranked.select(*result, rank.alias("rank")).unionByName(
        scored.filter("at IS NULL").select(*result, F.lit(None).cast("long").alias("rank"))
    )

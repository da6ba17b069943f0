"""Near-duplicate documents by bottom-k sketches from one hash function.

A sketch is the k smallest hashes of a document's shingles. Two documents that are similar enough share at least a
known part of their sketches, so it suffices to put the rarest values of each sketch, rarest in the corpus, into inverted lists:
similar documents meet in a list. Documents that are chained by lists form a family; a family is cut into blocks of bounded
size, and pairs of blocks are compared in tasks of their own: the sketch of the union estimates the similarity, and where
it may be enough the full shingle sets decide. Links leave a task as a spanning forest, never as all pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartstream.llm.common import id_and_text
from cartstream.llm.components import connected_components
from cartstream.llm.textarrays import U, Words, flatten, grams, mix
from cartstream.session import cut_lineage

SHINGLE = 5
SKETCH = 96
MISSED = 1e-4  # how rarely a pair just at the threshold may share less of its sketches than is asked for
MOST_ASKED = 0.6


def least_shared(percent: int) -> float:
    """The part of their sketches that pairs of `percent` similarity are asked to share, by the binomial tail over SKETCH values.

    Never more than 0.6: at 0.85 less than 1e-7 of the pairs share less, at 0.8 less than 1e-4; more similar ones are rarer still.
    """
    p, below, k = percent / 100, 0.0, 0
    while k < SKETCH:
        below += math.comb(SKETCH, k) * p**k * (1 - p) ** (SKETCH - k)
        if below > MISSED:
            break
        k += 1
    return min(MOST_ASKED, k / SKETCH)


BLOCK_DOCS = 128
BLOCK_SHINGLES = 1 << 18


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle, a blank one none."""
    data, offsets = flatten(column)
    words = Words(data, offsets, fold=True)
    hashes = grams(words.hash, SHINGLE)
    out = []
    for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        n = last - first
        if n >= SHINGLE:
            out.append(np.unique(hashes[first : last - SHINGLE + 1]))
        elif n:
            out.append(grams(words.hash[first:last], n) ^ U(n))
        else:
            out.append(np.zeros(0, U))
    return out


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, sketches = [], ([], []), []
        for values in shingle_sets(batch.column(1)):
            sizes.append(len(values))
            # Two independent sums name the set.
            keys[0].append(int(np.add.reduce(mix(values + U(1)), dtype=U).view(np.int64)))
            keys[1].append(int(np.add.reduce(mix(values ^ U(0x5851F42D4C957F2D)), dtype=U).view(np.int64)))
            sketches.append(values[:SKETCH].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys[0], pa.int64()), pa.array(keys[1], pa.int64()),
             pa.array(sketches, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "key1", "key2", "sketch"],
        )


def _families(classes: DataFrame, least: float) -> DataFrame:
    """rep, family: documents whose sketches may share enough, chained through inverted lists of rare values."""
    values = classes.select("rep", "key1", "key2", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    lists = values.groupBy("value").agg(F.count("*").alias("n")).filter("n > 1")
    shared = values.join(lists, "value")
    # Values of one document only cannot meet; they come first in its order, so they use up places.
    own = Window.partitionBy("rep", "key1", "key2")
    rarest = own.orderBy("n", "value")
    indexed = (
        shared.withColumn("k", F.row_number().over(rarest)).withColumn("c", F.count("*").over(own))
        .filter(F.col("k") <= F.col("c") - F.ceil(F.col("size") * F.lit(least)) + 1)
    )
    heads = indexed.groupBy("value").agg(F.min("rep").alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n")
    chains = indexed.join(heads, "value").filter("rep != head").select("rep", "head").distinct()
    return connected_components(chains, "rep", "head").withColumnsRenamed({"node": "rep", "component": "family"})


def _links(percent: int):
    """Compares the documents of one tile; gives each linked document with the smallest one it reaches in the tile."""
    least = least_shared(percent)

    def incidence(sets: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
        out = np.zeros((len(sets), len(vocabulary)), np.float32)
        for row, values in enumerate(sets):
            at = np.searchsorted(vocabulary, values)
            at[at == len(vocabulary)] = 0
            out[row, at[vocabulary[at] == values]] = 1
        return out

    def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        """Sizes of all intersections, over slices of the values both sides have."""
        both = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
        out = np.zeros((len(left), len(right)), np.float32)
        for at in range(0, len(both), 8192):
            part = both[at : at + 8192]
            out += incidence(left, part) @ incidence(right, part).T
        return out.astype(np.int64)

    def known(sketches: list[np.ndarray], limits: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(s, limits, side="right") for s in sketches])

    def estimates(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        """Similarity of each pair in the sketch of its union: up to the smaller of the two ends both sets are known."""
        ends = lambda group: np.array([s[SKETCH - 1] if len(s) >= SKETCH else U(2**64 - 1) for s in group], U)
        a, b = [s[:SKETCH] for s in left], [s[:SKETCH] for s in right]
        common = overlaps(a, b)
        seen_a = np.minimum(known(a, ends(right)), np.array([len(s) for s in a])[:, None])
        seen_b = np.minimum(known(b, ends(left)), np.array([len(s) for s in b])[:, None]).T
        return common / np.maximum(1, seen_a + seen_b - common)

    def run(tile: pa.Table) -> pa.Table:
        order = sorted(range(tile.num_rows), key=tile["rep"].to_pylist().__getitem__)
        reps = [tile["rep"][k].as_py() for k in order]
        sides = [tile["side"][k].as_py() for k in order]
        sets = [np.frombuffer(tile["values"][k].as_py(), U) for k in order]
        rows = [k for k, s in enumerate(sides) if s != 1]
        columns = [k for k, s in enumerate(sides) if s != 0]
        parent = list(range(len(reps)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        if rows and columns:
            maybe = estimates([sets[k] for k in rows], [sets[k] for k in columns]) >= least
            maybe &= np.array(rows)[:, None] != np.array(columns)[None, :]
            some, other = np.flatnonzero(maybe.any(1)), np.flatnonzero(maybe.any(0))
            if len(some):
                left, right = [sets[rows[k]] for k in some], [sets[columns[k]] for k in other]
                common = overlaps(left, right)
                union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - common
                linked = maybe[np.ix_(some, other)] & (100 * common >= percent * union)
                for x, y in zip(*np.nonzero(linked), strict=True):
                    p, q = find(rows[some[x]]), find(columns[other[y]])
                    parent[max(p, q)] = min(p, q)
        edges = [(reps[k], reps[find(k)]) for k in range(len(reps)) if find(k) != k]
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = pa.array([s.tobytes() for s in shingle_sets(batch.column(1))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), values], names=["rep", "family", "blocks", "values"])


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Shingles are five lower-cased words; documents are linked when 100 * intersection >= percent * union of their shingle
    sets, and component_id is the smallest doc_id reachable (kept: its own). Documents with equal sets are one class from the start.
    A null or blank text has no shingles and is linked with nothing. Rows of one doc_id are one node, linked by each of their
    texts; each row gives one row of the result. A null doc_id is linked with nothing, and
    its component_id and kept are null and true. Other columns are ignored; an empty table gives none.

    Only sketches are shuffled for all documents; full texts are shuffled once, to reach the families.
    """
    rows = id_and_text(docs)
    sketches = cut_lineage(
        rows.mapInArrow(_sketches, "doc_id long, n_shingles long, key1 long, key2 long, sketch array<long>"), compression="zstd"
    )
    key = ["n_shingles", "key1", "key2"]
    usable = sketches.filter("doc_id is not null and n_shingles > 0")
    reps = usable.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    classes = usable.join(reps.withColumnRenamed("rep", "doc_id"), [*key, "doc_id"], "left_semi").withColumnRenamed("doc_id", "rep")
    families = cut_lineage(_families(classes, least_shared(percent)))
    sized = (
        families.join(classes.select("rep", "n_shingles"), "rep").groupBy("family")
        .agg(F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    )
    members = families.join(sized, "family")
    texts = rows.join(members.withColumnRenamed("rep", "doc_id"), "doc_id").select("doc_id", "text", "family", "blocks")
    sets = texts.mapInArrow(_sets, "rep long, family long, blocks int, values binary")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    tiles = (
        sets.withColumn("block", block)
        .withColumn("tile", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
            F.least(F.col("block"), o).alias("i"), F.greatest(F.col("block"), o).alias("j"),
            F.when(F.col("block") == o, F.lit(2)).when(F.col("block") < o, F.lit(0)).otherwise(F.lit(1)).alias("side")))))
        .select("family", "tile.*", "rep", "values")
    )
    links = tiles.groupBy("family", "i", "j").applyInArrow(_links(percent), "a long, b long")
    # Copies join their class, and so do all rows of one doc_id.
    bridges = usable.select("doc_id", *key).join(reps, key).filter("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    components = connected_components(links.unionByName(bridges))
    return sketches.join(components.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))

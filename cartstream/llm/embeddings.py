"""Near-duplicate vectors by int8 tile products with error bounds.

Each unit vector is rounded to 8-bit numbers with a scale of its own; the length of what rounding took away bounds the error of
any product with it. Vectors of a label are dealt to blocks, and each pair of blocks is one tile: an integer product
(exact in 32-bit floats) plus the bounds shows which pairs may reach the threshold, and only these are computed in
double precision. A tile gives counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.llm.components import connected_components
from cartstream.session import cut_lineage

BLOCK = 1024
PAIRS_AT_ONCE = 1 << 15


# The 8-bit products of this many components add up exactly in 32-bit floats: 1024 * 127 * 127 < 2 ** 24.
EXACT_COMPONENTS = 1024


def even_sized(vectors: np.ndarray) -> np.ndarray:
    """Each vector by a power of two so that its largest component is near 1: the same cosines, and no square over- or underflows."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -exponent[:, None])


def rounded_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 8-bit vectors, exact at any number of components."""
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_COMPONENTS):
        total += a[:, at : at + EXACT_COMPONENTS] @ b[:, at : at + EXACT_COMPONENTS].T
    return total


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors (double), their 8-bit form (as 32-bit floats), its scale, and the length of the rounding error."""
    unit = vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    rounded = np.rint(unit / scale[:, None])
    lost = unit - rounded * scale[:, None]
    # The slack covers the double-precision rounding of these lines.
    return unit, rounded.astype(np.float32), scale, np.sqrt(np.einsum("ij,ij->i", lost, lost)) + 1e-12


def tile_links(a: np.ndarray, b: np.ndarray, same: bool, threshold: float):
    """Row and column numbers of all pairs of cosine >= threshold, in pieces; of one block, each pair once."""
    a, b = even_sized(a), even_sized(b)
    _, qa, sa, ea = quantise(a)
    _, qb, sb, eb = quantise(b)
    na, nb = (np.sqrt(np.einsum("ij,ij->i", x, x)) for x in (a, b))
    # |u.v - q(u).q(v)| <= e(u) * |v| + |q(u)| * e(v), and |q(u)| <= 1 + e(u).
    step = max(1, (1 << 24) // max(1, len(b)))
    for at in range(0, len(a), step):
        rows = slice(at, at + step)
        product = rounded_products(qa[rows], qb) * sa[rows, None] * sb[None, :]
        bound = ea[rows, None] + (1 + ea[rows, None]) * eb[None, :] + 1e-9
        maybe = product + bound >= threshold
        if same:
            maybe &= np.arange(len(a))[rows, None] < np.arange(len(b))[None, :]
        x, y = np.nonzero(maybe)
        x += at
        for k in range(0, len(x), PAIRS_AT_ONCE):
            p, q = x[k : k + PAIRS_AT_ONCE], y[k : k + PAIRS_AT_ONCE]
            exact = np.einsum("ij,ij->i", a[p], b[q]) / (na[p] * nb[q])
            linked = exact >= threshold
            yield p[linked], q[linked]


def _compare(threshold: float):
    def unpack(tile: pa.Table, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = tile.filter(pa.compute.equal(tile["side"], side))
        ids = own["rep"].to_numpy()
        order = np.argsort(ids, kind="stable")
        flat = own["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return ids[order], own["copies"].to_numpy()[order], flat.reshape(len(ids), -1)[order] if len(ids) else flat.reshape(0, 0)

    def run(tile: pa.Table) -> pa.Table:
        same = tile["i"][0].as_py() == tile["j"][0].as_py()
        ids_a, copies_a, a = unpack(tile, 0)
        ids_b, copies_b, b = (ids_a, copies_a, a) if same else unpack(tile, 1)
        shift = 0 if same else len(ids_a)
        total = len(ids_a) + (0 if same else len(ids_b))
        ids = ids_a if same else np.concatenate([ids_a, ids_b])
        links, parent = np.zeros(total, np.int64), list(range(total))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        if len(ids_a) and len(ids_b):
            for p, q in tile_links(a, b, same, threshold):
                np.add.at(links, p, copies_b[q])
                np.add.at(links, q + shift, copies_a[p])
                for x, y in zip(p.tolist(), (q + shift).tolist(), strict=True):
                    r, s = find(x), find(y)
                    if r != s:
                        low, high = (r, s) if ids[r] <= ids[s] else (s, r)
                        parent[high] = low
        near = np.flatnonzero(links)
        roots = [find(k) for k in near.tolist()]
        return pa.table({
            "rep": pa.array(ids[near], pa.int64()), "reach": pa.array(ids[roots], pa.int64()), "links": pa.array(links[near], pa.int64()),
        })

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept.

    Vectors of one label (not null) and one length are linked when their cosine in double precision is at least `threshold`. Equal vectors
    are one class from the start and count as many. A vector that is null, empty or zero, or has a null or non-finite
    component, or whose label is null, is linked with nothing. Repeated rows are vectors of their own (linked with each other); a null
    vec_id has a null component_id and is kept. Other columns are ignored; an empty table gives none.

    Blocks have about BLOCK vectors by hash, so a hot label only has more tiles; a vector is sent once per block of its label.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    fit = (
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)) & ~F.isnan(x))
        & F.exists("embedding", lambda x: x != 0)
    )
    usable = rows.filter(F.coalesce(fit, F.lit(False)))
    group = ["label", "size"]
    classes = cut_lineage(
        usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("size", F.size("embedding")), compression="zstd"
    )
    # Reps of several labels differ unless rows repeat a vec_id; the label keeps them apart until the components.
    blocks = classes.groupBy(*group).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = classes.join(blocks, group).withColumn("block", F.pmod(F.xxhash64("rep", "embedding"), F.col("blocks")).cast("int"))
    tiles = (
        dealt.withColumn("tile", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
            F.least(F.col("block"), o).alias("i"), F.greatest(F.col("block"), o).alias("j"),
            F.when(F.col("block") <= o, F.lit(0)).otherwise(F.lit(1)).alias("side")))))
        .select(*group, "tile.*", "rep", "copies", "embedding")
    )
    found = cut_lineage(
        tiles.groupBy(*group, "i", "j").applyInArrow(_compare(threshold), "rep long, reach long, links long")
        .groupBy("rep", "reach").agg(F.sum("links").alias("links"))
    )
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    member = usable.join(classes, ["label", "embedding"]).select("vec_id", "rep", (F.col("copies") - 1).alias("own"))
    bridges = member.filter("vec_id != rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    components = connected_components(found.select(F.col("rep").alias("a"), F.col("reach").alias("b")).unionByName(bridges))
    linked = (
        member.join(counts, "rep", "left").select("vec_id", (F.col("own") + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    alone = rows.filter(~F.coalesce(fit, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"))
    return (
        linked.unionByName(alone).join(components, F.col("vec_id") == F.col("node"), "left")
        .select("vec_id", "n_links", F.coalesce("component", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)))
    )

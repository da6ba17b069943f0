"""Homomorphic multiset fingerprints of documents. DataFrame functions only.

A text is the multiset of its short paragraphs (lines, cut after at most eight words). Each one is hashed to a wide vector of
small numbers; the fingerprint is the sum of the vectors, lane by lane, modulo a power of two. Sums do not depend on
order, and adding or taking away a paragraph is adding or subtracting its vector. The lanes are independent and nearly
centred, so the squared distance of two fingerprints estimates how many paragraphs differ.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 64
LANE_BITS = 4  # of one paragraph's entry; a text below 2 GiB cannot overflow a lane's 31 bits
MODULUS = 1 << 32
PARAGRAPH = r"\S{1,64}(?:[^\S\n]+\S{1,64}){0,7}"
_MEAN = (2**LANE_BITS - 1) / 2


def paragraphs(text: Column) -> Column:
    """The short paragraphs of a text; none for null, empty or blank texts."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))


def _entry(lane: int) -> Column:
    """The entry of paragraph `piece` in a lane: a few bits of one of its hash words."""
    per_word = 64 // LANE_BITS
    word = F.col(f"word{lane // per_word}")
    return F.shiftrightunsigned(word, LANE_BITS * (lane % per_word)).bitwiseAND(F.lit(2**LANE_BITS - 1))


def lane_sums(texts: DataFrame, keys: list[str], sides: dict[str, str]) -> DataFrame:
    """For rows with unique `keys`: per text column in `sides` (result name -> column), a struct of lanes and n.

    Two sides at most: their sums share the halves of one 64-bit number, so both come out of one aggregation.
    """
    marked = F.array(*[
        F.struct(F.lit(32 * k).alias("shift"), F.col(c).alias("text")) for k, c in enumerate(sides.values())
    ])
    pieces = (
        texts.select(*keys, F.explode(marked).alias("side"))
        .select(*keys, F.col("side.shift").alias("shift"), F.explode_outer(paragraphs(F.col("side.text"))).alias("piece"))
        .select(
            *keys, "shift", F.col("piece").isNotNull().cast("long").alias("one"),
            *[F.when(F.col("piece").isNotNull(), F.xxhash64("piece", F.lit(k))).otherwise(F.lit(0)).alias(f"word{k}")
              for k in range(LANES * LANE_BITS // 64)],
        )
    )
    placed = lambda c: F.call_function("shiftleft", c, F.col("shift"))
    sums = pieces.groupBy(*keys).agg(
        F.sum(placed(F.col("one"))).alias("count"), *[F.sum(placed(_entry(k))).alias(f"lane{k}") for k in range(LANES)]
    )
    half = lambda c, k: F.shiftrightunsigned(c, 32 * k).bitwiseAND(F.lit(MODULUS - 1))
    return sums.select(*keys, *[
        F.struct(
            half(F.col("count"), k).alias("n"), F.array(*[half(F.col(f"lane{i}"), k) for i in range(LANES)]).alias("lanes")
        ).alias(name)
        for k, name in enumerate(sides)
    ])


def fingerprints_of(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint (struct n, lanes) of the text: what `update` keeps up to date. doc_id is unique and not null."""
    return lane_sums(docs.select("doc_id", F.col("text").cast("string").alias("text")), ["doc_id"], {"fingerprint": "text"})


def update(stored: DataFrame, inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """Stored fingerprints (doc_id, fingerprint) after paragraphs were put in and taken out, without the texts they came from.

    `inserted` and `deleted` have doc_id and text, the lines that came or went; any number of rows per document, in any order. The lanes
    of what came are added and those of what went subtracted, modulo 2^32, and so is the paragraph count. A line must come or go as a
    whole, since a part of one may be cut into other paragraphs. A document that is not stored begins with the empty fingerprint; rows with a
    null doc_id or without text change nothing. Only the changes are cut and hashed; documents without any keep their fingerprint as it is.
    """
    parts = [
        rows.filter(F.col("doc_id").isNotNull()).select(
            F.lit(sign).alias("sign"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        for rows, sign in ((inserted, 1), (deleted, -1)) if rows is not None
    ]
    if not parts:
        return stored.select("doc_id", "fingerprint")
    changes = lane_sums(reduce(DataFrame.unionByName, parts), ["sign", "doc_id"], {"part": "text"})
    wrapped = lambda c: c.bitwiseAND(F.lit(MODULUS - 1))
    # All rows of a document are one sum (partial sums leave the map tasks); two's complement makes the masked sum the one modulo 2^32.
    net = changes.groupBy("doc_id").agg(
        F.sum(F.col("part.n") * F.col("sign")).alias("n"),
        *[F.sum(F.col("part.lanes")[i] * F.col("sign")).alias(f"lane{i}") for i in range(LANES)],
    ).select("doc_id", F.struct(F.col("n"), F.array(*[f"lane{i}" for i in range(LANES)]).alias("lanes")).alias("net"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.array_repeat(F.lit(0).cast("long"), LANES).alias("lanes"))
    old = F.coalesce(F.col("fingerprint"), zero)
    new = F.struct(
        wrapped(old["n"] + F.col("net.n")).alias("n"),
        F.zip_with(old["lanes"], F.col("net.lanes"), lambda a, b: wrapped(a + b)).alias("lanes"),
    )
    both = stored.select("doc_id", "fingerprint").join(net, "doc_id", "full_outer")
    return both.select("doc_id", F.when(F.col("net").isNull(), F.col("fingerprint")).otherwise(new).alias("fingerprint"))


def printed(fingerprint: Column) -> Column:
    """The lanes as lower-case hexadecimal digits, eight for each."""
    return F.lower(F.array_join(F.transform(fingerprint["lanes"], lambda v: F.lpad(F.hex(v), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: estimated share of paragraphs two fingerprints have in common; 1 for equal ones, also for two empty ones."""
    centred = lambda x, n: x - n * F.lit(_MEAN)
    squares = lambda values: F.aggregate(values, F.lit(0.0), lambda s, v: s + v * v)
    own = lambda f: squares(F.transform(f["lanes"], lambda v: centred(v, f["n"])))
    apart = squares(F.zip_with(a["lanes"], b["lanes"], lambda x, y: centred(x, a["n"]) - centred(y, b["n"])))
    both = own(a) + own(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - apart / both))


def with_next(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """uid, doc_id, text, next_uid, next_text: each document with the next one by ascending doc_id, after the last the first.

    Equal doc_ids follow each other in any order; null doc_ids come last. Documents are dealt to slices of about equal size by
    doc_id, so no task orders all of them; a copy of each slice's first document closes the slice before it. Only the slice
    bounds and the first ids reach the driver: as many numbers as slices.
    """
    spark = docs.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    cuts = rows.agg(F.approx_percentile("doc_id", [k / n for k in range(1, n)] or [0.5], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    place = F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(
        F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)
    )
    firsts = {
        r["slice"]: r["first"] for r in
        rows.groupBy(place.alias("slice")).agg(F.min("doc_id").alias("first")).collect()
    }
    order = sorted(firsts)
    sliced = rows.withColumn("slice", place)
    # The guards: where the first document of a slice is copied to. The very first one follows the last.
    guards = [F.when((F.col("slice") == s) & F.col("doc_id").eqNullSafe(F.lit(firsts[s])), F.lit(order[k - 1]))
              for k, s in enumerate(order)]
    copies = F.filter(
        F.array(F.struct(F.col("slice").alias("slice"), F.lit(0).alias("guard")),
                F.struct(F.coalesce(*guards, F.lit(None).cast("int")).alias("slice"), F.lit(1).alias("guard"))),
        lambda x: x["slice"].isNotNull(),
    )
    dealt = sliced.select("uid", "doc_id", "text", F.explode(copies).alias("at")).select("uid", "doc_id", "text", "at.*")
    walk = Window.partitionBy("slice").orderBy("guard", F.col("doc_id").asc_nulls_last(), "uid")
    return (
        dealt.withColumn("next_uid", F.lead("uid").over(walk)).withColumn("next_text", F.lead("text").over(walk))
        .filter("guard = 0").drop("guard", "slice")
    )


def fingerprint_documents(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """Fingerprints of each document and of its edited text, and how near they and the next document's are.

    Edited text: the last floor(n_chars / 4) code points replaced by the first as many (or all) of the next document. Returns doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A null text is empty; blank
    texts have no paragraphs and the zero fingerprint; a single document is its own next one; repeated rows each
    give a row; an empty table gives none; other columns are ignored. A text is shuffled once.
    """
    keys = ["uid", "doc_id", "n_chars", "next_uid", "edited_sha256"]
    size = F.length("text")
    cut = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - cut), F.substring("next_text", F.lit(1), cut))
    texts = with_next(docs, slices).withColumn("edited", edited).select(
        "uid", "doc_id", size.cast("long").alias("n_chars"), "next_uid", F.sha2("edited", 256).alias("edited_sha256"), "text", "edited"
    )
    prints = lane_sums(texts, keys, {"own": "text", "changed": "edited"})
    following = prints.select(F.col("uid").alias("next_uid"), F.col("own").alias("following"))
    return prints.join(following, "next_uid", "left").select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("own")).alias("fingerprint"),
        printed(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )

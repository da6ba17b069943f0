"""Unique handles: the first row of a base keeps it, later ones get base-1, base-2…

A taken name is skipped, whether it was handed out or arrived as somebody's own
base ('a-1' may be a base too). In arrival order that is a loop over all rows;
here it comes down to counting:

* A base's copies take the free suffixes 1, 2, 3… in order. The only other owner of
  'a-3' is the base 'a-3' itself, at its first arrival, so a suffix is lost to the
  base exactly when that arrival comes before the base's own copies have used it.
* With r suffixes lost below i and c copies of the base before that arrival, this
  is r <= i - 1 - c: a count of lost suffixes that rises where it is small enough,
  over the distinct numbered bases whose parent also occurs (`climbing`). Copies are
  counted, never collected, and no root is settled by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.operators.climbing import climb
from cartstream.operators.ordered import running_sum
from cartstream.session import cut_lineage

_NUMBERED = "^(.*)-([1-9][0-9]{0,17})$"
_SUFFIX = "-[1-9][0-9]{0,17}(?=(-[1-9][0-9]{0,17})*$)"


def _owners(blocks: DataFrame, slices: int | None) -> DataFrame:
    """(base, parent, i, owns): does each numbered base own its name?

    `blocks` has base, parent, i (suffix number) and c (rows of the parent before the first row of
    the base). Where the parent lost its own name all of its rows are copies, else all but
    the first. Both cases are counted; which of them holds is passed down from parents to
    children by composing, in every round, a base's two cases with those of the
    base it hangs on, so chains of names take as many rounds as their length has doublings.
    """
    cases = blocks.withColumn("_copy", F.explode(F.array(F.lit(False), F.lit(True))))
    before = F.when(F.col("_copy"), F.col("c")).otherwise(F.greatest(F.col("c") - 1, F.lit(0)))
    cases = cases.withColumn("_free", F.col("i") - 1 - before)
    cases = climb(cases, ["parent", "_copy"], ["i"], "_free", "owns", slices)
    state = cut_lineage(
        cases.groupBy("base", "parent", "i").agg(
            F.bool_or(~F.col("_copy") & ~F.col("owns")).alias("_lost0"),
            F.bool_or(F.col("_copy") & ~F.col("owns")).alias("_lost1"),
        ).withColumn("_up", F.col("parent"))
    )
    depth = state.agg(F.max(F.size(F.regexp_extract_all("base", F.lit(_SUFFIX), F.lit(0))))).first()[0]
    for _ in range(((depth or 1) - 1).bit_length()):
        above = state.select(F.col("base").alias("_up"), F.col("_up").alias("_next"),
                             F.col("_lost0").alias("_a0"), F.col("_lost1").alias("_a1"))
        case = lambda a: F.when(F.coalesce(F.col(a), F.lit(False)), F.col("_lost1")).otherwise(F.col("_lost0"))
        state = cut_lineage(
            state.join(above, "_up", "left").select(
                "base", "parent", "i", case("_a0").alias("_lost0"), case("_a1").alias("_lost1"), F.col("_next").alias("_up")
            )
        )
    return state.select("base", "parent", "i", (~F.col("_lost0")).alias("owns"))


def unique_handle(
    df: DataFrame, base: str = "base", order: str = "seq", out: str = "handle", slices: int | None = None
) -> DataFrame:
    """Adds `out`, unique over the frame; NULL for a NULL base.

    `order` is the unique arrival order (bigint).
    """
    firsts = df.groupBy(F.col(base).alias("base")).agg(F.min(order).alias("at"))
    numbered = firsts.select(
        "base", "at",
        F.regexp_extract("base", _NUMBERED, 1).alias("parent"),
        F.regexp_extract("base", _NUMBERED, 2).alias("i"),
    ).filter(F.col("i") != "").withColumn("i", F.col("i").cast("bigint"))
    blocks = numbered.join(firsts.select(F.col("base").alias("parent")), "parent", "left_semi")

    # Rows count 1; a marker (count 0) at the first arrival of a numbered base reads
    # off how many rows of its parent came before it.
    rows = df.select(F.col(base).alias("_base"), F.col(order).alias("_at"), F.struct(*df.columns).alias("_row"),
                     F.lit(None).cast("string").alias("_for"), F.lit(None).cast("bigint").alias("_i"),
                     F.lit(1).cast("bigint").alias("_one"))
    empty = F.lit(None).cast(df.select(F.struct(*df.columns).alias("_row")).schema["_row"].dataType)
    marks = blocks.select(F.col("parent").alias("_base"), F.col("at").alias("_at"), empty.alias("_row"),
                          F.col("base").alias("_for"), F.col("i").alias("_i"),
                          F.lit(0).cast("bigint").alias("_one"))
    counted = running_sum(rows.unionByName(marks), ["_base"], ["_at", "_one"], "_one", "_n", slices)
    counted = cut_lineage(counted)  # read four times below

    resolved = _owners(
        counted.filter(F.col("_for").isNotNull())
        .select(F.col("_for").alias("base"), F.col("_base").alias("parent"), F.col("_i").alias("i"), F.col("_n").alias("c")),
        slices,
    )

    # n = 0 keeps the base, n >= 1 takes the n-th suffix not lost.
    displaced = resolved.filter(~F.col("owns")).select(F.col("base").alias("_base"), F.lit(1).alias("_shift"))
    copies = (
        counted.filter(F.col("_for").isNull())
        .join(displaced, "_base", "left")
        .select("_base", "_row", (F.col("_n") - 1 + F.coalesce("_shift", F.lit(0))).alias("_n"))
    )
    lost = resolved.filter("owns").select(F.col("parent").alias("_base"), "i")
    touched = lost.select("_base").distinct()
    plain = copies.join(touched, "_base", "left_anti").withColumn("_skip", F.lit(0).cast("bigint"))

    # Lost suffix e_j (j-th smallest) has e_j - j free ones below it, so it lies before
    # copy n when e_j - j < n: another running count over copies and lost suffixes.
    lost_at = running_sum(lost.withColumn("_one", F.lit(1).cast("bigint")), ["_base"], ["i"], "_one", "_j", slices)
    skipping = copies.join(touched, "_base", "left_semi").select(
        "_base", (F.col("_n") * 2).alias("_pos"), "_row", F.lit(0).cast("bigint").alias("_i"),
        F.lit(0).cast("bigint").alias("_one"),
    )
    # Odd positions: after copy e_j - j, before the next copy.
    gaps = lost_at.select("_base", ((F.col("i") - F.col("_j")) * 2 + 1).alias("_pos"), empty.alias("_row"),
                          F.col("i").alias("_i"), F.lit(1).cast("bigint").alias("_one"))
    shifted = running_sum(skipping.unionByName(gaps), ["_base"], ["_pos", "_i"], "_one", "_skip", slices)
    shifted = shifted.filter(F.col("_one") == 0).select("_base", "_row", (F.col("_pos") / 2).cast("bigint").alias("_n"), "_skip")

    name = F.when(F.col("_n") == 0, F.col("_base")).otherwise(
        F.concat("_base", F.lit("-"), (F.col("_n") + F.col("_skip")).cast("string"))
    )
    return plain.select("_base", "_row", "_n", "_skip").unionByName(shifted).select("_row.*", name.alias(out))

"""Secret scans: fixed patterns, and a battery of randomness tests with false-discovery control. DataFrame functions only.

Candidates of the battery are long runs of code-like characters. Their encoding is inferred from the characters; under that
encoding a key is a uniform random string, which three tests check: chi-squared uniformity of the alphabet, the runs test
around the middle of the alphabet and the lag-1 serial correlation. How the p-values of random strings are spread is known, and
ordinary words have small ones; so for each encoding and class of lengths the share of words among the candidates above a p-value
can be estimated from the distribution itself. A fixed bound per class of lengths holds unless the candidates speak against it, so
a single one is judged too; many candidates can lower it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartstream.session import cut_lineage

KINDS = ["assign", "access", "hex", "random"]
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
PATTERNS = [ASSIGN, "AKIA[A-Z0-9]+", "[0-9a-f]+"]
SHORTEST = [8, 16, 32]
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"

BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
ENCODINGS = [  # name, what its strings look like, alphabet
    ("hex", "^[0-9a-f]+$", "0123456789abcdef"),
    ("hex_upper", "^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("alnum", "^[A-Za-z0-9]+$", BASE64[:62]),
    ("base64", "^.*$", BASE64),
]
LENGTHS = [24, 32, 48, 80]  # where a new class of lengths begins
BINS = 20
FALSE_SHARE = 0.05
ALPHAS = [0.2, 0.1, 0.05, 0.05, 0.05]  # per class of lengths, the bound where there is little to estimate from
TESTS = 2.6  # as many independent tests spread the least of the three like the battery does on random strings
ENOUGH = 100  # candidates above one half from which on an estimate may go below the fixed bound


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _pieces(text: Column, kind: int, pattern: str) -> Column:
    """Per match: kind, number, code points between it and the match before, the match."""
    found = _matches(text, pattern)
    between = F.split(text, pattern, -1)
    return F.when(
        F.size(found) > 0,
        F.zip_with(
            F.transform(found, lambda m, i: F.struct(i.alias("i"), m.alias("m"))), F.slice(between, 1, F.size(found)),
            lambda x, gap: F.struct(
                F.lit(kind).alias("kind"), x["i"].alias("i"), F.length(gap).alias("gap"), x["m"].alias("match")
            ),
        ),
    ).otherwise(F.array().cast("array<struct<kind:int,i:int,gap:int,match:string>>"))


def _tail(z: Column) -> Column:
    """Two-sided tail of the normal distribution, by a logistic approximation (error below 0.0002)."""
    a = F.abs(z)
    return F.lit(2.0) / (F.lit(1.0) + F.exp(F.lit(1.5976) * a + F.lit(0.070566) * a * a * a))


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _moments(values: Column, size: Column) -> Column:
    """In one pass: sum, sum of squares, sum of neighbours' products, first and last value, runs, values in the upper half."""
    start = F.struct(
        F.lit(0.0).alias("sum"), F.lit(0.0).alias("squares"), F.lit(0.0).alias("lagged"), F.lit(None).cast("double").alias("first"),
        F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("runs"), F.lit(0.0).alias("high"),
    )

    def step(m: Column, x: Column) -> Column:
        up = x * 2 >= size
        turned = m["last"].isNull() | ((m["last"] * 2 >= size) != up)
        return F.struct(
            (m["sum"] + x).alias("sum"), (m["squares"] + x * x).alias("squares"),
            (m["lagged"] + F.coalesce(m["last"] * x, F.lit(0.0))).alias("lagged"), F.coalesce(m["first"], x).alias("first"), x.alias("last"),
            (m["runs"] + turned.cast("double")).alias("runs"), (m["high"] + up.cast("double")).alias("high"),
        )

    return F.aggregate(values, start, step)


def randomness(token: Column) -> Column:
    """Struct of encoding and p: the battery's p-value for "uniform random under its encoding", the least of three, times three."""
    # Bound once: inside the lambdas the length would be counted anew for each character.
    return _bind(F.length(token).cast("double"), lambda n: _battery(token, n))


def _battery(token: Column, n: Column) -> Column:
    bins = F.when(n < 80, F.lit(4)).otherwise(F.lit(16))
    encoding = F.coalesce(*[F.when(token.rlike(looks), F.lit(k)) for k, (_, looks, _) in enumerate(ENCODINGS)])

    def p_chi(values: Column, size: Column) -> Column:
        counts = F.transform(
            F.sequence(F.lit(0), bins - 1),
            lambda b: F.size(F.filter(values, lambda x: F.floor(x * bins / size) == b)).cast("double"),
        )
        # A bin's expected share is its part of the alphabet.
        share = lambda b: (F.ceil((b + 1) * size / bins) - F.ceil(b * size / bins)).cast("double") / size
        chi = F.aggregate(
            F.zip_with(counts, F.transform(F.sequence(F.lit(0), bins - 1), share), lambda c, s: (c - n * s) * (c - n * s) / (n * s)),
            F.lit(0.0), lambda a, x: a + x,
        )
        free = (bins - 1).cast("double")
        wilson = (F.pow(chi / free, F.lit(1 / 3)) - (1 - F.lit(2.0) / (9 * free))) / F.sqrt(F.lit(2.0) / (9 * free))
        return _bind(wilson, lambda z: F.when(z > 0, _tail(z) / 2).otherwise(1 - _tail(z) / 2))

    def p_runs(m: Column) -> Column:
        mean = 2 * m["high"] * (n - m["high"]) / n + 1
        spread = F.sqrt((mean - 1) * (mean - 2) / (n - 1))
        return _bind((m["runs"] - mean) / F.when(spread > 0, spread), lambda z: F.coalesce(_tail(z), F.lit(0.0)))

    def p_serial(m: Column) -> Column:
        centre = m["sum"] / n
        power = m["squares"] - n * centre * centre
        lagged = m["lagged"] - centre * (2 * m["sum"] - m["first"] - m["last"]) + (n - 1) * centre * centre
        return _bind(lagged / F.when(power > 1e-9, power) * F.sqrt(n), lambda z: F.coalesce(_tail(z), F.lit(0.0)))

    def battery(encoding: Column) -> Column:
        alphabet = F.element_at(F.array(*[F.lit(a) for _, _, a in ENCODINGS]), encoding + 1)
        size = F.element_at(F.array(*[F.lit(float(len(a))) for _, _, a in ENCODINGS]), encoding + 1)
        letters = F.filter(F.split(F.translate(token, "_-", "/+"), ""), lambda c: c != "")
        values = F.transform(letters, lambda c: F.call_function("locate", c, alphabet).cast("double") - 1)
        least = _bind(values, lambda v: _bind(_moments(v, size), lambda m: F.least(p_chi(v, size), p_runs(m), p_serial(m))))
        return F.struct(encoding.alias("encoding"), F.least(F.lit(1.0), 3 * least).alias("p"))

    return _bind(encoding, battery)


def _length_class(n: Column) -> Column:
    return sum((F.when(n >= bound, F.lit(1)).otherwise(F.lit(0)) for bound in LENGTHS), F.lit(0))


def bounds(candidates: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """encoding, class, bound: the lowest bin of p-values from which on the estimated share of false finds is small.

    Of several rows of one `token` one counts: a string says the same about its class however often it is copied.
    Above one half nearly all candidates are random, and their number gives that of the random ones above any bin. Bins from
    the fixed bound on qualify unless the share is too large by more than two standard errors of that number; lower ones need
    enough candidates and no allowance. The result has at most encodings x length classes rows.
    """
    bins = list(range(1, BINS))
    above = lambda b: (1 - b / BINS / 3) ** TESTS  # noqa: E731  # share of random strings from bin b on
    tokens = candidates.select("encoding", "class", "p", "token").distinct()
    counts = tokens.groupBy("encoding", "class").agg(*[F.count(F.when(F.col("p") >= b / BINS, 1)).alias(f"from_{b}") for b in bins])
    half = F.col(f"from_{BINS // 2}")
    slack = 2 * F.sqrt((1 - above(BINS / 2)) * half) + 2
    fixed = F.element_at(F.array(*[F.lit(a) for a in ALPHAS]), F.col("class") + 1)

    def qualifies(b: int) -> Column:
        random = F.when(fixed <= b / BINS, half + slack).when(half >= ENOUGH, half) / above(BINS / 2) * above(b)
        kept = F.col(f"from_{b}")
        return (kept > 0) & (random >= (1 - false_share) * kept)

    return counts.select(
        "encoding", "class", F.coalesce(*[F.when(qualifies(b), F.lit(b / BINS)) for b in bins]).alias("bound")
    ).filter("bound is not null")


def _length_group(match: Column) -> Column:
    """Length of an assignment's value."""
    return F.length(F.regexp_extract(match, f"^{ASSIGN}$", 2))


def _replacements(limits: list[tuple[int, int, float]], mark: str) -> list[tuple[str, Callable[[Column], Column]]]:
    """Per kind: its pattern, and what a match becomes. `limits` are rows of `bounds`."""

    def value(m: Column) -> Column:
        n = _length_group(m)
        return F.when(n >= SHORTEST[0], F.concat(F.substring(m, F.lit(1), F.length(m) - n), F.lit(mark))).otherwise(m)

    def random(m: Column) -> Column:
        def passes(test: Column) -> Column:
            found = F.lit(False)
            for encoding, group, bound in limits:
                found = found | ((test["encoding"] == encoding) & (_length_class(F.length(m)) == group) & (test["p"] >= bound))
            return found

        # Bound once in an array, else each limit would run the battery again.
        return F.when(F.transform(F.array(randomness(m)), passes)[0], F.lit(mark)).otherwise(m)

    fixed = [
        (ASSIGN, value),
        (PATTERNS[1], lambda m: F.when(F.length(m) >= SHORTEST[1], F.lit(mark)).otherwise(m)),
        ("[0-9a-f]{32,}", lambda m: F.when(m.isNotNull(), F.lit(mark))),
    ]
    return [*fixed, (CANDIDATE, random)] if limits else fixed


def redact_secrets(docs: DataFrame, false_share: float = FALSE_SHARE, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with secrets in `text` replaced by `mark`; a null text stays null.

    Two passes: the bounds of the randomness battery (a few rows, which reach the driver) come from the candidates that
    find_spans has, then each text is rewritten where it is read. Only matches are shuffled.
    """
    candidates = _untouched(docs.select(F.lit(None).alias("doc_id"), "text")).filter("kind = 3")
    limits = [tuple(r) for r in bounds(candidates, false_share).select("encoding", "class", "bound").collect()]
    def replace(docs: DataFrame, pattern: str, new: Callable[[Column], Column]) -> DataFrame:
        found, between = _matches(F.col("text"), pattern), F.split("text", pattern, -1)
        parts = F.zip_with(between, found, lambda gap, m: F.concat(gap, F.coalesce(new(m), F.lit(""))))
        return docs.withColumn("text", F.when(F.size(found) > 0, F.array_join(parts, "")).otherwise(F.col("text")))

    # One projection per kind: the text of one step is used several times in the next.
    out = docs.withColumn("text", F.col("text").cast("string"))
    for pattern, new in _replacements(sorted(limits), mark):
        out = replace(out, pattern, new)
    return out


def _untouched(docs: DataFrame) -> DataFrame:
    """uid, doc_id, kind, start, stop of base spans and of the candidates that touch none; of these also encoding, class, p and token.

    `token` is a digest of the string, so that long ones are not shuffled.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    nothing = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("gap"), F.lit("").alias("match")))
    pieces = [_pieces(F.col("text"), k, p) for k, p in enumerate([*PATTERNS[:2], "[0-9a-f]{32,}", CANDIDATE])]
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "uid", "doc_id", F.explode(F.concat(nothing, *pieces)).alias("piece")
    ).select("uid", "doc_id", "piece.*")
    group = _length_group(F.col("match"))
    measured = rows.select(
        "uid", "doc_id", "kind", "i", "gap", F.length("match").alias("size"),
        F.when(F.col("kind") == 3, randomness(F.col("match"))).alias("test"),
        F.when(F.col("kind") == 3, F.unhex(F.sha2("match", 256))).alias("token"),
        F.coalesce(
            F.when(F.col("kind") == 0, group >= SHORTEST[0]), F.when(F.col("kind") == 1, F.length("match") >= SHORTEST[1]), F.lit(True)
        ).alias("passes"),
    )
    along = Window.partitionBy("uid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        measured.repartition("uid").withColumn("stop", F.sum(F.col("gap") + F.col("size")).over(along).cast("int"))
        .filter("passes").withColumn("start", F.col("stop") - F.col("size"))
    )
    base = (F.col("kind") >= 0) & (F.col("kind") < 3)
    ahead = Window.partitionBy("uid").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("uid").orderBy(F.col("start").desc(), F.col("stop").desc()).rowsBetween(Window.unboundedPreceding, 0)
    touched = (F.coalesce(F.max(F.when(base, F.col("stop"))).over(ahead), F.lit(0)) > F.col("start")) | (
        F.coalesce(F.min(F.when(base, F.col("start"))).over(back), F.lit(2**31 - 1)) < F.col("stop"))
    return placed.withColumn("touched", touched).filter((F.col("kind") != 3) | ~F.col("touched")).select(
        "uid", "doc_id", "kind", "start", "stop", F.col("test.encoding").alias("encoding"), F.col("test.p").alias("p"),
        F.when(F.col("kind") == 3, _length_class(F.col("size"))).alias("class"), "token",
    )


def find_spans(docs: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """uid, doc_id, kind (number in KINDS, or -1 in one extra row of each document), start, stop: all secrets.

    Positions are code points, stop exclusive. Base kinds are leftmost non-overlapping matches of their pattern that are
    long enough; random ones are candidates above the bound of their class that touch no base span. Texts stay
    where they are read; only matches are shuffled, by document.
    """
    spans = cut_lineage(_untouched(docs))
    limits = bounds(spans.filter("kind = 3"), false_share)
    # At most encodings x length classes rows.
    return spans.join(F.broadcast(limits), ["encoding", "class"], "left").filter("kind != 3 or p >= bound").select(
        "uid", "doc_id", "kind", "start", "stop"
    )


def scan_secrets(docs: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    spans lists kind:start:end by start, then kind; base_sha256 digests the same list without the random ones. A null text is
    empty; documents without secrets have zero counts and an empty list; repeated rows each give a row, a null doc_id stays
    null; other columns are ignored; an empty table gives none.
    """
    spans = find_spans(docs, false_share)
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")
    count = lambda k: F.count(F.when(F.col("kind") == k, 1))
    by_doc = spans.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.array_sort(F.collect_list(F.when(F.col("kind") >= 0, F.struct("start", "kind", "stop")))).alias("found"),
    )
    return by_doc.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(listed(F.filter("found", lambda s: s["kind"] < 3)), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"), "n_random",
    )

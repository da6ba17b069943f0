"""Fill-in-the-middle and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartstream.llm import fill_middle as fim
from cartstream.llm import importance, queries

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = [
    "", " ", " \n\t", "a", "a ", " a", "naïve 你好 世界 ", "x" * 40_000, "ab " * 9_000, "你" * 9_000, " " * 30_000 + "z", "with <P> inside", "<", "<P",
    "ends <S", "a b c\x1cd\x85e", "one two three", "é " * 2_000 + "\r\n", "\x00 \x00",
]
numbers = lambda doc, seed: [int(hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]


def fim_by_force(doc, text):
    units = UNIT.findall(text)
    n = len(units)
    h1, h2, h3, h4 = numbers(doc, 42)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b, c = ("".join(units[i:j]) for i, j in ((0, low), (low, high), (high, n)))
    if h4 % 100 < 80:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def test_fill_in_middle_of_the_corpus(spark, sf, corpus):
    got = {r["doc_id"]: r for r in queries.op12_fill_in_middle(spark, sf).collect()}
    assert len(got) == len(corpus)
    for doc, text in corpus:
        *head, out = fim_by_force(doc, text)
        assert tuple(got[doc])[1:5] == tuple(head)
        assert got[doc]["output_sha256"] == hashlib.sha256(out.encode()).hexdigest()
        assert got[doc]["restored_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_fill_in_middle_of_odd_texts(docs):
    rng = random.Random(3)
    made = ["".join(rng.choices("ab \n\té你<PSM>", k=rng.randint(0, 300))) for _ in range(300)]
    rows = list(enumerate([*ODD * 4, *made]))
    got = {r["doc_id"]: tuple(r)[1:] for r in fim.fill_in_middle(docs(rows)).collect()}
    assert got == {i: fim_by_force(i, t) for i, t in rows}
    assert {f for _, f, *_ in got.values()} == {"plain", "psm", "spm"}
    for _, form, _, _, out in got.values():
        assert fim.restore(out.encode(), form).decode() in [t for _, t in rows]


def test_chunks_do_not_depend_on_their_surroundings():
    shared = bytes(random.Random(1).choices(range(97, 105), k=40_000))
    cuts = []
    for before in (b"", b"some other text "):
        ends = fim.chunk_ends(np.frombuffer(before + shared, np.uint8), np.array([0, len(before) + len(shared)]))
        cuts.append({int(e) - len(before) for e in ends if e - len(before) > fim.LONGEST})
    assert len(cuts[0]) > 10 and cuts[0] == cuts[1]


def test_fill_in_middle_of_odd_rows(spark, docs):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b")]
    frame = docs(rows).withColumn("n", F.lit(1)).withColumn("form", F.lit("x")).withColumn("output", F.lit("y"))
    got = sorted(map(tuple, fim.fill_in_middle(frame, digests=True).collect()), key=str)
    assert len(got) == 5 and got[0][0] in (1, 2) and len(set(got)) == 4
    assert {r[:5] for r in got if r[0] in (1, 2)} == {(1, 0, "plain", None, None), (2, 0, "plain", None, None)}
    assert fim.fill_in_middle(docs([])).count() == 0


# -- resampling --------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def resample_by_force(rows, target, percent=10, min_words=20, longest=1, size=10_000, seed=2024):
    def features(text):
        words = WORD.findall((text or "").translate(LOWER))
        runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % size for r in runs]

    own = [(i, *features(t)) for i, t in rows]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()) + size, sum(t.values()) + size
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(size)]
    out, enough = {}, []
    for i, n, f in own:
        weight = sum(gain[b] for b in f)
        score = weight + math.floor(-1000 * math.log(-math.log((numbers(i, seed)[0] + 0.5) / 4294967296)))
        out[i] = [i, len(f), weight, score, None]
        if n >= min_words:
            enough.append((-score, i))
    for k, (_, i) in enumerate(sorted(enough)[: len(enough) * percent // 100]):
        out[i][4] = k + 1
    return {i: tuple(r) for i, r in out.items()}


def test_resampling_of_the_corpus(spark, sf, corpus):
    target = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {r["doc_id"]: tuple(r) for r in queries.op13_importance_resampling(spark, sf).collect()}
    assert got == resample_by_force(corpus, target)
    assert sum(r[4] is not None for r in got.values()) > 10


def test_resampling_with_runs_small_blocks_and_far_ids(spark, docs, monkeypatch):
    monkeypatch.setattr(importance, "PIECE", 40)
    rng = random.Random(9)
    ids = [-(1 << 63), (1 << 63) - 1, -1, 0, *rng.sample(range(-(10**15), 10**15), 80)]
    rows = [(i, " ".join(rng.choices(["Aa", "b", "ça", "d9", "e-f"], k=rng.randint(0, 30)))) for i in ids]
    target = spark.createDataFrame([("aa b aa b",), (None,), ("ça",)], "text string")
    got = importance.resample(docs(rows), target, percent=60, min_words=5, longest=3, buckets=97, block=7).collect()
    assert {r["doc_id"]: tuple(r) for r in got} == resample_by_force(rows, ["aa b aa b", "ça"], 60, 5, 3, 97)


def test_radix_order_is_stable(spark):
    rng = random.Random(4)
    rows = [(k, rng.randint(-3000, 3000) * 1000, k) for k in range(500)]
    frame = spark.createDataFrame(rows, "pos long, v long, tag long").repartition(3)
    ranked = importance.radix_ranked(frame, importance._digits(F.col("v")), block=64).orderBy("pos").collect()
    assert [r["pos"] for r in ranked] == list(range(500))
    assert [r["tag"] for r in ranked] == [t for _, _, t in sorted(rows, key=lambda r: r[1])]


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")], [(None, "a b c"), (3, "a b c"), (3, "a b c"), (4, "a b c")]])
def test_resampling_of_odd_rows(spark, docs, rows):
    frame = docs(rows).withColumn("rank", F.lit(1)).withColumn("part", F.lit(1)).withColumn("pos", F.lit("x"))
    target = spark.createDataFrame([], "text string, doc_id long")
    got = importance.resample(frame, target, percent=50, min_words=3).collect()
    assert len(got) == len(rows)
    drawn = [r["rank"] for r in got if r["rank"] is not None]
    assert sorted(drawn) == list(range(1, sum(t == "a b c" for _, t in rows) // 2 + 1))

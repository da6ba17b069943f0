"""Secret scans, vectors, fingerprints, classifier, URL rules and the pipeline against brute force."""

import hashlib
import math
import random
import re
import string
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartstream.llm import components, embeddings, fingerprints, quality, queries, secrets, url_filters

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 32]
    return sorted(out)


def listed(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def check_secrets(got, rows):
    for i, text in rows:
        spans, r = base_spans(text or ""), got[i]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[1] == k for s in spans) for k in range(3)), i
        assert r["base_sha256"] == sha(listed(spans)), i
        assert [s for s in r["spans"].split(",") if s and not s.startswith("random")] == [s for s in listed(spans).split(",") if s]


def test_secrets_of_a_whole_table(spark, sf, corpus):
    check_secrets({r["doc_id"]: r for r in queries.op4_secret_scans(spark, sf).collect()}, corpus)


def planted(seed=2):
    rng = random.Random(seed)
    key = lambda n, letters=string.ascii_letters + string.digits + "+/": "".join(rng.choices(letters, k=n))
    rows = [
        (1, f'Password : "{key(12)}" AKIA{key(14, string.ascii_uppercase)} x'), (2, "api_key=token: abcdefghij secret=short"),
        (3, f"é😀 {key(40, '0123456789abcdef')} {key(31, '0123456789abcdef')}x TOKEN=='{key(9)}"), (4, None), (5, ""), (6, "AKIA" * 5 + " AKIAB"),
        (7, "token=secret=abcdefgh12 passwd=a=b=c=d=e"), (8, "token=abcdefgh " * 3000), (9, f"x={'deadbeef' * 5000}"),
    ]
    words = ["Internationalization", "counterrevolutionaries", "uncharacteristically", "thththereererereandanding"]
    rows += [(100 + k, f"{rng.choice(words)} and {key(44)} so {rng.choice(words)}") for k in range(200)]
    return rows


def test_secrets_of_odd_rows(docs):
    rows = planted()
    got = {r["doc_id"]: r for r in secrets.scan_secrets(docs(rows)).collect()}
    check_secrets(got, rows)
    found = [text[int(a) : int(b)] for i, text in rows[9:] for s in got[i]["spans"].split(",") if s.startswith("random") for _, a, b in [s.split(":")]]
    assert len(found) > 150 and all(len(f) == 44 for f in found), "random strings are found, long words are not"
    again = secrets.scan_secrets(docs([(None, "token=abcdefgh"), (1, "x"), (1, "x")])).collect()
    assert sorted(r["n_assign"] for r in again) == [0, 0, 1]
    assert secrets.scan_secrets(docs([])).count() == 0


def test_battery_is_as_computed_by_hand(spark):
    rng = random.Random(9)
    tokens = ["".join(rng.choices(secrets.BASE64, k=n)) for n in (20, 33, 64, 100, 400)] + ["a" * 25, "0123456789abcdef" * 3]
    tail = lambda z: 2 / (1 + math.exp(1.5976 * abs(z) + 0.070566 * abs(z) ** 3))
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    for r in df.select("t", secrets.randomness(df["t"]).alias("r")).select("t", "r.*").collect():
        alphabet = next(a for _, looks, a in secrets.ENCODINGS if re.match(looks, r["t"]))
        v, size, n = np.array([alphabet.index(c) for c in r["t"]], float), len(alphabet), len(r["t"])
        bins = 4 if n < 80 else 16
        counts = np.bincount((v * bins // size).astype(int), minlength=bins)
        share = np.bincount(np.arange(size) * bins // size, minlength=bins) / size
        chi, free = ((counts - n * share) ** 2 / (n * share)).sum(), bins - 1
        wilson = ((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
        p = [tail(wilson) / 2 if wilson > 0 else 1 - tail(wilson) / 2]
        up = v * 2 >= size
        mean = 2 * up.sum() * (~up).sum() / n + 1
        spread = math.sqrt(max(0, (mean - 1) * (mean - 2) / (n - 1)))
        p.append(tail((1 + (up[1:] != up[:-1]).sum() - mean) / spread) if spread > 0 else 0)
        centred = v - v.mean()
        power = (centred**2).sum()
        p.append(tail((centred[1:] * centred[:-1]).sum() / power * math.sqrt(n)) if power > 1e-9 else 0)
        assert r["p"] == pytest.approx(min(1, 3 * min(p)), abs=1e-9)


def test_redaction_takes_the_secrets_and_nothing_else(docs):
    rows = planted()
    got = {r["doc_id"]: r["text"] for r in secrets.redact_secrets(docs(rows)).collect()}
    assert got[4] is None and got[5] == "" and got[2] == rows[1][1]
    assert got[1].startswith('Password : "[SECRET]" [SECRET] x') and got[7].startswith("token=[SECRET] passwd=")
    assert got[8] == "token=[SECRET] " * 3000 and got[9] == "x=[SECRET]"
    assert sum("[SECRET]" in got[i] for i, _ in rows[9:]) > 150
    assert all(not base_spans(t or "") for t in got.values())


def wordlike(rng, n=28):
    """Names of joined words and three digits, which the battery takes for random now and then."""
    words = ["user", "order", "total", "price", "event", "stream", "zone", "query", "batch", "index", "view", "key", "shop", "tax"]
    return "".join(rng.choice(words).capitalize() for _ in range(n))[: n - 3] + "".join(rng.choices(string.digits, k=3))


def test_copies_of_a_secret_do_not_change_what_is_found(docs):
    rng = random.Random(12)
    key = lambda: "".join(rng.choices(string.ascii_letters + string.digits, k=28))
    rows = [(k, f"a {wordlike(rng)} b") for k in range(300)] + [(1000 + k, f"a {key()} b") for k in range(60)]
    scan = lambda rows: {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(docs(rows)).collect()}
    clean = lambda rows: {r["doc_id"]: r["text"] for r in secrets.redact_secrets(docs(rows)).collect()}
    alone, cleaned = scan(rows), clean(rows)
    assert all((alone[i] != "") == ("[SECRET]" in cleaned[i]) for i, _ in rows)
    copied = next(t for i, t in rows if i >= 1000 and alone[i])
    more = [*rows, *((5000 + k, copied) for k in range(3000))]
    again, cleaned_again = scan(more), clean(more)
    assert {i: again[i] for i in alone} == alone and {i: cleaned_again[i] for i in alone} == cleaned
    assert all(again[5000 + k] and cleaned_again[5000 + k] == "a [SECRET] b" for k in range(3000))


def test_a_single_secret_of_a_class_is_found(docs):
    rng = random.Random(21)
    found, total = 0, 0
    for _ in range(2):
        rows = []
        for k, (_, looks, letters) in enumerate(secrets.ENCODINGS):
            for n in (22, 28, 40, 60, 100):
                key = next(t for t in iter(lambda: "".join(rng.choices(letters, k=n)), None) if all(not re.match(e[1], t) for e in secrets.ENCODINGS[:k]))
                if k or n < 32:  # longer ones are of the kind hex
                    rows.append((100 * k + n, f"x {key} y"))
        spans = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(docs(rows)).collect()}
        clean = {r["doc_id"]: r["text"] for r in secrets.redact_secrets(docs(rows)).collect()}
        assert all((spans[i] != "") == (clean[i] == "x [SECRET] y") for i, _ in rows)
        found, total = found + sum(s.startswith("random:2:") for s in spans.values()), total + len(rows)
    assert found > 0.85 * total
    words = [(k, t) for k, t in enumerate(["x counterrevolutionaries y", "x uncharacteristically_long_names_of_things y", "x INTERNATIONALIZATION_OF_MESSAGE_TEXTS y"])]
    assert all(r["spans"] == "" for r in secrets.scan_secrets(docs(words)).collect())


def test_many_words_without_secrets_raise_the_bound(spark):
    rows = [(3, 2, 0.1 + 0.3 * k / 2000, str(k)) for k in range(2000)] + [(3, 2, 0.01, "low")]
    df = spark.createDataFrame(rows, "encoding int, class int, p double, token string")
    bound = min([r["bound"] for r in secrets.bounds(df).collect()], default=1.0)
    assert sum(p >= bound for _, _, p, _ in rows) < 20


# -- vectors -----------------------------------------------------------------

def vectors_by_force(rows, threshold=0.98):
    ids = [r[0] for r in rows]
    fit = [
        r[1] is not None and r[2] is not None and len(r[1]) > 0 and all(x is not None and math.isfinite(x) for x in r[1]) and any(x != 0 for x in r[1])
        for r in rows
    ]
    x = [np.array(r[1], float) if f else None for r, f in zip(rows, fit, strict=True)]
    n, parent = [0] * len(rows), {i: i for i in ids}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if fit[a] and fit[b] and rows[a][2] == rows[b][2] and len(x[a]) == len(x[b]):
                if x[a] @ x[b] / math.sqrt(x[a] @ x[a]) / math.sqrt(x[b] @ x[b]) >= threshold:
                    n[a], n[b] = n[a] + 1, n[b] + 1
                    p, q = find(ids[a]), find(ids[b])
                    parent[max(p, q)] = min(p, q)
    return sorted((i, n[k], find(i), find(i) == i) for k, i in enumerate(ids))


@pytest.mark.parametrize("block", [1024, 7])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 16))
    rows = []
    for k in range(160):
        v = (centres[k % 6] + rng.normal(size=16) * rng.choice([0.02, 0.12, 0.16, 0.5])).astype(np.float32) * rng.choice([1, 3])
        rows.append((k, [float(c) for c in v], int(k % 2)))
    rows += [(200 + k, rows[0][1], rows[0][2]) for k in range(30)]
    nan, inf = float("nan"), float("inf")
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [1.0] * 15 + [None], 1), (303, [nan] + [1.0] * 15, 1), (304, [inf] + [1.0] * 15, 1),
             (305, rows[1][1], None), (306, [], 1), (307, rows[1][1][:8], 1), (308, rows[1][1][:8], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    assert sorted(map(tuple, embeddings.near_vectors(df).collect())) == vectors_by_force(rows)


def test_many_components_lose_no_link(spark):
    rng, rows = np.random.default_rng(2), []
    for k in range(40):
        v = rng.choice([-1.0, 1.0], 2500)
        near = v.copy()
        near[rng.choice(2500, 25, replace=False)] *= -1  # cosine 0.98
        rows += [(2 * k, v.tolist(), 1), (2 * k + 1, near.tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = embeddings.near_vectors(df, threshold=0.98 - 1e-12).collect()
    assert all(r["n_links"] == 1 and r["component_id"] == r["vec_id"] // 2 * 2 for r in got)


@pytest.mark.parametrize("size", [1e-300, 1e-170, 1e160, 1e300])
def test_very_short_and_long_vectors(spark, size):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(12, 20))
    rows = [(k, (v[k // 2] * (size if k % 2 else 1.0)).tolist(), 1) for k in range(24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embeddings.near_vectors(df).collect()
    assert all(r["n_links"] == 1 and r["component_id"] == r["vec_id"] // 2 * 2 for r in got)


def test_near_vectors_of_a_whole_table(spark, sf):
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{sf}/embeddings.parquet'").fetchall()
    assert sorted(map(tuple, queries.op7_embedding_near_dedup(spark, sf).collect())) == vectors_by_force(rows)


def test_error_bounds_hold():
    rng = np.random.default_rng(8)
    a, b = (rng.normal(size=(300, 24)) for _ in range(2))
    ua, qa, sa, ea = embeddings.quantise(a)
    ub, qb, sb, eb = embeddings.quantise(b)
    off = np.abs(ua @ ub.T - (qa.astype(float) @ qb.T.astype(float)) * sa[:, None] * sb[None, :])
    assert (off <= ea[:, None] + (1 + ea[:, None]) * eb[None, :]).all() and np.abs(qa).max() <= 127


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(5, 5), (5, None)] + [
        (500, 500 + k) for k in range(40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: find(k) for k in parent}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- fingerprints ------------------------------------------------------------

def test_fingerprints_of_a_whole_table(spark, sf, corpus):
    got = {r["doc_id"]: r for r in queries.op8_fingerprints(spark, sf).collect()}
    assert len(got) == len(corpus)
    for k, (i, text) in enumerate(corpus):
        cut, following = len(text) // 4, corpus[(k + 1) % len(corpus)]
        assert got[i]["n_chars"] == len(text) and got[i]["edited_sha256"] == sha(text[: len(text) - cut] + following[1][:cut])
        same = got[i]["fingerprint"] == got[following[0]]["fingerprint"]
        assert (got[i]["near_next"] == 1.0) == same or not same
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    prints = {}
    for i, text in corpus:
        assert prints.setdefault(text, got[i]["fingerprint"]) == got[i]["fingerprint"]
    assert np.mean([r["near_edited"] > r["near_next"] for r in got.values()]) > 0.97


def plain_fingerprint(spark, text):
    """(n, lanes) by a loop over the paragraphs, with Spark's hash of each."""
    pieces = [m.group(0) for m in re.finditer(fingerprints.PARAGRAPH, text or "")]
    if not pieces:
        return 0, [0] * fingerprints.LANES
    words = fingerprints.LANES * fingerprints.LANE_BITS // 64
    rows = spark.createDataFrame([(p,) for p in pieces], "p string").select(*[F.xxhash64("p", F.lit(k)) for k in range(words)]).collect()
    lanes = [sum((r[i // 16] % 2**64 >> 4 * (i % 16)) & 15 for r in rows) % fingerprints.MODULUS for i in range(fingerprints.LANES)]
    return len(pieces), lanes


def test_fingerprints_follow_insertions_and_deletions(spark, docs):
    """Equal to fingerprints of the new texts, and those to a loop; order, repeats, nulls and documents not stored included."""
    before = [(1, "a b c\nd e\nd e\nx"), (2, None), (3, "one two three four five six seven eight nine\nlast"), (4, "same"), (5, "gone")]
    inserted = [(1, "new line\nd e"), (1, "another"), (2, "first"), (6, "not stored\nyet"), (None, "nothing"), (4, None)]
    deleted = [(1, "a b c"), (1, "d e"), (3, "one two three four five six seven eight nine"), (5, "gone"), (4, "")]
    after = [(1, "x\nd e\nanother\nnew line\nd e"), (2, "first"), (3, "last"), (4, "same"), (5, ""), (6, "yet\nnot stored")]
    got = fingerprints.update(fingerprints.fingerprints_of(docs(before)), docs(inserted), docs(deleted)).collect()
    got = {r["doc_id"]: (r["fingerprint"]["n"], r["fingerprint"]["lanes"]) for r in got}
    assert got == {i: plain_fingerprint(spark, text) for i, text in after}
    stored = fingerprints.fingerprints_of(docs(before))
    assert sorted(map(str, fingerprints.update(stored).collect())) == sorted(map(str, stored.collect()))
    back = fingerprints.update(fingerprints.update(stored, docs(inserted)), None, docs(inserted)).filter("doc_id < 6")
    assert sorted(map(str, back.collect())) == sorted(map(str, stored.collect()))


def test_fingerprints_do_not_depend_on_order(docs):
    rows = [(1, "one two\nthree four\nfive"), (2, "five\none two\nthree four"), (3, "one two\nthree four\nsix"), (4, None), (5, " \n"), (6, "é😀" * 9)]
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(docs(rows)).collect()}
    assert got[1]["fingerprint"] == got[2]["fingerprint"] != got[3]["fingerprint"] and got[4]["fingerprint"] == got[5]["fingerprint"]
    assert got[1]["near_next"] == 1.0 and got[4]["near_next"] == 1.0 and got[6]["n_chars"] == 18
    assert got[6]["edited_sha256"] == sha(("é😀" * 9)[:14] + "one ")
    one = fingerprints.fingerprint_documents(docs([(1, "abcdefgh")])).collect()
    assert one[0]["edited_sha256"] == sha("abcdefab") and fingerprints.fingerprint_documents(docs([])).count() == 0
    assert fingerprints.fingerprint_documents(docs([(None, "a"), (1, "b"), (1, "b"), (None, None)])).count() == 4


@pytest.mark.parametrize("slices", [1, 2, 7, 50])
def test_next_documents_over_any_slices(docs, slices):
    rows = [(k * k, f"t{k}") for k in range(30)]
    got = {r["text"]: r["next_text"] for r in fingerprints.with_next(docs(rows), slices).collect()}
    assert got == {f"t{k}": f"t{(k + 1) % 30}" for k in range(30)}


# -- classifier --------------------------------------------------------------

def test_classifier_on_held_out_labels(spark, sf, corpus):
    got = {r["doc_id"]: r for r in queries.op9_quality_classifier(spark, sf).collect()}
    assert len(got) == len(corpus)
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
    held = [(q, got[i]["score"], got[i]["predicted"]) for i, q in labels if i in got and got[i]["held_out"]]
    assert np.mean([q == p for q, _, p in held]) > 0.9
    good, bad = [s for q, s, _ in held if q], [s for q, s, _ in held if not q]
    assert np.mean([[a > b for b in bad] for a in good]) > 0.9


def test_scores_depend_on_the_text_only(spark, docs):
    rng = random.Random(3)
    good = [(k, " ".join("".join(rng.choices("etaoinshr", k=rng.randint(2, 8))) for _ in range(60)).capitalize() + ".") for k in range(150)]
    bad = [(1000 + k, "BUY!!! NOW!!! " * rng.randint(5, 40)) for k in range(50)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = [*good, *bad, (5000, good[0][1]), (5001, None), (5002, ""), (None, "x"), (5003, "x" * 200_000)]
    got = {r["doc_id"]: r for r in quality.classify(docs(rows), labels).collect()}
    assert got[5000]["score"] == got[0]["score"] and got[5001]["score"] == got[5002]["score"] and got[None]["held_out"] is False
    assert np.mean([got[i]["predicted"] for i, _ in good]) > 0.97 and np.mean([got[i]["predicted"] for i, _ in bad]) < 0.03
    nothing = quality.classify(docs(rows), labels.limit(0))
    assert {r["score"] for r in nothing.collect()} == {0.5}
    assert quality.classify(docs([]), labels).count() == 0


# -- URL rules ---------------------------------------------------------------

def test_url_rules_agree_with_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    expected = con.execute(queries.ORACLES["op10_url_filters"])
    names = [c[0] for c in expected.description]
    got = queries.op10_url_filters(spark, sf)
    assert sorted(map(str, expected.fetchall())) == sorted(str(tuple(r[c] for c in names)) for r in got.collect())


def test_url_rules_on_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://ORG/x", "ftp://a.b.example.org/en/12?q#f", "http://example.org", "https://notexample.org/es/",
            "x://example.org/es/../", "http://fr.com/fr/://y", "http://com/de/", "http://a.com:80/fr/", "http://com./fr/", "http://.com/fr/", "http://É.com/fr/é",
            "http://a.com#/fr/", "http://a.com/fr", "://com/fr/", "http://" + "a." * 5000 + "org/"]
    rules = [*queries.URL_RULES, ("", "/", "block"), ("a.com", "/fr/é", "allow"), ("com", "/fr/", "block"), (None, "/", "block"), ("org", "", "block")]
    df = spark.createDataFrame([(k, u) for k, u in enumerate([*urls, *urls])], "page_id long, url string")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filters.filter_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    best = {}
    for h, p, v in rules:
        if h is not None:
            best[h, p] = max(v, best.get((h, p), ""))
    for k, url in enumerate([*urls, *urls]):
        host = path = ""
        if url and "://" in url:
            host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
            host = host.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
        fits = [(len(h), len(p), h + p, v) for (h, p), v in best.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, _, rule, verdict = max(fits, default=(0, 0, None, "allow"))
        assert got[k] == (host, path, rule, verdict), url
    assert url_filters.filter_urls(df.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


# -- pipeline ----------------------------------------------------------------

def test_pipeline_takes_out_what_it_should(spark, sf, corpus):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).toPandas(), docs.schema)
        seen.append({r["doc_id"]: r for r in docs.collect()})
    quality_kept, near_kept, cut, clean = seen
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    good = [i for i in before if labels.get(i) == 1]
    assert sum(i in quality_kept for i in good) > 0.97 * len(good)
    from test_texts import near_by_force, removed_by_force, WORD  # noqa: PLC0415

    alone = near_by_force([(i, r["text"]) for i, r in quality_kept.items()], 80)
    assert set(near_kept) == {i for i, r in alone.items() if r[3]}
    words = {i: WORD.findall(r["text"] or "") for i, r in near_kept.items()}
    gone = removed_by_force(words, 13)
    assert {i: WORD.findall(r["text"]) for i, r in cut.items()} == {i: [w for w, g in zip(words[i], gone[i], strict=True) if not g] for i in words}
    assert all(cut[i]["text"] == near_kept[i]["text"] for i in gone if not any(gone[i]))
    assert set(clean) == set(cut) and not any(base_spans(r["text"]) for r in clean.values())
    assert all(r["n_chars"] == len(r["text"]) for r in clean.values())
    assert all(clean[i]["text"] == cut[i]["text"] for i in clean if not base_spans(cut[i]["text"]) and "[SECRET]" not in clean[i]["text"])
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == set(clean)
    assert corpus_pipeline.run(spark, sf).count() == pieces.count()


def test_pipeline_stages_on_odd_rows(spark, sf):
    rows = [(1, None, "x"), (1, "a b", None), (None, "token=abcdefgh", "y"), (2, "", "z"), (3, "w " * 5000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    for name in ("_gone", "_GONE_", "rep", "kept", "carried", "part", "at", "n"):  # names the operators use themselves
        docs = docs.withColumn(name, F.lit("own"))
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() >= 4
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= 5
    assert corpus_pipeline.STAGES[0][1](spark, docs, sf).columns == docs.columns

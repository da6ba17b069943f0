"""SentencePiece, packing and the dedup operators against brute force on whole tables and small odd ones."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cartstream.llm import near_duplicates, packing, phrases, queries, repeats, suffix_array
from cartstream.llm import sentencepiece as sp

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    "", " ", "   ", "a", "▁", "▁▁ ▁x", "a▁b  c   d ", "\t\n\r\x00", "naïve ﬁ ① 你好 世界 ", "😀👍🏽 flag 🇫🇷", "<s> </s> <unk> <0x41>",
    "x" * 3000, "ab" * 2000, " " * 700, "aaaa bbbb" * 50, "Zürich Straße end", "é é", "<|endoftext|> y",
]
EMPTY: list = []


def sha(raw):
    return hashlib.sha256(raw if isinstance(raw, bytes) else raw.encode()).hexdigest()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# -- SentencePiece -----------------------------------------------------------

def test_encoding_is_the_librarys(spark, sf, corpus):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = by_id(queries.op1_sentencepiece(spark, sf))
    assert len(got) == len(corpus)
    for i, text in corpus:
        ids = model.encode(text, add_bos=True, add_eos=True)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert got[i]["decoded_sha256"] == sha(model.decode(ids))


def test_odd_texts_are_encoded_as_by_the_library():
    model, own = sentencepiece.SentencePieceProcessor(model_file=MODEL), sp.encoder(MODEL)
    rng = random.Random(5)
    letters = "abcdefghinorst  ▁.\n1éß你😀"
    for text in [*ODD, *("".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(3000))]:
        ids = model.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids, text
        assert own.decode(own.encode(text)) == model.decode(ids)


def test_encoding_of_odd_rows(docs):
    rows = [(1, None), (2, ""), (None, "a"), (3, "a"), (3, "a")]
    got = sorted(map(tuple, sp.encode_documents(docs(rows), MODEL, digests=True).select("doc_id", "n_tokens").collect()), key=str)
    assert got == sorted([(1, 2), (2, 2), (None, 3), (3, 3), (3, 3)], key=str)
    full = sp.encode_documents(docs([(1, "a b")]), MODEL).collect()[0]
    assert full["decoded"] == "a b" and len(full["ids"]) == 4 * full["n_tokens"]
    assert sp.encode_documents(docs(EMPTY), MODEL).count() == 0


# -- packing -----------------------------------------------------------------

def check_pieces(pieces, tokens, width):
    placed, whole = defaultdict(list), defaultdict(list)
    for p in pieces:
        own = tokens[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert p["length"] == len(own) > 0 and p["doc_tokens"] == len(tokens[p["doc_id"]])
        assert p["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
        placed[p["sequence_id"]].append((p["offset"], p["length"]))
        whole[p["doc_id"]].append((p["start"], p["length"]))
    for parts in [*placed.values(), *whole.values()]:
        at = 0
        for begin, length in sorted(parts):
            assert begin == at
            at += length
        assert parts not in placed.values() or at <= width
    sizes = {s: sum(n for _, n in parts) for s, parts in placed.items()}
    assert sorted(sizes) == list(range(len(sizes))) and all(sizes[s] == width for s in range(len(sizes) - 1))


def test_pieces_hold_each_token_once(spark, sf, corpus):
    library = Tokenizer.from_file(BPE[0])
    tokens = {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in corpus}
    pieces = queries.op6_packing(spark, sf).collect()
    check_pieces(pieces, tokens, 2048)
    assert sum(p["length"] for p in pieces) == sum(map(len, tokens.values()))


def test_packing_of_odd_rows(docs):
    library = Tokenizer.from_file(BPE[0])
    library.encode_special_tokens = True
    rows = [*enumerate(ODD), (90, None)]
    pieces = packing.pack(docs(rows), *BPE, width=64).collect()
    check_pieces(pieces, {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}, 64)
    assert all(len(p["ids"]) == 4 * p["length"] for p in pieces)
    assert packing.pack(docs(EMPTY), *BPE).count() == 0
    assert packing.pack(docs([(None, "a"), (1, "b"), (1, "b")]), *BPE).count() == 3


# -- near-duplicates ---------------------------------------------------------

def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def near_by_force(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    parent, holders = {i: i for i in sets}, defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in holders[s])
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            holders[s].append(i)
    return {i: (i, len(sets[i]), find(i), find(i) == i) for i in sets}


def test_the_share_asked_for_follows_the_percentage(docs):
    assert near_duplicates.least_shared(85) == near_duplicates.least_shared(80) == 0.6 > near_duplicates.least_shared(70)
    rng, rows = random.Random(7), []
    for k in range(60):
        words = [f"w{k}x{j}" for j in range(2000)]
        other = list(words)
        for at in rng.sample(range(0, 2000, 5), 88):  # similarity a little above 0.6
            other[at] += "y"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    got = {r[0]: tuple(r) for r in near_duplicates.near_duplicates(docs(rows), 60).collect()}
    want = near_by_force(rows, 60)
    assert sum(r[2] != r[0] for r in want.values()) >= 55 and got == want


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_of_a_whole_table(docs, corpus, percent):
    got = {r[0]: tuple(r) for r in near_duplicates.near_duplicates(docs(corpus), percent).collect()}
    assert got == near_by_force(corpus, percent)


def variants(n, words=120, edits=3, seed=3):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        yield " ".join(own)


def test_a_large_group_of_variants_is_compared_in_blocks(docs, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK_DOCS", 16)
    rows = [(k, t) for k, t in enumerate([*variants(150), *variants(60, edits=8, seed=4), *["same text of five words"] * 40])]
    got = {r[0]: tuple(r) for r in near_duplicates.near_duplicates(docs(rows), 85).collect()}
    assert got == near_by_force(rows, 85)


def test_near_duplicates_of_odd_rows(docs):
    rows = [(5, "A b"), (6, "a\tB"), (7, ""), (8, None), (9, " \n"), (10, "a b c"), (11, "é É"), (12, "É É")]
    got = {r[0]: tuple(r) for r in near_duplicates.near_duplicates(docs(rows)).collect()}
    assert got == near_by_force(rows, 85)
    got = near_duplicates.near_duplicates(docs([(None, "a"), (None, "a"), (1, "a"), (1, "b"), (2, "b"), (2, "b")])).collect()
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got), key=str) == sorted(
        [(None, None, True)] * 2 + [(1, 1, True)] * 2 + [(2, 1, False)] * 2, key=str)
    assert near_duplicates.near_duplicates(docs(EMPTY)).count() == 0


# -- repeated runs -----------------------------------------------------------

def removed_by_force(sequences, width):
    """Which symbols of each sequence are covered by a window that an earlier sequence has."""
    seen, out = set(), {}
    for i in sorted(sequences):
        own, gone = sequences[i], [False] * len(sequences[i])
        windows = [tuple(own[p : p + width]) for p in range(len(own) - width + 1)]
        for p, w in enumerate(windows):
            if w in seen:
                gone[p : p + width] = [True] * width
        seen.update(windows)
        out[i] = gone
    return out


def check_bytes(got, rows):
    raw = {i: (t or "").encode() for i, t in rows}
    for i, gone in removed_by_force(raw, 50).items():
        kept = bytes(c for c, g in zip(raw[i], gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        assert tuple(got[i][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) == (len(gone), sum(gone), spans, sha(kept)), i


def check_words(got, rows, width=13):
    words = {i: WORD.findall(t or "") for i, t in rows}
    for i, gone in removed_by_force(words, width).items():
        kept = " ".join(w for w, g in zip(words[i], gone, strict=True) if not g)
        assert tuple(got[i][c] for c in ("n_words", "n_removed", "kept_sha256")) == (len(gone), sum(gone), sha(kept)), i


def test_repeated_runs_of_a_whole_table(spark, sf, corpus):
    check_bytes(by_id(queries.op2_suffix_array_dedup(spark, sf)), corpus)
    check_words(by_id(queries.op5_substring_dedup(spark, sf)), corpus)


def mixed_texts(seed, n=120):
    """Texts of a small vocabulary that share lines, passages and whole copies, with all kinds of white space."""
    rng = random.Random(seed)
    some = lambda k: " ".join(rng.choice(["a", "bb", "the", "of", "é", "zzz", "x.", "Q"]) for _ in range(k))
    line, passages = some(15), [some(40) for _ in range(4)]
    rows = []
    for k in range(n):
        parts = [some(rng.randint(0, 30)), *rng.sample([line, *passages], rng.randint(0, 3)), some(rng.randint(0, 20))]
        rows.append((k, rng.choice(["\n", "  ", "\t", " "]).join(parts) if rng.random() > 0.1 or not rows else rng.choice(rows)[1]))
    return [*rows, (500, "a " * 400), (501, "a " * 450), (502, "z" * 300), (503, "z" * 49), (504, None), (505, ""), (506, "ab" * 3000)]


@pytest.mark.parametrize("small", [False, True])
def test_repeated_runs_of_mixed_texts(docs, monkeypatch, small):
    if small:  # every limit is met: cut texts, cut runs, split anchors
        monkeypatch.setattr(repeats, "PIECE", 100)
        monkeypatch.setattr(suffix_array, "CHUNK_ROWS", 5)
        monkeypatch.setattr(suffix_array, "LONG_RUN", 12)
        monkeypatch.setattr(phrases, "AUTOMATON_TEXTS", 4)
        monkeypatch.setattr(phrases, "HOT_BLOCKS", 2)
    for seed in (1, 2):
        rows = mixed_texts(seed)
        check_bytes(by_id(suffix_array.remove_repeated_bytes(docs(rows))), rows)
        check_words(by_id(phrases.remove_repeated_words(docs(rows))), rows)


def test_repeated_runs_of_odd_rows(docs):
    long = " ".join(f"word{k}" for k in range(20))
    rows = [(3, long), (3, long), (None, long), (4, long), (2, "short")]
    cut = lambda df, n: sorted(((r["doc_id"], r[n]) for r in df.collect()), key=str)
    whole = len(long)
    assert cut(suffix_array.remove_repeated_bytes(docs(rows)), "n_removed") == sorted([(3, 0), (3, 0), (None, 0), (4, whole), (2, 0)], key=str)
    assert cut(phrases.remove_repeated_words(docs(rows)), "n_removed") == sorted([(3, 0), (3, 0), (None, 0), (4, 20), (2, 0)], key=str)
    assert suffix_array.remove_repeated_bytes(docs(EMPTY)).count() == phrases.remove_repeated_words(docs(EMPTY)).count() == 0


def test_the_text_that_stays_keeps_its_white_space(docs):
    passage = " ".join(f"p{k}" for k in range(13))
    rows = [(1, f"one {passage}"), (2, f"before\n\n{passage}\n  after  it\n"), (3, passage)]
    got = by_id(phrases.remove_repeated_words(docs(rows), carry=["lang", "text"]))
    assert (got[2]["text"], got[2]["kept"], got[3]["text"]) == ("before\n\nafter  it\n", "before after it", "")
    assert got[2]["carried"]["lang"] == "en" and got[2]["carried"]["text"] == rows[1][1]

"""SentencePiece BPE by a prefix table.

For a BPE vocabulary every prefix of a string has exactly one last token. The table stores it
for each prefix: an Aho-Corasick automaton lists the pieces that end there, and the one that is compatible with
the last token of the prefix before it is the right one. Two tokens are compatible when
encoding their joined text gives just these two. The ids are then read off backwards.

No piece of the vocabulary has a word boundary after another character, so a text is a chain of words that
are encoded on their own; frequent words come from a bounded memo.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
MEMO_WORDS = 400_000
MEMO_PAIRS = 400_000
MEMO_LENGTH = 64


class PrefixTableEncoder:
    """Encodes texts as the library does for an identity-normalised BPE model with byte fallback."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.model = model
        size = model.get_piece_size()
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        self.text = [model.id_to_piece(i) for i in range(size)]
        self.score = [model.get_score(i) for i in range(size)]
        self.ids = {self.text[i]: i for i in range(size) if i not in special and not model.is_unused(i)}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.begin, self.end = model.bos_id(), model.eos_id()
        for piece in self.ids:
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"a piece crosses a word boundary: {piece!r}")
            if any(c not in self.ids for c in piece):
                raise ValueError(f"a piece has a character without a piece of its own: {piece!r}")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            # A piece that its own text is not encoded to is never a token.
            if self._merge(piece) == [i]:
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}

    def _merge(self, text: str) -> list[int]:
        """Plain pair merging, for the short texts of pieces and pairs of pieces only."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts]

    def _compatible(self, left: int, right: int) -> bool:
        pair = (left, right)
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[pair] = self._merge(self.text[left] + self.text[right]) == [left, right]
        return known

    def _known(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are pieces."""
        last = [-1] * (len(text) + 1)
        size = [0] * (len(text) + 1)
        for at, (token, n) in self.automaton.iter(text):
            stop = at + 1
            if last[stop] < 0 and (stop == n or (last[stop - n] >= 0 and self._compatible(last[stop - n], token))):
                last[stop], size[stop] = token, n
        out, stop = [], len(text)
        while stop:
            out.append(last[stop])
            stop -= size[stop]
        return out[::-1]

    def _word(self, word: str) -> bytes:
        out: list[int] = []
        known: list[str] = []
        for c in word:
            if c in self.ids:
                known.append(c)
                continue
            if known:
                out += self._known("".join(known))
                known = []
            out += [self.bytes[b] for b in c.encode()]
        if known:
            out += self._known("".join(known))
        packed = struct.pack(f"<{len(out)}I", *out)
        if len(word) <= MEMO_LENGTH:
            if len(self.words) >= MEMO_WORDS:
                self.words.clear()
            self.words[word] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids, begin and end included, as little-endian unsigned 32-bit integers."""
        if not text:
            return struct.pack("<2I", self.begin, self.end)
        words = _WORD.findall(SPACE + text.replace(" ", SPACE))
        known, learn = self.words.get, self._word
        body = b"".join([known(w) or learn(w) for w in words])
        return struct.pack("<I", self.begin) + body + struct.pack("<I", self.end)

    def decode(self, ids: bytes) -> str:
        return self.model.decode(np.frombuffer(ids, "<u4").tolist())


_ENCODERS: dict[str, PrefixTableEncoder] = {}


def encoder(path: str) -> PrefixTableEncoder:
    """One encoder per Python worker and model."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PrefixTableEncoder(path)
    return _ENCODERS[path]


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
IDS_SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string"


def encode_documents(docs: DataFrame, model_path: str, digests: bool = False) -> DataFrame:
    """Encode the `text` of every row and decode it again.

    Returns one row per input row: doc_id, n_tokens, and either ids (little-endian unsigned
    32-bit integers, begin and end included) with the decoded text, or, with `digests`, their SHA-256 values.
    A null text counts as empty and has the begin and end ids only; a null doc_id stays null; repeated rows each
    give a row; other columns are ignored. A map over the scan: nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_path)
        for batch in batches:
            n, first, second = [], [], []
            for text in batch.column(1).to_pylist():
                ids = enc.encode(text or "")
                decoded = enc.decode(ids)
                n.append(len(ids) // 4)
                first.append(hashlib.sha256(ids).hexdigest() if digests else ids)
                second.append(hashlib.sha256(decoded.encode()).hexdigest() if digests else decoded)
            kind = pa.string() if digests else pa.binary()
            names = ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(first, kind), pa.array(second, pa.string())], names=names
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, SCHEMA if digests else IDS_SCHEMA)

"""Fill-in-the-middle: a text cut into prefix, middle and suffix at two drawn units, and put in another order.

A unit is a word with the white space before it, or white space at the end of a text. To find the cuts, texts are cut into chunks
where a rolling hash of the last bytes says so, so equal passages give equal chunks wherever they stand. What a chunk adds to
its text (word ends inside it, code points, whether it begins and ends blank) is remembered by the chunk's whole content. The
counts of a text's chunks, with the words that end between two of them, add up to its units and lead to the one chunk a
cut falls in; only that chunk is looked into.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartstream.llm.common import id_and_text
from cartstream.llm.textarrays import SEPARATORS, byte_values, flatten

SPAN = 16  # bytes the rolling hash looks at
CHUNK = 1024  # mean bytes of a chunk, a power of two
LONGEST = 16 * CHUNK  # a longer one is cut
SLICE = 1 << 20  # bytes hashed at once
MEMO_BYTES = 32 << 20

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_FOLLOWING = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that do not begin a code point
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Marks:
    """The strings put before the three parts; texts that hold one of them are left plain."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def rolling(values: np.ndarray) -> np.ndarray:
    """A hash of the `SPAN` values up to each one (fewer at the beginning), by doubling."""
    out, have = values.copy(), 1
    factor = _BASE
    while have < SPAN:
        longer = out.copy()
        longer[have:] += out[:-have] * factor
        out, have, factor = longer, have * 2, factor * factor
    return out


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks end: after bytes with a rolling hash of zero top bits, at text ends, and `LONGEST` bytes after the last end."""
    values, shift = byte_values(12, False), np.uint64(64 - CHUNK.bit_length() + 1)
    found = [offsets[1:]]
    for begin in range(0, len(data), SLICE):
        first = max(0, begin - SPAN + 1)
        with np.errstate(over="ignore"):
            hashes = rolling(values[data[first : begin + SLICE]])[begin - first :]
        found.append(np.flatnonzero((hashes >> shift) == 0) + begin + 1)
    ends = np.unique(np.concatenate(found))
    ends = ends[ends > 0]
    gaps = np.diff(ends, prepend=0)
    extra = (gaps - 1) // LONGEST
    if extra.any():
        at = np.repeat(ends - gaps, extra)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        ends = np.unique(np.concatenate([ends, at + nth * LONGEST]))
    return ends


def summary(chunk: bytes) -> tuple[int, int, bool, bool]:
    """Word ends before the chunk's end, code points, begins blank, ends blank."""
    opens, closes = chunk[0] in SEPARATORS, chunk[-1] in SEPARATORS
    return len(chunk.split()) - (not closes), len(chunk.translate(None, _FOLLOWING)), opens, closes


class Memo(dict):
    """Summaries by the chunks' content: equal only if every byte is. Forgotten when the chunks take `MEMO_BYTES`."""

    def __init__(self):
        super().__init__()
        self.size = 0

    def __missing__(self, chunk: bytes):
        self.size += len(chunk) + 200
        if self.size > MEMO_BYTES:
            self.clear()
            self.size = len(chunk) + 200
        self[chunk] = out = summary(chunk)
        return out


class Units:
    """Units of a batch's texts, from the summaries of its chunks."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, memo: Memo):
        self.raw, self.offsets = memoryview(data), offsets
        self.ends = chunk_ends(data, offsets) if len(data) else np.zeros(0, np.int64)
        self.begins = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)[: len(self.ends)]
        table = np.array(
            [memo[self.raw[a:b].tobytes()] for a, b in zip(self.begins.tolist(), self.ends.tolist(), strict=True)], np.int64
        ).reshape(-1, 4)
        self.inner, self.points, opens, closes = table.T
        # A word that ends with its chunk: the next one begins blank, or the text is over.
        follows = np.append(opens[1:], 1).astype(bool) | np.isin(self.ends, offsets[1:])
        self.words = self.inner + (follows & (closes == 0))
        self.first = np.searchsorted(self.begins, offsets)

    def text(self, k: int) -> Text:
        lo, hi = self.first[k], self.first[k + 1]
        return Text(self, int(self.offsets[k]), int(self.offsets[k + 1]), lo, hi)


class Text:
    """One text: its number of units, and where a unit begins."""

    def __init__(self, units: Units, begin: int, end: int, lo: int, hi: int):
        self.units, self.begin, self.end, self.lo = units, begin, end, lo
        self.upto = np.cumsum(units.words[lo:hi])
        self.n_words = int(self.upto[-1]) if hi > lo else 0
        self.n = self.n_words + (end > begin and units.raw[end - 1] in SEPARATORS)

    def cut(self, unit: int) -> int:
        """The byte after the first `unit` units."""
        if unit == 0:
            return self.begin
        if unit > self.n_words:
            return self.end
        at = int(np.searchsorted(self.upto, unit))
        chunk = self.lo + at
        nth = unit - (int(self.upto[at - 1]) if at else 0)
        begin, end = int(self.units.begins[chunk]), int(self.units.ends[chunk])
        if nth > self.units.inner[chunk]:
            return end
        return begin + next(islice(_WORD.finditer(self.units.raw[begin:end]), nth - 1, None)).end()

    def points(self, a: int, b: int) -> int:
        """Code points between two bytes: whole chunks from their summaries, the rest counted."""
        units = self.units
        first, last = np.searchsorted(units.begins, a), np.searchsorted(units.ends, b, side="right")
        count = lambda i, j: len(units.raw[i:j].tobytes().translate(None, _FOLLOWING))
        if first >= last:
            return count(a, b)
        return count(a, int(units.begins[first])) + int(units.points[first:last].sum()) + count(int(units.ends[last - 1]), b)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """The four numbers of a document; a null id draws as the word null."""
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def restore(output: bytes, form: str, marks: Marks = Marks()) -> bytes:
    """The text an output was made from. A mark cannot begin inside another, so each part ends at the next one's first mark."""
    if form == "plain":
        return output
    prefix, suffix, middle = (m.encode() for m in (marks.prefix, marks.suffix, marks.middle))
    one, two = (prefix, suffix) if form == "psm" else (suffix, prefix)
    a, rest = output.removeprefix(one).split(two, 1)
    b, c = rest.split(middle, 1)
    return a + c + b if form == "psm" else b + c + a


def _transform(text: Text, raw: memoryview, doc_id, seed, fim_percent, spm_percent, marks) -> tuple:
    h1, h2, h3, h4 = draws(doc_id, seed)
    whole = raw[text.begin : text.end].tobytes()
    prefix, suffix, middle = (m.encode() for m in (marks.prefix, marks.suffix, marks.middle))
    if not whole or h3 % 100 >= fim_percent or any(m in whole for m in (prefix, suffix, middle)):
        return "plain", None, None, whole
    low, high = sorted((text.cut(h1 % (text.n + 1)), text.cut(h2 % (text.n + 1))))
    a, b, c = whole[: low - text.begin], whole[low - text.begin : high - text.begin], whole[high - text.begin :]
    sizes = text.points(text.begin, low), text.points(low, high)
    if h4 % 100 < spm_percent:
        return "spm", *sizes, b"".join([suffix, c, prefix, a, middle, b])
    return "psm", *sizes, b"".join([prefix, a, suffix, c, middle, b])


FIELDS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def fill_in_middle(
    docs: DataFrame, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80, marks: Marks = Marks(),
    digests: bool = False,
) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and the output text.

    With `digests` output_sha256 and restored_sha256 (of the text rebuilt from output and form) in place of the output. A
    null text is empty, which stays plain with n = 0; a null doc_id draws a fixed place of its own; repeated rows give equal rows; other
    columns are ignored; an empty table gives no rows. Nothing is shuffled. The marks must not begin inside one another.
    """
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    if digests:
        schema, kinds, names = f"{FIELDS}, output_sha256 string, restored_sha256 string", [*kinds, pa.string(), pa.string()], [
            *names, "output_sha256", "restored_sha256"]
    else:
        schema, kinds, names = f"{FIELDS}, output string", [*kinds, pa.large_string()], [*names, "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo()
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            units = Units(*flatten(batch.column(1)), memo)
            rows = []
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                text = units.text(k)
                form, before, inside, out = _transform(text, units.raw, doc_id, seed, fim_percent, spm_percent, marks)
                last = (sha(out), sha(restore(out, form, marks))) if digests else (out.decode(),)
                rows.append((doc_id, text.n, form, before, inside, *last))
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([a.cast(pa.string()) if a.type == pa.large_string() else a for a in arrays], names=names)

    return id_and_text(docs).mapInArrow(run, schema)

"""Fill-in-middle: documents cut at two token boundaries found on a wavelet matrix, and their exact restoration.

A token is a run of ASCII letters or any other single character. Each byte of
a slice of texts has one of four classes: inside a run of letters, the first
letter of a run, any other character's first byte, or a later byte of a UTF-8
character. A wavelet matrix over the classes answers rank queries for all
documents of the slice at once: run starts plus other characters are the token
boundaries before a byte, and all bytes but the later ones are its code points.
A cut after k tokens is the last byte with at most k boundaries before it,
found by bisection on the ranks.

The parts are written in one of three forms (fixed values: the markers
``<P>``, ``<S>`` and ``<M>``): plain, the text; psm, prefix, suffix and middle, each behind its
marker; spm, suffix, prefix and middle. Four numbers from the SHA-256 of the
document's id decide cuts and form, so reruns and retries agree.

Defined results: NULL text is empty; empty texts and texts that hold a marker
are plain; a NULL id is hashed as the empty string; rows that share an id are
cut by the same numbers, each in its own text; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstream.llm.textvec import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
IN_RUN, RUN_START, OTHER, LATER_BYTE = range(4)

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


class BitRank:
    """A bit sequence with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.append(packed, np.zeros(-len(packed) % 8 + 8, np.uint8)).view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << rest) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Symbols of ``levels`` bits, highest bit first, each level stably parted by its bit."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels, self.bits, self.zeros = levels, [], []
        for level in reversed(range(levels)):
            bit = (symbols >> level & 1).astype(bool)
            self.bits.append(BitRank(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before each place."""
        low, high = np.zeros_like(at), at
        for level, (bits, zeros) in enumerate(zip(self.bits, self.zeros, strict=True)):
            a, b = bits.ones(low), bits.ones(high)
            low, high = (zeros + a, zeros + b) if symbol >> (self.levels - 1 - level) & 1 else (low - a, high - b)
        return high - low


def classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    letter = LETTER[data]
    follows = np.zeros(len(data), bool)
    follows[1:] = letter[:-1]
    follows[starts[:-1][starts[:-1] < len(data)]] = False
    return np.where(letter, np.where(follows, IN_RUN, RUN_START), np.where(data & 0xC0 == 0x80, LATER_BYTE, OTHER)).astype(np.uint8)


class Cutter:
    """Token counts and cuts of a slice's texts."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        self.wavelet = WaveletMatrix(classes(data, starts), 2)
        self.begin, self.end = starts[:-1], starts[1:]
        self.first = self._boundaries(self.begin)
        self.n = self._boundaries(self.end) - self.first

    def _boundaries(self, at: np.ndarray) -> np.ndarray:
        return self.wavelet.rank(RUN_START, at) + self.wavelet.rank(OTHER, at)

    def cut(self, tokens: np.ndarray) -> np.ndarray:
        """Each text's byte after its first ``tokens`` tokens: the last one with at most so many boundaries before it."""
        low, high, wanted = self.begin.copy(), self.end.copy(), self.first + tokens
        while (low < high).any():
            middle = (low + high + 1) // 2
            fits = self._boundaries(middle) <= wanted
            low, high = np.where(fits, middle, low), np.where(fits, high, np.maximum(middle - 1, low))
        return low

    def chars(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return end - begin - (self.wavelet.rank(LATER_BYTE, end) - self.wavelet.rank(LATER_BYTE, begin))


def numbers(doc_ids: list[int | None], seed: int) -> np.ndarray:
    """Four 32-bit numbers per document: the first digits of the SHA-256 of ``<seed>:<doc id>``."""
    digests = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in doc_ids)
    return np.frombuffer(digests, ">u4").reshape(-1, 4).astype(np.int64)


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def transform(df: DataFrame, seed: int = 1, fim_percent: int = 90, spm_percent: int = 20,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, tokens ``n``, ``form``, lengths of prefix and middle in code points, and the ``output`` text.

    ``fim_percent`` of the documents are cut, ``spm_percent`` of those are
    written suffix first; the rest is plain. Memory per task: one Arrow batch
    and the wavelet matrix (a few bits per byte) of one slice of it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, starts in slices(b.column(1)):
                yield _slice(b.column(0).slice(i, j - i), data, starts, seed, fim_percent, spm_percent)

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def _slice(ids: pa.Array, data: np.ndarray, starts: np.ndarray, seed: int, fim_percent: int, spm_percent: int) -> pa.RecordBatch:
    cutter = Cutter(data, starts)
    h = numbers(ids.to_pylist(), seed)
    one, two = h[:, 0] % (cutter.n + 1), h[:, 1] % (cutter.n + 1)
    a, b = cutter.cut(np.minimum(one, two)), cutter.cut(np.maximum(one, two))
    prefix_chars, middle_chars = cutter.chars(cutter.begin, a), cutter.chars(a, b)
    raw = data.tobytes()
    out, forms, plain = [], [], np.zeros(len(ids), bool)
    markers = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = markers
    for k in range(len(ids)):
        text = raw[starts[k]:starts[k + 1]]
        if not text or h[k, 2] % 100 >= fim_percent or any(x in text for x in markers):
            plain[k] = True
            forms.append("plain")
            out.append(text)
            continue
        x, y = a[k] - starts[k], b[k] - starts[k]
        spm = h[k, 3] % 100 < spm_percent
        forms.append("spm" if spm else "psm")
        out.append(b"".join((s, text[y:], p, text[:x], m, text[x:y]) if spm else (p, text[:x], s, text[y:], m, text[x:y])))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(cutter.n, pa.int64()), pa.array(forms, pa.string()), pa.array(prefix_chars, pa.int64(), mask=plain),
         pa.array(middle_chars, pa.int64(), mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The exact text again, from the output and its form (a cut text holds no marker of its own)."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))

    def part(text: Column, marker: str, n: int) -> Column:
        return F.split_part(text, F.lit(marker), F.lit(n))

    after_p, after_s = part(output, PREFIX, 2), part(output, SUFFIX, 2)
    psm = F.concat(part(after_p, SUFFIX, 1), part(after_s, MIDDLE, 2), part(after_s, MIDDLE, 1))
    spm = F.concat(part(after_p, MIDDLE, 1), part(after_p, MIDDLE, 2), part(after_s, PREFIX, 1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)

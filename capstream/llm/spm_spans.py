"""SentencePiece encoding that keeps, for every piece, the bytes of the original text it stands for.

The model's compiled character map (a double-array trie of byte strings with
their replacements) is applied by longest prefix; every normalised byte
remembers the source bytes it came from. The library's ids cut the normalised
text into pieces, so cumulated piece lengths look up each piece's source span.
Ids and decoded text are exactly the library's.

Defined results: NULL text is empty; an empty text has no ids and decodes to the
empty string; a byte piece spans its own byte where the source was copied and
its whole source where it was mapped; a space put in front by the model spans
nothing; NULL and repeated ids are ordinary rows; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SPACE = "▁".encode()
#: UTF-8 bytes of text encoded at a time (one longer text goes alone).
AT_ONCE = 2 << 20


class CharMap:
    """The compiled map: ``longest(data, at)`` gives (replacement, source bytes) or None."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size:]
        self.first = [self._step(0, c) is not None for c in range(256)] if self.units else [False] * 256
        self.known = functools.lru_cache(1 << 16)(self._longest)
        self.near = 32

    @staticmethod
    def _jump(unit: int) -> int:
        return (unit >> 10) << 8 if unit & 512 else unit >> 10

    def _step(self, node: int, byte: int) -> int | None:
        """The child of ``node`` by ``byte``: a unit whose label is the byte."""
        child = node ^ self._jump(self.units[node]) ^ byte
        return child if child < len(self.units) and self.units[child] & 0x800000FF == byte else None

    def _longest(self, data: bytes) -> tuple[tuple[bytes, int] | None, bool]:
        """The longest key ``data`` begins with, and whether a longer one might go on beyond it."""
        node, found = 0, None
        for n, byte in enumerate(data, 1):
            node = self._step(node, byte)
            if node is None:
                return found, False
            if self.units[node] >> 8 & 1:  # a value hangs below
                at = self.units[node ^ self._jump(self.units[node])] & 0x7FFFFFFF
                found = self.texts[at:self.texts.index(b"\0", at)], n
        return found, True

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        if not self.first[data[at]]:
            return None
        length = self.near  # short stretches are remembered; the walk itself goes to the trie's own end
        found, further = self.known(data[at:at + length])
        while further and at + length < len(data):
            length *= 4
            found, further = self._longest(data[at:at + length])
        return found


class Normalizer:
    """Normalises as the model says; ``run`` gives the text and each byte's source begin and end."""

    def __init__(self, spec, symbols: list[str] = (), suffix: bool = False):
        self.map = CharMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.symbols = sorted((s.encode() for s in symbols if s), key=len, reverse=True)
        self.suffix = suffix

    def run(self, data: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        if not self.map.units and not self.squeeze and not self.symbols and not self.suffix and self.escape:
            return self._copied(data)
        space = SPACE if self.escape else b" "
        out, begin, end = bytearray(), [], []

        def put(piece: bytes, a: int, b: int, exact: bool) -> None:
            out.extend(piece)
            begin.extend(range(a, b) if exact else [a] * len(piece))
            end.extend(range(a + 1, b + 1) if exact else [b] * len(piece))

        parts = self._parts(data)
        if self.squeeze:  # white space in front goes
            parts = self._skip(parts)
        before, started = self.squeeze, False
        for piece, a, b, exact in parts:
            if not started:
                started = True
                if self.prefix and not self.suffix:
                    put(space, a, a, False)
            if before:
                kept = piece.lstrip(b" ")
                exact, piece = exact and kept == piece, kept
            if not piece:
                continue
            before = self.squeeze and piece.endswith(b" ")
            if b" " in piece:
                for i, word in enumerate(piece.split(b" ")):
                    if i:
                        put(space, a, b, False)
                    put(word, a, b, False)
            else:
                put(piece, a, b, exact)
        if self.squeeze:
            while out.endswith(space):
                del out[-len(space):], begin[-len(space):], end[-len(space):]
        if self.prefix and self.suffix and started:
            put(space, len(data), len(data), False)
        return bytes(out), np.array(begin, np.int64), np.array(end, np.int64)

    @staticmethod
    def _skip(parts):
        parts = iter(parts)
        for p in parts:
            if p[0] != b" ":
                yield p
                break
        yield from parts

    def _parts(self, data: bytes) -> Iterator[tuple[bytes, int, int, bool]]:
        """(replacement, source begin, source end, copied?) by longest prefix."""
        at = 0
        while at < len(data):
            symbol = next((s for s in self.symbols if data.startswith(s, at)), None)
            found = None if symbol else self.map.longest(data, at)
            if found:
                yield found[0], at, at + found[1], False
                at += found[1]
            else:
                lead = data[at]
                n = len(symbol) if symbol else 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                yield data[at:at + n], at, min(at + n, len(data)), True
                at += n

    def _copied(self, data: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """No map and no squeezing: spaces are written as their symbol, all else is copied."""
        if not data:
            return b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
        raw = np.frombuffer(data, np.uint8)
        begin = np.repeat(np.arange(len(raw)), np.where(raw == 32, 3, 1))
        text, end = data.replace(b" ", SPACE), begin + 1
        if self.prefix:
            nothing = np.zeros(3, np.int64)
            return SPACE + text, np.concatenate([nothing, begin]), np.concatenate([nothing, end])
        return text, begin, end


class SpanEncoder:
    def __init__(self, model_file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        symbols = [p.piece for p in model.pieces if p.type == p.USER_DEFINED]
        self.normalizer = Normalizer(model.normalizer_spec, symbols, model.trainer_spec.treat_whitespace_as_suffix)
        # bytes of normalised text a piece covers; an unknown piece's length depends on the text
        self.width = np.array([1 if p.type == p.BYTE else len(p.piece.encode()) for p in model.pieces], np.int64)
        self.unknown = self.sp.unk_id()
        self.decimal = [str(i) for i in range(len(model.pieces))]

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, str]]:
        """(ids, span begins, span ends, decoded text) of each text; spans are UTF-8 byte offsets."""
        ids = self.sp.encode(texts, num_threads=1)
        decoded = self.sp.decode(ids, num_threads=1) if ids else []
        for text, own, back in zip(texts, ids, decoded, strict=True):
            if not own:
                yield own, np.zeros(0, np.int64), np.zeros(0, np.int64), back
                continue
            normal, begin, end = self.normalizer.run(text.encode())
            tokens = np.array(own)
            width = self.width[tokens]
            if (tokens == self.unknown).any():
                pieces = self.sp.encode(text, out_type=str)
                width = np.array([len(p.encode()) if t == self.unknown else w for p, t, w in zip(pieces, own, width, strict=True)])
            stop = np.cumsum(width)
            if stop[-1] != len(normal):
                raise ValueError("pieces and normalised text differ in length")
            yield own, begin[stop - width], end[stop - 1], back


@functools.lru_cache(1)
def worker_encoder(model_file: str) -> SpanEncoder:
    """One encoder per worker process, kept between tasks."""
    return SpanEncoder(model_file)


SPANS = "ids array<int>, begins array<int>, ends array<int>, decoded string"


def spans(ids: list[int], begins: np.ndarray, ends: np.ndarray, decoded: str, encoder: SpanEncoder) -> dict:
    """The operator's own columns (``SPANS``)."""
    return {"ids": ids, "begins": begins, "ends": ends, "decoded": decoded}


def digests(ids: list[int], begins: np.ndarray, ends: np.ndarray, decoded: str, encoder: SpanEncoder) -> dict:
    """Counts and hashes of one document (``DIGESTS``)."""
    told = ",".join([encoder.decimal[i] for i in ids])
    return {"n_tokens": len(ids), "ids_sha256": hashlib.sha256(told.encode()).hexdigest(),
            "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest(),
            "spans_sha256": hashlib.sha256(np.stack([begins, ends], 1).astype("<i8").tobytes()).hexdigest()}


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string"


def encode_spans(df: DataFrame, model_file: str, per_doc: Callable[..., dict] = spans, schema: str = SPANS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and what ``per_doc`` makes of its ids, spans and decoded text."""
    full = f"doc_id long, {schema}"
    target = to_arrow_schema(StructType.fromDDL(full))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder(model_file)
        for b in batches:
            ids, texts, sizes = b.column(0).to_pylist(), b.column(1), b.column(2).to_numpy(False)
            i = 0
            while i < len(ids):
                j = max(i + 1, int(np.searchsorted(np.cumsum(sizes[i:]), AT_ONCE, "right")) + i)
                some = [t or "" for t in texts.slice(i, j - i).to_pylist()]
                rows = [{"doc_id": k, **per_doc(*x, enc)} for k, x in zip(ids[i:j], enc.encode(some), strict=True)]
                yield pa.RecordBatch.from_pylist(rows, target)
                i = j

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                     F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("bytes")).mapInArrow(run, full)

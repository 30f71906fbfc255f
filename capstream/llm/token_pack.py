"""Token-id files with fixed-width bit packing.

Every id takes ``bits`` bits, the fewest that hold the vocabulary. A file is

    blocks   BLOCK ids each (the last one shorter, padded to 8 ids), packed
             little-endian; 8 ids fill exactly ``bits`` bytes
    docs     int64 doc ids, uint8 null flags, uint64 first id of each document
    offsets  uint64 byte offset of every block
    footer   FOOTER: magic, bits, block size, ids, documents, blocks, offset of ``docs``

so any range of ids is read by a range read of its blocks and unpacked by a few
numpy operations. Files hold documents in ascending id order, file by file;
the manifest that Spark commits lists the files that count.

Defined results: NULL text is empty; an empty document holds only the end id;
NULL doc ids sort first; documents that share an id are ordered by a hash of
the text; an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from capstream.llm.filestore import attempt_name, create, open_file
from capstream.llm.textvec import SPACE, slices
from capstream.session import shared_path

MAGIC = b"CAPBITS1"
FOOTER = struct.Struct("<8sIIQQQQ")
BLOCK = 4096
#: Pre-tokens whose ids a worker remembers.
REMEMBERED = 700_000
#: UTF-8 bytes of text encoded at a time (one longer text goes alone).
AT_ONCE = 8 << 20


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` (count a multiple of 8) at ``bits`` bits each, little-endian."""
    word = np.uint32 if bits <= 25 else np.uint64  # with a shift of up to 7 bits
    rows = ids.reshape(-1, 8).astype(word)
    out = np.zeros((len(rows), bits), np.uint8)
    for j in range(8):
        at, shift = divmod(j * bits, 8)
        v = rows[:, j] << word(shift)
        for k in range((shift + bits + 7) // 8):
            out[:, at + k] |= (v >> word(8 * k)).astype(np.uint8)
    return out.tobytes()


def unpack(data: bytes, bits: int) -> np.ndarray:
    """Inverse of ``pack``: uint32 ids."""
    rows = np.frombuffer(data, np.uint8).reshape(-1, bits)
    word = np.uint32 if bits <= 25 else np.uint64
    out = np.empty((len(rows), 8), np.uint32)
    for j in range(8):
        at, shift = divmod(j * bits, 8)
        v = np.zeros(len(rows), word)
        for k in range((shift + bits + 7) // 8):
            v |= rows[:, at + k].astype(word) << word(8 * k)
        out[:, j] = (v >> word(shift)) & word((1 << bits) - 1)
    return out.ravel()


class PackWriter:
    """Streams documents into one file; holds one block of ids and the document table."""

    def __init__(self, folder: str, name: str, bits: int, block: int = BLOCK):
        self.out, self.path = create(folder, name)
        self.bits, self.block = bits, block
        self.rest, self.held = [], 0
        self.offsets, self.at, self.n = [], 0, 0
        self.ids, self.starts = [], []

    def add(self, doc_id: int | None, tokens: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.starts.append(self.n)
        self.n += len(tokens)
        self.rest.append(tokens)
        self.held += len(tokens)
        if self.held >= 64 * self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        held = np.concatenate(self.rest) if self.rest else np.zeros(0, np.uint32)
        end = len(held) if last else len(held) // self.block * self.block
        ids = held[:end]
        data = pack(np.pad(ids, (0, -len(ids) % 8)), self.bits)
        self.offsets += range(self.at, self.at + len(data), self.block // 8 * self.bits)
        self.out.write(data)
        self.at += len(data)
        self.rest, self.held = [held[end:]], len(held) - end

    def close(self) -> None:
        self._flush(True)
        docs = (np.array([0 if i is None else i for i in self.ids], "<i8").tobytes()
                + np.array([i is None for i in self.ids], np.uint8).tobytes() + np.array(self.starts, "<u8").tobytes())
        self.out.write(docs + np.array(self.offsets, "<u8").tobytes())
        self.out.write(FOOTER.pack(MAGIC, self.bits, self.block, self.n, len(self.ids), len(self.offsets), self.at))
        self.out.close()


class PackReader:
    """Random access to one file: document table and block offsets in memory, ids by range reads."""

    def __init__(self, path: str):
        self.f = open_file(path)
        size = self.f.size()
        magic, self.bits, self.block, self.n, docs, blocks, self.end = FOOTER.unpack(self.f.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a packed token file")
        table = self.f.read_at(docs * 17 + blocks * 8, self.end)
        self.doc_ids = np.frombuffer(table, "<i8", docs)
        self.null = np.frombuffer(table, np.uint8, docs, docs * 8)
        self.starts = np.append(np.frombuffer(table, "<u8", docs, docs * 9).astype(np.int64), self.n)
        self.offsets = np.append(np.frombuffer(table, "<u8", blocks, docs * 17).astype(np.int64), self.end)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        data = self.f.read_at(int(self.offsets[last + 1] - self.offsets[first]), int(self.offsets[first]))
        return unpack(data, self.bits)[start - first * self.block:stop - first * self.block]

    def documents(self, at_once: int = 1 << 20) -> Iterator[tuple[int, Iterator[np.ndarray]]]:
        """(index, ids in pieces of at most ``at_once``) of every document, neighbours read together."""
        i = 0
        while i < len(self.doc_ids):
            j = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + at_once, "right")) - 1)
            if j == i + 1:
                a, b = int(self.starts[i]), int(self.starts[j])
                yield i, (self.read(k, min(b, k + at_once)) for k in range(a, b, at_once))
            else:
                ids = self.read(int(self.starts[i]), int(self.starts[j]))
                for k in range(i, j):
                    yield k, iter([ids[self.starts[k] - self.starts[i]:self.starts[k + 1] - self.starts[i]]])
            i = j

    def close(self) -> None:
        self.f.close()


def id_width(bits: int) -> str:
    return "<u2" if bits <= 16 else "<u4"


class CachedEncoder:
    """The tokenizers library's ids, remembering those of repeated strings.

    A byte-level pre-tokenizer starts a new pre-token at a space that stands
    between two characters that are not white space, so a text may be cut
    before each such space and the units between encoded apart with the same
    ids; a unit's pre-tokens, in turn, are encoded apart. Texts with other white
    space beside a space, or with the text of an added token, go to the library
    whole; so does every text of a tokenizer with another pre-tokenizer.
    """

    def __init__(self, tokenizer_file: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(tokenizer_file)
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        own, byte_level = spec.get("pre_tokenizer") or {}, {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.cuttable = spec.get("normalizer") is None and all(own.get(k) == v for k, v in byte_level.items())
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.bits = max(1, (self.tok.get_vocab_size() - 1).bit_length())
        self.width = id_width(self.bits)
        self.code = "H" if self.width == "<u2" else "I"
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall
        self.known: dict[str, bytes] = {}  # pre-token -> ids
        self.end = self._bytes([end_id])

    def _bytes(self, ids: list[int]) -> bytes:
        a = array(self.code, ids)
        if sys.byteorder == "big":
            a.byteswap()
        return a.tobytes()

    def _library(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _table(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pre-tokens; new ones are remembered while there is room (the first ones met are the frequent ones)."""
        out = list(map(self.known.get, pieces))
        new = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(new, self._library([pieces[i] for i in new]), strict=True):
            out[i] = x
        room = max(0, REMEMBERED - len(self.known))
        self.known.update([(pieces[i], out[i]) for i in new[:room] if len(pieces[i]) <= 64])
        return out

    def _odd(self, texts: pa.Array, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Rows with a space before other white space or at their end, or with an added token."""
        if not self.cuttable:
            return np.ones(len(texts), bool)
        space = np.flatnonzero(data == 32)
        row = np.searchsorted(starts, space, "right") - 1
        follows = np.append(data, 32)[space + 1]
        odd = np.zeros(len(texts), bool)
        odd[row[(space + 1 == starts[row + 1]) | SPACE[follows] | ((follows >= 28) & (follows < 32))]] = True
        # lead bytes of white space beyond ASCII: look at those texts
        for r in np.unique(row[np.isin(follows, (0xC2, 0xE1, 0xE2, 0xE3))]):
            odd[r] |= any(u[:1].isspace() for u in texts[r].as_py().split(" ")[1:])
        for content in self.added:
            odd |= pc.match_substring(texts, content).to_numpy(False)
        return odd

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
        """(rows, their ids as little-endian binaries, the end id last); ``texts`` is a string array without NULLs.

        Units are told apart by Arrow; only the distinct ones of a slice are looked up.
        """
        for i, j, data, starts in slices(texts, AT_ONCE):
            part = texts.slice(i, j - i)
            odd = self._odd(part, data, starts)
            rows = np.flatnonzero(odd)
            if len(rows):
                yield rows + i, pa.array([x + self.end for x in self._library(part.take(pa.array(rows)).to_pylist())], pa.binary())
            rows = np.flatnonzero(~odd)
            if len(rows):
                yield rows + i, self._units(part.take(pa.array(rows)))

    def _units(self, texts: pa.Array) -> pa.Array:
        """Ids of texts that may be cut before every space: from pre-tokens to units to texts."""
        split = pc.split_pattern(texts, " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets, flat = offsets - offsets[0], split.flatten()
        coded = flat.dictionary_encode()
        unit = coded.indices.to_numpy(False)
        units, heads = coded.dictionary.to_pylist(), flat.take(pa.array(offsets[:-1])).to_pylist()
        # a unit's first pre-token is the one with the space, so all units are split in one go; a text's first unit has no
        # space before it and is split apart (an empty one stands only there)
        spaced = [u for u in units if u]
        pieces = self.pieces(" " + " ".join(spaced)) if spaced else []
        inner = len(pieces)
        heads_at = []
        for h in heads:
            heads_at.append(len(pieces))
            pieces += self.pieces(h)
        kinds = pa.array(pieces, pa.string()).dictionary_encode()
        table, kind = self._table(kinds.dictionary.to_pylist()), kinds.indices.to_numpy(False)
        width = int(self.width[2])
        size = np.fromiter(map(len, table), np.int32, len(table)) // width
        ids = np.frombuffer(b"".join(table), self.width)
        ids = ids[_ranges((np.cumsum(size) - size)[kind], size[kind])]  # of all units, one after another
        upto = np.append(0, np.cumsum(size[kind]))
        begins = pc.starts_with(kinds.dictionary, " ").to_numpy(False)[kind[:inner]]
        first = upto[np.concatenate([np.flatnonzero(begins), heads_at]).astype(np.int64)]
        length = np.diff(np.append(first, upto[-1]))
        place = np.cumsum([u != "" for u in units]) - 1
        entry = place[unit]
        entry[offsets[:-1]] = len(spaced) + np.arange(len(heads))
        length = length[entry]
        ends = np.cumsum(length)[offsets[1:] - 1]
        rows = len(heads)
        out = np.full(int(length.sum()) + rows, np.frombuffer(self.end, self.width)[0], self.width)
        token = np.ones(len(out), bool)
        token[ends + np.arange(rows)] = False
        out[token] = ids[_ranges(first[entry], length)]
        cuts = np.append(0, ends + 1 + np.arange(rows)) * width
        return pa.Array.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(out)])


def _ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers ``first`` to ``first + length`` - 1 of each entry, one after another."""
    return np.arange(int(length.sum()), dtype=np.int32) + np.repeat((first - (np.cumsum(length) - length)).astype(np.int32), length)


@functools.lru_cache(1)
def worker_encoder(tokenizer_file: str, end_id: int) -> CachedEncoder:
    """One encoder per worker process, kept between tasks."""
    return CachedEncoder(tokenizer_file, end_id)


def encode_and_pack(df: DataFrame, tokenizer_file: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
                    folder: str | None = None, n_files: int | None = None) -> str:
    """Encode every text, write packed files under ``folder`` and return the manifest table's path.

    Documents go to ``n_files`` ranges of doc id (default: the session's
    shuffle partitions) whose bounds come from a quantile sketch of the ids, so
    texts are encoded once, before the only shuffle, which moves 2 or 4 bytes a
    token. Memory per task: one Arrow batch of texts, one block of ids, the
    document table of one file.
    """
    spark = df.sparkSession
    folder = folder or shared_path(spark, "tokens")
    n = n_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = df.select(F.percentile_approx(F.col(id_col).cast("long"), [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0]
    bounds = np.array(cuts if cuts and n > 1 else [], np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder(tokenizer_file, end_id)
        for b in batches:
            part = np.searchsorted(bounds, b.column(0).fill_null(0).to_numpy(False), "right")
            part[b.column(0).is_null().to_numpy(False)] = 0
            for rows, ids in enc.encode(b.column(1).fill_null("")):
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays([pa.array(part[rows], pa.int32()), b.column(0).take(at), b.column(2).take(at), ids.cast(pa.binary())],
                                                 names=["part", "id", "tie", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part = None, None
        for b in batches:
            for p, doc, _, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    from tokenizers import Tokenizer
                    bits = max(1, (Tokenizer.from_file(tokenizer_file).get_vocab_size() - 1).bit_length())
                    out, part = PackWriter(folder, attempt_name("tokens", ".bits"), bits), p
                out.add(doc, np.frombuffer(ids, id_width(out.bits)).astype(np.uint32))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([out.path]), pa.array([len(out.ids)], pa.int64()),
                                              pa.array([out.n], pa.int64())], names=["part", "path", "docs", "ids"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("tie"))
    files = (rows.mapInArrow(encode, "part int, id long, tie long, ids binary")
             .repartitionById(n, "part").sortWithinPartitions("id", "tie")
             .mapInArrow(write, "part int, path string, docs long, ids long"))
    manifest = f"{folder}/manifest"
    files.write.parquet(manifest)
    return manifest


def read_packed(spark: SparkSession, manifest: str, per_doc, schema: str) -> DataFrame:
    """Read every listed file: ``per_doc(doc_id, start, pieces)`` gives a row's remaining values.

    ``start`` is the number of ids before the document in all files;
    ``pieces`` iterates its ids as uint32 arrays of bounded length.
    """
    files = spark.read.parquet(manifest)
    n = max(1, files.count())
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = files.select("part", "path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"),
                          (F.row_number().over(Window.orderBy("part")) - 1).cast("int").alias("at"))

    target = to_arrow_schema(StructType.fromDDL(schema))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                r = PackReader(path)
                rows = []
                for i, pieces in r.documents():
                    rows.append(per_doc(None if r.null[i] else int(r.doc_ids[i]), first + int(r.starts[i]), pieces))
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_pylist(rows, target)
                        rows = []
                r.close()
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, target)

    return starts.repartitionById(n, "at").select("path", "first").mapInArrow(read, schema)


def digest(doc_id: int | None, start: int, pieces: Iterator[np.ndarray]) -> dict:
    """Length and crc32 (of little-endian uint32 ids) of one document."""
    n, crc = 0, 0
    for ids in pieces:
        n, crc = n + len(ids), zlib.crc32(ids.astype("<u4").tobytes(), crc)
    return {"doc_id": doc_id, "start": start, "n_tokens": n, "ids_crc32": crc}

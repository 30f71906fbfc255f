"""Alignment of two tokenizers' tokens over the same text.

A byte-level BPE (A, on a space and the text) and a SentencePiece model (B, on
the text, which puts the space in front itself) cut the same bytes. Shared cuts
are byte offsets where tokens of both end. They are found by divide and
conquer: in an interval of B tokens the ends nearest the middle are looked up
among A's ends by bisection; the first common one parts the interval in two,
and an interval without one is a leaf: its tokens are one group. All intervals
of a slice take a step together, in numpy.

Both tokenizers begin anew at a space between two other characters, so such
a space is a shared cut known beforehand: texts are parted there and a slice's
different strings are encoded and aligned once. Texts with other white space
beside a space go whole.

Corpus counts of linked id pairs come in two passes. The first writes, per
slice, every document's strings by number, the strings' links and the slice's
count of each pair. Counts are summed by Spark and go back to the slices that
hold the pair; the second pass adds them up per document. No task sees more
pairs than its slice holds, and no text is encoded twice.

Defined results: texts that are NULL, empty, or whose joined tokens differ from
a space and the text have no tokens (zeros, empty groups) and count nothing;
NULL and repeated ids are ordinary rows; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from capstream.llm.textvec import SPACE, slices
from capstream.session import shared_path

#: Strings whose alignment a worker remembers (longer ones are not).
REMEMBERED, REMEMBERED_CHARS = 150_000, 48
#: UTF-8 bytes of a slice of texts (a longer text is a slice of its own), and of strings encoded in one go.
AT_ONCE, JOINED = 6 << 20, 1 << 14
DOC, STRINGS, PAIR = range(3)


def ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers ``first`` to ``first + length`` - 1 of each entry, one after another."""
    return np.arange(int(length.sum())) + np.repeat(first - (np.cumsum(length) - length), length)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def shared_cuts(a_end: np.ndarray, b_end: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Marks the B tokens in the intervals [``low``, ``high``) that end where an A token ends.

    An interval's probes go outwards from its middle. A probe that hits parts
    the interval: the tokens probed in vain on its way belong to neither half.
    """
    cut = np.zeros(len(b_end), bool)
    step = np.zeros(len(low), np.int64)
    while (keep := low < high).any():
        low, high, step = low[keep], high[keep], step[keep]
        middle, far = (low + high) // 2, (step + 1) // 2  # 0, 1 left, 1 right, 2 left, ... of the middle
        probe = middle + np.where(step & 1, -far, far)
        at = np.searchsorted(a_end, b_end[probe])
        hit = a_end[np.minimum(at, len(a_end) - 1)] == b_end[probe]
        cut[probe[hit]] = True
        on = ~hit & (step + 1 < high - low)
        none = np.zeros(int(hit.sum()), np.int64)
        low, high, step = (np.concatenate([low[hit], (middle + far + (step & 1 == 0))[hit], low[on]]),
                           np.concatenate([(middle - far)[hit], high[hit], high[on]]), np.concatenate([none, none, step[on] + 1]))
    return cut


def _byte_of() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Strings:
    """Tokens, groups and links of strings, one entry each: counts, the groups' text, and the links' pairs."""

    def __init__(self, n_a, n_b, n_groups, told, pairs, offsets, valid):
        self.n_a, self.n_b, self.n_groups, self.told, self.pairs, self.offsets, self.valid = n_a, n_b, n_groups, told, pairs, offsets, valid

    def __len__(self) -> int:
        return len(self.told)

    @classmethod
    def none(cls) -> Strings:
        zero = np.zeros(0, np.int64)
        return cls(zero, zero, zero, [], zero, np.zeros(1, np.int64), np.zeros(0, bool))

    def __add__(self, more: Strings) -> Strings:
        return Strings(*(np.concatenate([getattr(self, c), getattr(more, c)]) for c in ("n_a", "n_b", "n_groups")), self.told + more.told,
                       np.concatenate([self.pairs, more.pairs]), np.concatenate([self.offsets, more.offsets[1:] + self.offsets[-1]]),
                       np.concatenate([self.valid, more.valid]))

    def first(self, n: int) -> Strings:
        return Strings(self.n_a[:n], self.n_b[:n], self.n_groups[:n], self.told[:n], self.pairs[:self.offsets[n]], self.offsets[:n + 1], self.valid[:n])


class Aligner:
    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        with open(a_file, encoding="utf-8") as f:
            spec = json.load(f)
        model = sentencepiece_model_pb2.ModelProto()
        with open(b_file, "rb") as f:
            model.ParseFromString(f.read())
        byte_of = _byte_of()
        entries = {i: p for p, i in self.a.get_vocab(True).items()}
        self.a_bytes = [bytes(byte_of[c] for c in p) if (p := entries.get(i)) is not None and all(c in byte_of for c in p) else (p or "").encode()
                        for i in range(max(entries) + 1)]
        self.b_bytes = [bytes([int(p.piece[3:5], 16)]) if p.type == p.BYTE else p.piece.replace("▁", " ").encode() for p in model.pieces]
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_names = np.array([b"%d%b" % (i, end) for end in (b",", b"|") for i in range(len(self.a_bytes))], object)
        self.b_names = np.array([b"%d%b" % (i, end) for end in (b",", b";", b"") for i in range(len(self.b_bytes))], object)
        # whether a space between two other characters always begins new tokens of both
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        own = spec.get("pre_tokenizer") or {}
        normal = model.normalizer_spec
        self.parts = (spec.get("normalizer") is None and all(own.get(k) == v for k, v in byte_level.items()) and normal.add_dummy_prefix
                      and not normal.precompiled_charsmap and not normal.remove_extra_whitespaces and normal.escape_whitespaces
                      and not model.trainer_spec.treat_whitespace_as_suffix and model.trainer_spec.byte_fallback
                      and not any("▁" in p.piece.lstrip("▁") or p.type == p.USER_DEFINED for p in model.pieces))
        self.known: dict[str, int] = {}
        self.store = Strings.none()

    # -- encoding -----------------------------------------------------------------------------

    def _encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], self.b.encode(texts, num_threads=1)

    def tokens(self, strings: list[str], units: int) -> tuple[np.ndarray, ...]:
        """(A ids, offsets, B ids, offsets, valid) of each string; the first ``units`` ones hold no space and may be encoded together."""
        joint, alone, held, size = [], list(range(units, len(strings))), [], 0
        for i in range(units):
            s = strings[i]
            if "▁" in s or "\0" in s:
                alone.append(i)
                continue
            held.append(i)
            size += len(s)
            if size >= JOINED:
                joint.append(held)
                held, size = [], 0
        if held:
            joint.append(held)
        ids_a, ids_b = [None] * len(strings), [None] * len(strings)
        for held, a, b in zip(joint, *self._encode([" ".join([strings[i] for i in held]) for held in joint]), strict=True):
            a, b = np.array(a, np.int32), np.array(b, np.int32)
            told = [(" " + strings[i]).encode() for i in held]
            ends = np.cumsum(list(map(len, told)))
            cut_a, cut_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
            to_a, to_b = np.searchsorted(cut_a, ends), np.searchsorted(cut_b, ends)
            whole = b"".join(told)
            same = b"".join([self.a_bytes[i] for i in a]) == whole and b"".join([self.b_bytes[i] for i in b]) == whole
            if same and (cut_a[to_a] == ends).all() and (cut_b[to_b] == ends).all():
                for i, x, y in zip(held, np.split(a, to_a[:-1] + 1), np.split(b, to_b[:-1] + 1), strict=True):
                    ids_a[i], ids_b[i] = x, y
            else:
                alone += held
        valid = np.ones(len(strings), bool)
        for i, a, b in zip(alone, *self._encode([strings[i] for i in alone]), strict=True):
            whole = (" " + strings[i]).encode()
            valid[i] = bool(a) and bool(b) and b"".join([self.a_bytes[x] for x in a]) == whole and b"".join([self.b_bytes[x] for x in b]) == whole
            ids_a[i], ids_b[i] = (np.array(x if valid[i] else [], np.int32) for x in (a, b))
        none = np.zeros(0, np.int32)
        return (np.concatenate([*ids_a, none]), np.cumsum([0, *map(len, ids_a)]), np.concatenate([*ids_b, none]), np.cumsum([0, *map(len, ids_b)]), valid)

    # -- alignment ----------------------------------------------------------------------------

    def align(self, strings: list[str], units: int) -> Strings:
        a, a_off, b, b_off, valid = self.tokens(strings, units)
        if not len(a):
            zero = np.zeros(len(strings), np.int64)
            return Strings(zero, zero, zero, [b""] * len(strings), np.zeros(0, np.int64), np.zeros(len(strings) + 1, np.int64), valid)
        a_size, b_size = self.a_size[a], self.b_size[b]
        a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
        full = np.flatnonzero(valid)
        last_a, last_b = a_off[full + 1] - 1, b_off[full + 1] - 1
        b_cut = shared_cuts(a_end, b_end, b_off[full], last_b)
        b_cut[last_b] = True
        a_cut = np.zeros(len(a), bool)
        a_cut[np.searchsorted(a_end, b_end[b_cut])] = True
        # links: the A tokens whose bytes overlap those of a B token
        first = np.searchsorted(a_end, b_end - b_size, "right")
        n_links = np.searchsorted(a_end - a_size, b_end, "left") - first
        pairs = a[ranges(first, n_links)].astype(np.int64) << 32 | np.repeat(b, n_links)
        # a group's A tokens, then its B tokens
        b_group = np.cumsum(b_cut) - b_cut
        a_group = np.cumsum(a_cut) - a_cut
        upto_a, upto_b = np.flatnonzero(a_cut) + 1, np.append(0, np.flatnonzero(b_cut) + 1)
        names = np.empty(len(a) + len(b), object)
        names[np.arange(len(a)) + upto_b[a_group]] = self.a_names[a + a_cut * len(self.a_bytes)]
        end = b_cut.astype(np.int64)
        end[last_b] = 2
        names[np.arange(len(b)) + upto_a[b_group]] = self.b_names[b + end * len(self.b_bytes)]
        names, at = names.tolist(), (a_off + b_off).tolist()
        told = [b"".join(names[i:j]) for i, j in zip(at, at[1:], strict=False)]
        return Strings(np.diff(a_off), np.diff(b_off), sums(b_cut, b_off), told, pairs, np.append(0, np.cumsum(n_links))[b_off], valid)

    # -- slices -------------------------------------------------------------------------------

    def _odd(self, texts: pa.Array, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Rows whose spaces do not all stand alone between other characters."""
        if not self.parts:
            return np.ones(len(texts), bool)
        odd = np.zeros(len(texts), bool)
        space = np.flatnonzero(data == 32)
        row = np.searchsorted(starts, space, "right") - 1
        follows = np.append(data, 32)[space + 1]
        odd[row[(space == starts[row]) | (space + 1 == starts[row + 1]) | SPACE[follows] | ((follows >= 28) & (follows < 32))]] = True
        # lead bytes of white space beyond ASCII: look at those texts
        for r in np.unique(row[np.isin(follows, (0xC2, 0xE1, 0xE2, 0xE3))]):
            odd[r] |= any(u[:1].isspace() for u in texts[r].as_py().split(" ")[1:])
        return odd

    def slice(self, texts: pa.Array, data: np.ndarray, starts: np.ndarray) -> tuple[Strings, np.ndarray, np.ndarray]:
        """(the slice's different strings, each row's strings by number, row offsets in them)."""
        odd = self._odd(texts, data, starts)
        size = np.diff(starts)
        plain, whole = np.flatnonzero(~odd & (size > 0)), np.flatnonzero(odd & (size > 0))
        split = pc.split_pattern(texts.take(pa.array(plain)), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        counts = np.zeros(len(texts), np.int64)
        counts[plain] = np.diff(split.offsets.to_numpy())
        counts[whole] = 1
        offsets = np.append(0, np.cumsum(counts))
        found = [self.known.get(w, -1) for w in words]
        number = np.array(found, np.int64)
        new = np.flatnonzero(number < 0)
        number[new] = len(self.store) + np.arange(len(new))
        strings = self.store + self.align([words[i] for i in new] + texts.take(pa.array(whole)).to_pylist(), len(new))
        refs = np.empty(offsets[-1], np.int64)
        refs[ranges(offsets[plain], counts[plain])] = number[coded.indices.to_numpy(False)]
        refs[offsets[whole]] = len(self.store) + len(new) + np.arange(len(whole))
        room = REMEMBERED - len(self.store)
        kept = new[:max(0, room)]
        if len(kept):
            self.known.update((words[i], len(self.store) + k) for k, i in enumerate(kept) if len(words[i]) <= REMEMBERED_CHARS)
            self.store = strings.first(len(self.store) + len(kept))
        return strings, refs, offsets


@functools.lru_cache(1)
def worker_aligner(a_file: str, b_file: str) -> Aligner:
    """One aligner per worker process, kept between tasks."""
    return Aligner(a_file, b_file)


DIGESTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
PARTS = f"chunk long, kind int, {DIGESTS}, groups string, body binary, no int, a int, b int, n long"


def packed(numbers: np.ndarray) -> bytes:
    """Numbers in ascending order as their differences, two bytes each if they fit, else four."""
    steps = np.diff(np.sort(numbers), prepend=0)
    return b"\2" + steps.astype("<u2").tobytes() if steps.max(initial=0) < 1 << 16 else b"\4" + steps.astype("<u4").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, "<u2" if data[0] == 2 else "<u4", offset=1), dtype=np.int64)


def _chunk(ids: pa.Array, strings: Strings, refs: np.ndarray, offsets: np.ndarray, chunk: int, groups: bool, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A slice's rows: its documents, its strings' links, and its count of every pair."""
    own, refs = np.unique(refs, return_inverse=True)
    valid = (sums(~strings.valid[own][refs], offsets) == 0) & (np.diff(offsets) > 0)
    used = np.repeat(valid, np.diff(offsets))
    n_links = np.diff(strings.offsets)[own]
    links = strings.pairs[ranges(strings.offsets[own], n_links)]
    pairs, numbers = np.unique(links, return_inverse=True)
    times = np.bincount(refs[used], minlength=len(own))
    counts = np.bincount(numbers, np.repeat(times, n_links), len(pairs)).astype(np.int64)

    def rows(size: int, kind: int, **columns) -> pa.RecordBatch:
        columns |= {"chunk": pa.array(np.full(size, chunk)), "kind": pa.array(np.full(size, kind, np.int32))}
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)).cast(f.type) for f in schema], schema=schema)

    told, joined, hashes, body = [strings.told[i] for i in own], [], [], []
    for i, j, ok in zip(offsets.tolist(), offsets[1:].tolist(), valid, strict=False):
        x = b";".join([told[k] for k in refs[i:j].tolist()]) if ok else b""
        hashes.append(hashlib.sha256(x).hexdigest() if x else "")
        body.append(packed(refs[i:j]) if ok else None)
        if groups:
            joined.append(x.decode())
    numbered = {c: pa.array(np.where(valid, sums(x[own][refs], offsets), 0)) for c, x in
                (("n_a", strings.n_a), ("n_b", strings.n_b), ("n_groups", strings.n_groups), ("n_links", np.diff(strings.offsets)))}
    more = {"groups": pa.array(joined)} if groups else {}
    yield rows(len(ids), DOC, doc_id=ids, groups_sha256=pa.array(hashes), body=pa.array(body, pa.binary()), **numbered, **more)
    yield rows(1, STRINGS, body=pa.array([np.concatenate([[len(own)], n_links, numbers]).astype("<u4").tobytes()], pa.binary()))
    there = np.flatnonzero(counts)
    for i in range(0, len(there), 1 << 16):
        k = there[i:i + (1 << 16)]
        yield rows(len(k), PAIR, no=pa.array(k), a=pa.array(pairs[k] >> 32), b=pa.array(pairs[k] & 0xFFFFFFFF), n=pa.array(counts[k]))


def encode_chunks(df: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text", groups: bool = False) -> str:
    """First pass: writes the slices' rows (``PARTS``) under the shared folder and returns the table's path.

    Memory per task: one Arrow batch of texts, one slice's strings and links, and
    the remembered strings.
    """
    target = to_arrow_schema(StructType.fromDDL(PARTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, at = worker_aligner(a_file, b_file), 0
        for batch in batches:
            for i, j, data, starts in slices(batch.column(1), AT_ONCE):
                strings, refs, offsets = aligner.slice(batch.column(1).slice(i, j - i).fill_null(""), data, starts)
                yield from _chunk(batch.column(0).slice(i, j - i), strings, refs, offsets, TaskContext.get().partitionId() << 32 | at, groups, target)
                at += 1

    path = shared_path(df.sparkSession, "aligned")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows.mapInArrow(run, PARTS).write.parquet(path)
    return path


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``a``, ``b``, ``count`` (how many links of the corpus hold the pair) and ``best`` (no other ``a`` has more for this ``b``)."""
    counts = chunks.where(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("n").alias("count"))
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def aligned(df: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text", groups: bool = False) -> DataFrame:
    """One row per document: ``DIGESTS``, ``n_best`` and ``count_sum``, and with ``groups`` the groups themselves as text.

    A group is its A ids and its B ids in order, ``a1,a2|b1``; groups are joined
    by semicolons. ``n_links`` are all pairs of tokens whose bytes overlap.
    """
    path = encode_chunks(df, a_file, b_file, id_col, text_col, groups)
    chunks, pairs = (df.sparkSession.read.schema(PARTS).parquet(path) for _ in range(2))
    scored = (pairs.where(F.col("kind") == PAIR).select("chunk", "no", "a", "b").join(pair_counts(pairs), ["a", "b"])
              .select("chunk", "no", "count", "best"))
    out = f"{DIGESTS}, n_best long, count_sum long{', groups string' if groups else ''}"
    target = to_arrow_schema(StructType.fromDDL(out))

    def add(parts: pa.Table, scores: pa.Table) -> pa.Table:
        worker_aligner.cache_clear()  # this worker may have run the first pass
        kind = parts["kind"].to_numpy()
        links = np.frombuffer(parts["body"][int(np.flatnonzero(kind == STRINGS)[0])].as_py(), "<u4").astype(np.int64)
        n, numbers = links[1:links[0] + 1], links[links[0] + 1:]
        no = scores["no"].to_numpy()
        count, best = (np.zeros(int(numbers.max(initial=-1)) + 1, np.int64) for _ in range(2))
        count[no], best[no] = scores["count"].to_numpy(), scores["best"].to_numpy()
        offsets = np.append(0, np.cumsum(n))
        count, best = sums(count[numbers], offsets), sums(best[numbers], offsets)
        docs = parts.filter(pa.array(kind == DOC))
        total = np.zeros((len(docs), 2), np.int64)
        for i, body in enumerate(docs["body"]):
            if body.is_valid:
                refs = unpacked(body.as_py())
                total[i] = best[refs].sum(), count[refs].sum()
        more = {"n_best": pa.array(total[:, 0]), "count_sum": pa.array(total[:, 1])}
        return pa.table([more.get(f.name, docs[f.name] if f.name in docs.column_names else None) for f in target], schema=target)

    parts = chunks.where(F.col("kind") != PAIR).select("chunk", "kind", *[f.name for f in target if f.name in chunks.columns], "body")
    return parts.groupBy("chunk").cogroup(scored.groupBy("chunk")).applyInArrow(add, out)

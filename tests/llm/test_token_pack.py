import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from capstream.llm import token_pack
from capstream.llm.token_pack import CachedEncoder, PackReader, PackWriter, digest, encode_and_pack, pack, read_packed, unpack

FILE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", "  a", " a", "a ", "a  b c", "x\n y", "  z z", "it's he'll  \t z", "<|endoftext|> hi <|endoftext|>", "a b　 c", "é ü 12 3.4 ,, .. a\nb c\n\nd e",
         "\x1c x y", "\x85 x", "a \x85b", "a \u2003b", "a \u2013b", "é \xa0", "nospace", " ", "a\x1c b \x1dc", "word " * 30000, "日本 語 🙂 x"]


def library():
    return Tokenizer.from_file(FILE)


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 31, 32])
def test_pack(bits):
    a = np.random.default_rng(bits).integers(0, 2**bits, 800, dtype=np.uint64).astype(np.uint32)
    data = pack(a, bits)
    assert len(data) == 100 * bits and (unpack(data, bits) == a).all()


def test_cached_ids_are_the_librarys(monkeypatch):
    lib, enc = library(), CachedEncoder(FILE, 0)
    for at_once in (1, 40, 1 << 20):
        monkeypatch.setattr(token_pack, "AT_ONCE", at_once)
        got = {}
        for rows, ids in enc.encode(pa.array(TEXTS)):
            got.update(zip(rows.tolist(), ids.to_pylist(), strict=True))
        assert [np.frombuffer(got[i], enc.width).tolist() for i in range(len(TEXTS))] == [lib.encode(t, add_special_tokens=False).ids + [0] for t in TEXTS]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_special_tokens_and_other_pre_tokenizers(name):
    lib, enc = Tokenizer.from_file(public_tokenizers.path(name)), CachedEncoder(public_tokenizers.path(name), 0)
    texts = ["say <|endoftext|> now", "say<|endoftext|>now", "plain words", "<|startoftext|>A  b<|endoftext|>", "|endoftext|", "It's 12 éÉ."]
    got = {}
    for rows, ids in enc.encode(pa.array(texts)):
        got.update(zip(rows.tolist(), ids.to_pylist(), strict=True))
    assert [np.frombuffer(got[i], enc.width).tolist() for i in range(len(texts))] == [lib.encode(t, add_special_tokens=False).ids + [0] for t in texts]


def test_random_access(tmp_path):
    ids = np.random.default_rng(0).integers(0, 50257, 20000).astype(np.uint32)
    w = PackWriter(str(tmp_path), "a.bits", 16, block=64)
    cuts = [0, 1, 1, 700, 701, 9000, 20000]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        w.add(None if i == 1 else i * 7, ids[a:b])
    w.close()
    r = PackReader(w.path)
    for a, b in [(0, 1), (63, 65), (64, 64), (5, 19999), (19990, 20000)]:
        assert (r.read(a, b) == ids[a:b]).all()
    got = [(i, np.concatenate([np.zeros(0, np.uint32), *p])) for i, p in r.documents(at_once=300)]
    assert [i for i, _ in got] == list(range(6)) and all((p == ids[a:b]).all() for (_, p), a, b in zip(got, cuts, cuts[1:]))


def test_documents(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = docs + [(10**6 + i, t) for i, t in enumerate(TEXTS)] + [(None, None), (-3, None), (-3, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, part int")
    got = read_packed(spark, encode_and_pack(df, FILE), digest, "doc_id long, start long, n_tokens long, ids_crc32 long").collect()
    lib, at, want = library(), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((str(i), at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)


def test_one_file(spark, tmp_path):
    df = spark.createDataFrame([(i, f"word {i}") for i in (5, 1, 9)], "doc_id long, text string")
    manifest = encode_and_pack(df, FILE, folder=str(tmp_path / "one"), n_files=1)
    got = read_packed(spark, manifest, digest, "doc_id long, start long, n_tokens long, ids_crc32 long").collect()
    assert spark.read.parquet(manifest).count() == 1 and [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [1, 5, 9]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert read_packed(spark, encode_and_pack(df, FILE), digest, "doc_id long, start long, n_tokens long, ids_crc32 long").count() == 0

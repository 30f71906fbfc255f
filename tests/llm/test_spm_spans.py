import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece as S
from sentencepiece import sentencepiece_model_pb2 as M

from capstream.llm import spm_spans

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "hello  world\n\tx", "é☃𝒳\0 ", "▁a▁ b", "  lead and trail  ", "<s> </s> <unk>", "ﬁ Ａ　x ㍿ ①", "á̈ 한국 ​ z",
         "x" * 5000, "\t\r\n", "ｶﾞ ガ", "a " * 700]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_normaliser_matches_library(rule):
    lib = S.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    spec = M.ModelProto()
    spec.ParseFromString(lib.serialized_model_proto())
    own, short = spm_spans.Normalizer(spec.normalizer_spec), spm_spans.Normalizer(spec.normalizer_spec)
    short.map.near = 1  # keys longer than what is remembered
    for t in TEXTS:
        assert short.run(t.encode())[0] == own.run(t.encode())[0]
        text, begin, end = own.run(t.encode())
        assert text.decode() == lib.normalize(t), (rule, t)
        assert len(begin) == len(end) == len(text)
        assert (np.diff(begin) >= 0).all() and (begin <= end).all() and (not len(end) or end[-1] <= len(t.encode()))


def test_spans_cover_text_and_match_library():
    enc = spm_spans.SpanEncoder(MODEL)
    sp = enc.sp
    for t, (ids, begin, end, back) in zip(TEXTS, enc.encode(TEXTS), strict=True):
        data = t.encode()
        assert ids == sp.encode(t) and back == sp.decode(ids)
        assert b"".join(data[a:b] for a, b in zip(begin, end)) == data
        proto = sp.encode(t, return_type="proto")
        for p, a, b in zip(proto.pieces, begin, end, strict=True):
            if not p.piece.startswith("<0x"):
                assert (p.begin, p.end) == (a, b)


def test_documents(spark):
    rows = [(i, t, "c") for i, t in enumerate(TEXTS)] + [(None, None, "n"), (3, "again", "n"), (3, "again", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    sp = S.SentencePieceProcessor(model_file=MODEL)
    want = sorted((str(i), len(sp.encode(t or "")), hashlib.sha256(",".join(map(str, sp.encode(t or ""))).encode()).hexdigest(),
                   hashlib.sha256(sp.decode(sp.encode(t or "")).encode()).hexdigest()) for i, t, _ in rows)
    got = spm_spans.encode_spans(df, MODEL, spm_spans.digests, spm_spans.DIGESTS).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert spm_spans.encode_spans(df.limit(0), MODEL).count() == 0
    full = spm_spans.encode_spans(df.filter("doc_id = 2"), MODEL).first()
    assert list(full.ids) == sp.encode(TEXTS[2]) and full.decoded == TEXTS[2]

import hashlib
import random

import pytest
import sentencepiece

from cadenza.llm import pieces as P


@pytest.fixture(scope="module")
def model():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_file=model)


def texts():
    rnd = random.Random(4)
    parts = [" ", "  ", "   ", "\n", "\t", "the", "Wordy", "é", "ungen", "漢字", "😀", "1234", ",", "▁", "<s>", "<0x0A>", " ", "x" * 50, "\x1c", "á"]
    yield from ["", " ", "  ", "a", "\n", "▁", "x" * 3000, "word " * 500, " lead", "trail "]
    for _ in range(1500):
        yield "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 12)))


def test_ids_and_spans_as_the_library(model, library):
    enc = P.Encoder(model, entries=300)
    for t in texts():
        want = library.encode(t)
        ids, begins, ends = enc.encode(t)
        assert ids == want, repr(t)
        spans = enc.spans(t)
        assert [x[0] for x in spans] == want
        proto = library.encode(t, return_type="proto")
        assert [(b, e) for _, b, e in spans] == [(p.begin, p.end) for p in proto.pieces], repr(t)
        assert list(zip(ids, begins.tolist(), ends.tolist(), strict=True)) == spans, repr(t)
        assert enc.decode(want) == library.decode(want)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_normaliser_with_a_compiled_map(rule):
    from sentencepiece import sentencepiece_model_pb2 as pb

    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = pb.ModelProto.FromString(lib.serialized_model_proto()).normalizer_spec
    assert len(spec.precompiled_charsmap) > 1000
    for squeeze in (False, True):
        own = P.Normaliser(spec.precompiled_charsmap, dummy_prefix=False, squeeze=squeeze, escape=False)
        theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=squeeze)
        for t in ["", "Ａｂｃ ｶﾞ ① ﬁ ½", "  two  spaces  ", " x　y", "ẛ̣ á ㌀", "plain", " ", "​"]:
            got, source = own(t)
            assert got == theirs.normalize(t), repr(t)
            assert len(source) == len(got) + 1 and source == sorted(source)
    got, source = P.Normaliser(spec.precompiled_charsmap, dummy_prefix=False, escape=False)("ｶﾞx")
    assert got == "ガx" and source == [0, 6, 7]


def test_long_words_merge_like_short_ones(model):
    enc = P.Encoder(model)
    rnd = random.Random(1)
    for _ in range(200):
        w = "".join(rnd.choice("thesiongd") for _ in range(rnd.randint(33, 90)))
        parts, left = [], list(w)
        while True:  # the plain rule
            pairs = [(enc.scores[a + b], -i) for i, (a, b) in enumerate(zip(left, left[1:])) if a + b in enc.scores]
            if not pairs:
                break
            i = -max(pairs)[1]
            left[i : i + 2] = [left[i] + left[i + 1]]
        parts = left
        assert enc.merge(w) == parts


def test_documents(odd_docs, model, library):
    every = tuple(P.OUTPUTS)
    got = P.encode(odd_docs, model, every).collect()
    want = []
    for r in odd_docs.collect():
        ids = library.encode(r.text or "")
        text = library.decode(ids)
        want.append((r.doc_id, len(ids), ids, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), text, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_tokens, r.ids, r.ids_sha256, r.decoded, r.decoded_sha256) for r in got), key=str) == sorted(want, key=str)


def test_whole_table(spark, model, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.ids for r in P.encode(docs, model, ("ids",)).collect()}
    assert got == {r.doc_id: library.encode(r.text or "") for r in docs.collect()}
    assert P.encode(docs.limit(0), model).collect() == []

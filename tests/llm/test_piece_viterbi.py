import dataclasses
import re

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from encore.llm.piece_viterbi import SPACE, Codec, decode, encode, model_path, read_vocabulary, token_report
from encore.llm.queries import QUERIES
from encore.sources.tables import read_table
from llm.conftest import doc, prose

PATH = "/opt/tokenizers/piece_bpe_32k.model"
TEXTS = ["", " ", "a", "  a  b\nc\té 漢\U0001F600 ", "x" * 3000, "the then other thanedble", "Ünïcödé ßtraße\r\n\x0b end", " " * 40 + "q", "tab\t\ttab", "\x00\x7f"]


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(PATH)


@pytest.fixture(scope="module")
def unigram(vocabulary):
    """The library's unigram mode over the same pieces; scores that its 32-bit sums can't hold are raised in both."""
    m = pb.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        p.score = max(p.score, -40000.0)
    raised = dataclasses.replace(vocabulary, scores=tuple(max(s, -40000.0) for s in vocabulary.scores))
    return sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString()), Codec(raised)


def plain(v, text):
    """Viterbi over the whole text, one character at a time."""
    if not text:
        return []
    ids = {v.pieces[i]: i for i in v.plain}
    low = min(v.scores[i] for i in v.plain) - 10
    s = (SPACE if v.prefix else "") + text.replace(" ", SPACE)
    best = [(0.0, 0, ())] + [None] * len(s)
    for e in range(1, len(s) + 1):
        for b in range(max(0, e - 16), e):
            i = ids.get(s[b:e])
            if i is None and e - b > 1:
                continue
            score = best[b][0] + (low if i is None else v.scores[i])
            if best[e] is None or score > best[e][0]:
                best[e] = (score, b, tuple(v.bytes_at[x] for x in s[b:e].encode()) if i is None else (i,))
    out, e = [], len(s)
    while e:
        out.append(best[e][2])
        e = best[e][1]
    return [i for part in out[::-1] for i in part]


def test_against_the_library(spark, unigram):
    library, codec = unigram
    words = {w for r in read_table(spark, "/root/testdata/sf0.01", "documents").limit(60).collect() for w in re.findall("[^ ]+", r.text) if len(w) < 40}
    words = sorted(words) + ["the then other", "a  b", "déjà vu"]
    for w, ids in zip(words, codec.encode_batch(words), strict=True):
        assert ids.tolist() == library.encode(w), w


def test_against_plain_viterbi(vocabulary):
    codec = Codec(vocabulary)
    texts = [t for t in TEXTS if len(t) < 1000] + [prose(4, 30)]
    for t, ids in zip(texts, codec.encode_batch(texts), strict=True):
        assert ids.tolist() == plain(vocabulary, t), t
        assert codec.decode(ids) == t


def test_query_round_trip(spark, vocabulary):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op8_piece_viterbi"](spark, sf).collect()
    docs = read_table(spark, sf, "documents")
    assert len(rows) == docs.count() and all(r.round_trip for r in rows)
    ids = {r.doc_id: len(r.ids) for r in encode(docs, vocabulary).select("doc_id", "ids").collect()}
    assert ids == {r.doc_id: r.n_tokens for r in rows}


def test_edge_cases(frame, vocabulary):
    texts = [*TEXTS, TEXTS[3], None, prose(2, 60_000)]
    df = frame([doc(None if k == 1 else k, t) for k, t in enumerate(texts)]).selectExpr("*", "'x' as ids", "1 as decoded", "2 as n_tokens")
    back = decode(encode(df, vocabulary), vocabulary)
    assert back.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_tokens", "ids", "decoded"]
    rows = back.collect()
    assert len(rows) == len(texts) and all(r.decoded == r.text and (r.ids is None) == (r.text is None) and r.n_tokens == 2 for r in rows)
    report = token_report(df, vocabulary).collect()
    assert len(report) == len(texts) and sum(r.round_trip is None for r in report) == 1 and all(r.round_trip is not False for r in report)


def test_empty_table_and_forgetting(spark, frame, vocabulary, monkeypatch):
    assert encode(frame([]), vocabulary).count() == 0 and token_report(frame([]), vocabulary).count() == 0
    assert model_path(spark) == PATH
    monkeypatch.setattr("encore.llm.piece_viterbi.REMEMBERED", 5)
    codec, fresh = Codec(vocabulary), Codec(vocabulary)
    for t in TEXTS * 2:
        assert np.array_equal(next(codec.encode_batch([t])), next(fresh.encode_batch([t])))


def mixed(seed, n):
    """One word: letters, digits and signs drawn at random, runs, and characters that are no piece."""
    rng = np.random.default_rng(seed)
    parts = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789+/="), n // 2)), "a" * (n // 8), "the" * (n // 24), "\U0001F600漢é" * (n // 24)]
    return "".join(parts[i] for i in rng.permutation(len(parts))) + "".join(rng.choice(list("aehilnorst"), n // 4))


@pytest.mark.parametrize("stretch", [1, 7, 50, 1 << 15])
def test_long_words_against_plain_and_batched(vocabulary, monkeypatch, stretch):
    monkeypatch.setattr("encore.llm.piece_viterbi.STRETCH", stretch)
    codec = Codec(vocabulary)
    for k, n in enumerate((1, 2, 17, 400, 3000)):
        word = SPACE + (mixed(k, n) or "q")
        long, batched = codec._best_long(word), codec._best(codec._codes([word]))[0]
        assert long == batched
        if n <= 400:
            assert np.frombuffer(long, codec.kind).tolist() == plain(vocabulary, word[1:])


def test_memory_of_one_long_word(vocabulary):
    """Memory per character stays small and the text comes back; the word is not kept for later batches."""
    import tracemalloc

    codec, word = Codec(vocabulary), mixed(9, 400_000)
    tracemalloc.start()
    ids = next(codec.encode_batch([word]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert codec.decode(ids) == word
    assert peak < 60 * len(word) + (32 << 20)
    codec.held = 1 << 30
    assert len(next(codec.encode_batch(["a b"]))) and len(codec.known) == 2


def test_long_words_in_a_table(frame, vocabulary):
    texts = ["x" * 50_000, "a " + mixed(1, 30_000) + " b", mixed(2, 30_000)] * 2
    rows = decode(encode(frame([doc(k, t) for k, t in enumerate(texts)]), vocabulary), vocabulary).collect()
    assert len(rows) == 6 and all(r.decoded == r.text for r in rows)

import random

import corpus_pipeline
from encore.llm.piece_viterbi import Codec, read_vocabulary
from encore.llm.queries import MIX, ORACLE_SQL, QUERIES
from encore.llm.raking import mix, with_topics
from encore.llm.secret_cnn import train
from encore.sources.tables import read_table
from llm.conftest import DOCS, doc, prose
from llm.test_compression import plain as quality
from llm.test_multiorder_join import plain as near
from llm.test_piece_viterbi import PATH
from llm.test_secret_cnn import key, plain_spans

SF = "/root/testdata/sf0.001"


def masked(text, model):
    out, end = [], 0
    for s, _, e in plain_spans(text, model):
        if s >= end:
            out += [text[end:s], "[SECRET]"]
        end = max(end, e)
    return "".join(out) + text[end:]


def test_run_against_plain_version(spark, tmp_dir):
    rng = random.Random(3)
    own = read_table(spark, SF, "documents")
    planted = [doc(10_000 + i, f"{prose(700 + 3 * i, 60)} svc_{key(rng)} {prose(900 + 7 * i, 60)}") for i in range(8)]
    spark.createDataFrame(planted, DOCS).select(*own.columns).unionByName(own).write.parquet(f"{tmp_dir}/documents.parquet")
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in read_table(spark, tmp_dir, "documents").collect()]
    docs = [d for d in docs if quality(d[1])[-1]]
    group = near([(d[0], d[0], d[1]) for d in docs])
    docs = [d for d in docs if group[d[0]][1] == d[0]]
    make = lambda rows: spark.createDataFrame([(*d, len(d[1])) for d in rows], "doc_id long, text string, lang string, source string, n_chars long")
    model = train(make(docs))
    before = {d[0]: d[1] for d in docs}
    docs = [(i, masked(t, model), lang, s) for i, t, lang, s in docs]
    assert sum("svc_" in before[d[0]] and "svc_" not in d[1] for d in docs) >= 6  # the network's work, no rule knows them
    kept = {r.doc_id for r in mix(with_topics(make(docs)), MIX).where("sampled").collect()}
    want = sorted((i, lang, s, t) for i, t, lang, s in docs if i in kept)
    codec = Codec(read_vocabulary(PATH))
    ids = [x.tolist() for x in codec.encode_batch([w[3] for w in want])]
    got = sorted((r.doc_id, r.lang, r.source, list(r.ids)) for r in corpus_pipeline.run(spark, tmp_dir).collect())
    assert got == [(*w[:3], x) for w, x in zip(want, ids, strict=True)] and got


def test_every_stage_keeps_the_columns_and_survives_odd_rows(spark, frame, tmp_dir):
    text = prose(1, 80)
    rows = [doc(1, text), doc(1, text), doc(2, text + " x"), doc(3, None), doc(None, prose(2, 90)), doc(5, prose(3, 70) + " token = abcdefgh1", None, None),
            doc(6, ""), doc(7, prose(4, 30_000))]
    for df in (frame(rows).selectExpr("*", "'t' as topic", "1 as n_tokens", "2 as ids", "3 as probability", "4 as _uid"), frame([], DOCS)):
        names, docs = df.columns, df
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            assert out.columns == (names if k < 4 else ["doc_id", "lang", "source", "ids"]), name
            path = f"{tmp_dir}/{k}-{len(names)}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
            left = docs.select("doc_id").collect()
            if k == 1 and len(names) > 5:
                assert sorted(str(r.doc_id) for r in left) == ["1", "5", "7", "None"]
                assert {r.topic for r in docs.collect()} == {"t"}


def test_registered_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)

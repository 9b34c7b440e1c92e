import hashlib
import math
import re

from pyspark.sql import functions as F

from encore.llm.disclosure import KINDS, Disclosure, all_spans, find_personal_data, sanitise, span_text
from encore.llm.queries import QUERIES
from encore.sources.tables import read_table
from llm.conftest import doc, prose

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 // 10 + d * 2 % 10 for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def fine(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return (True, kind == 1 and all(int(p) <= 255 for p in value.split(".")), 14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15)[kind]


def plain(text):
    return sorted((m.start(), k, m.end(), m[0]) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if fine(k, m[0]))


def plain_terms(texts, p=Disclosure()):
    """{row: [(start, end, value)]} of the disclosing terms."""
    word = re.compile(r"[^\W_]+")
    docs = [{w for w in word.findall((t or "").lower()) if len(w) >= p.min_length} for t in texts]
    near = []
    for r, t in enumerate(texts):
        base = plain(t)
        for s, k, e, v in base:
            for m in word.finditer(t, max(0, s - p.context), s):
                if m.start() > s - p.context or s - p.context <= 0:
                    near.append((r, k, v, m.start(), m.end(), base))
            for m in word.finditer(t, e, e + p.context):
                if m.end() < e + p.context or len(t) <= e + p.context:
                    near.append((r, k, v, m.start(), m.end(), base))
    entity = lambda k, v: (k, re.sub("[^0-9]", "", v) if k >= 2 else v.lower())
    near = [(r, entity(k, v), s, e) for r, k, v, s, e, base in near
            if e - s >= p.min_length and not any(s < x[2] and x[0] < e for x in base)]
    held, met = {}, {}
    for r, t in enumerate(texts):
        for s, k, e, v in plain(t):
            held.setdefault(entity(k, v), set()).add(r)
    for r, x, s, e in near:
        met.setdefault((x, texts[r][s:e].lower()), set()).add(r)
    out = {}
    for r, x, s, e in near:
        t = texts[r][s:e].lower()
        n = len(texts)
        ic = math.log2(n / len(held[x]))
        n_t = sum(t in d for d in docs)
        if len(met[x, t]) >= p.support and ic > 0 and math.log2(n * len(met[x, t]) / (n_t * len(held[x]))) / ic >= p.generalise:
            out.setdefault(r, set()).add((s, e, texts[r][s:e]))
    return {r: sorted(v) for r, v in out.items()}


def joined(spans):
    return ",".join(f"{(*KINDS, 'term')[k]}:{s}:{e}" for s, k, e, *_ in spans)


def test_all_documents_against_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in read_table(spark, sf, "documents").collect()}
    for r in QUERIES["op6_disclosure"](spark, sf).collect():
        base = plain(texts[r.doc_id])
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x[1] == i for x in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert set(filter(None, joined(base).split(","))) <= set(r.spans.split(","))


TRICKY = [
    "a@b.com_c@d.com x@y z@.q a@b..c a%+-_.b@c-d.e.f. é@x.de ß.x@y.zz@w.io",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.001.2.3 1.2.3 1.2.3.4567 99.99.99.99.",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 5 5  6 1-2-3 " + "4" * 40,
    "+1 (974) 555-3436 +49.30.1234567 + 1234 +1-2 +12345678901234567 +1 2 3 4 5 6 7 8 9 0 )",
    "𝔸é 4111 1111 1111 1111 mail x@y.com at +1 (974) 555-3436, host 10.0.0.1; 12@3.4.5.6",
    "a" * 60_000 + "@b.com " + "1 " * 30_000 + "." * 10_000 + "1." * 9_999, "x@" * 5000, "+1" * 5000, "+1 " * 5000, None, "", " \n"]


def test_base_spans_of_tricky_texts(frame):
    rows = [doc(i, t) for i, t in enumerate(TRICKY)]
    for r in find_personal_data(frame(rows)).select("doc_id", span_text(F.col("base")).alias("s")).collect():
        assert r.s == joined(plain(TRICKY[r.doc_id])), r.doc_id


def corpus():
    same = "Der Zeuge Quirinal Brackwasser schrieb von quirin@example.org an alle."
    rows = [f"{same} {prose(i, 20)}" for i in range(6)] + [prose(40 + i, 30) + " Der Zeuge schrieb an alle" for i in range(30)]
    return [*rows, rows[0], None, "", "allein quirin@example.org"]


def test_terms_against_plain_version(frame):
    texts = corpus()
    df = frame([doc(i, t) for i, t in enumerate(texts)]).selectExpr("*", "5 as uid", "'x' as row")
    found = find_personal_data(df)
    want = plain_terms(texts)
    assert {r.doc_id: [(t.start, t.end, t.value) for t in r.terms] for r in found.collect() if r.terms} == want
    assert any("Brackwasser" in str(v) for v in want.values())
    out = {r.doc_id: r for r in sanitise(df, found).collect()}
    assert len(out) == len(texts) and out[1].uid == 5 and out[1].row == "x" and list(out[1].asDict()) == df.columns
    assert "quirin" not in out[1].text.lower() and "[EMAIL]" in out[1].text and "Brackwasser" not in out[1].text and "Zeuge" in out[1].text
    assert out[10].text == texts[10] and out[len(texts) - 3].text is None
    spans = {r.doc_id: r.s for r in found.select("doc_id", span_text(all_spans(F.col("base"), F.col("terms"))).alias("s")).collect()}
    starts = [int(x.split(":")[1]) for x in spans[1].split(",")]
    assert starts == sorted(starts) and "term" in spans[1]


def test_an_entity_named_often_in_one_text_counts_once(frame):
    own = "Zeuge Brackwasser quirin@example.org sah " * 4
    texts = [own + prose(1, 20), *(prose(40 + i, 30) for i in range(20))]
    assert plain_terms(texts) == {}
    assert [r.doc_id for r in find_personal_data(frame([doc(i, t) for i, t in enumerate(texts)])).collect() if r.terms] == []
    # more mentions than documents: the entity still has information
    texts = [own * 3, own * 3, own * 3, *(prose(40 + i, 30) for i in range(6))]
    got = {r.doc_id: [(t.start, t.end, t.value) for t in r.terms] for r in find_personal_data(frame([doc(i, t) for i, t in enumerate(texts)])).collect() if r.terms}
    assert got == plain_terms(texts) and set(got) == {0, 1, 2}


def test_terms_of_whole_texts_and_everywhere(frame):
    far = "quirin@example.org " + prose(7, 40).replace("ab", "xx") + " Brackwasser"
    texts = [f"{far} {prose(10 + i, 400)} Brackwasser, Ende" for i in range(4)] + [prose(40 + i, 30) for i in range(30)] + ["nur BRACKWASSER hier"]
    df = frame([doc(i, t) for i, t in enumerate(texts)])
    found = find_personal_data(df)
    rows = {r.doc_id: r for r in found.collect()}
    for i in (0, 1, 2, 3, 34):  # beyond the context, further on in the text, and without a mention
        places = [m.start() for m in re.finditer("brackwasser", texts[i].lower())]
        assert [t.start for t in rows[i].terms if t.value.lower() == "brackwasser"] == places and places, i
        assert all(texts[i][t.start:t.end] == t.value for t in rows[i].terms)
    assert not any("rackwasser" in r.text.lower() for r in sanitise(df, found).collect())
    assert not any(t.value == "Brackwasser" for r in find_personal_data(df, Disclosure(narrow=True)).collect() for t in r.terms)


def test_repeated_rows_null_ids_and_empty_table(frame):
    assert find_personal_data(frame([])).count() == 0
    rows = find_personal_data(frame([doc(None, "a@b.com"), doc(1, "a@b.com"), doc(1, "a@b.com")])).collect()
    assert len(rows) == 3 and all(len(r.base) == 1 and r.terms == [] for r in rows)
    assert sanitise(frame([]), find_personal_data(frame([]))).count() == 0

import math
import re
import zlib
from collections import Counter

import numpy as np

from encore.llm import context_trees as C
from encore.llm.queries import QUERIES
from encore.sources.tables import read_table
from llm.conftest import doc, prose


def log_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi) if a + b else 0.0


class Plain:
    """Context trees as nested dictionaries, recursively."""

    def __init__(self, texts):
        self.n, self.words = {}, Counter()
        for t in texts:
            b = (t or "").encode()
            self.words.update(re.findall(r"[^\x20\x09-\x0D]+", self.lower(t)))
            for y, before in self.positions(b):
                for bit in range(8):
                    node, one = (bit, y >> (8 - bit)), (y >> (7 - bit)) & 1
                    for d in range(5):
                        self.n.setdefault((before[:d], node), [0, 0])[one] += 1
        self.docs = len(texts)
        self.total, self.types = sum(self.words.values()) + self.docs, len(self.words) + (self.docs > 0)
        self.deeper = {}
        for c, node in self.n:
            if c:
                self.deeper.setdefault((c[:-1], node), []).append((c, node))
        self.w = {}

    @staticmethod
    def lower(t):
        return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")

    @staticmethod
    def positions(b):
        full = bytes([254] * 4) + b + b"\xff"
        return [(full[i], bytes(full[i - 4:i][::-1])) for i in range(4, len(full))]

    def log_w(self, k):
        if k not in self.w:
            kt = log_kt(*self.n[k])
            self.w[k] = kt if len(k[0]) == 4 else float(np.logaddexp(kt, sum(self.log_w(x) for x in self.deeper.get(k, [])))) - math.log(2)
        return self.w[k]

    def bit(self, before, node, one):
        p = None
        for d in range(4, -1, -1):
            k = (before[:d], node)
            if k in self.n:
                a = self.n[k]
                own = (a[one] + 0.5) / (sum(a) + 1)
                stop = math.exp(log_kt(*a) - math.log(2) - self.log_w(k))
                p = own if p is None else stop * own + (1 - stop) * p
        return 0.5 if p is None else p

    def byte(self, y, before):
        return sum(math.log10(self.bit(before, (k, y >> (8 - k)), (y >> (7 - k)) & 1)) for k in range(8))

    def score(self, t):
        return sum(self.byte(y, before) for y, before in self.positions((t or "").encode()))

    def base(self, t):
        own = re.findall(r"[^\x20\x09-\x0D]+", self.lower(t))
        value = lambda c: math.log10((c + 0.5) / (self.total + 0.5 * (self.types + 1)))
        return len(own) + 1, sum(w in self.words for w in own) + (self.docs > 0), sum(value(self.words[w]) for w in own) + value(self.docs)


def check(rows, texts, plain):
    assert len(rows) == len(texts)
    for r, (i, t) in zip(sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id, r.n_bytes)), sorted(texts, key=lambda x: (x[0] is not None, x[0], len((x[1] or "").encode()))), strict=True):
        n, known, base = plain.base(t)
        assert (r.doc_id, r.n_tokens, r.n_known, r.n_bytes) == (i, n, known, len((t or "").encode()))
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9) and math.isclose(r.score, plain.score(t), rel_tol=1e-8, abs_tol=1e-8), i
        assert math.isclose(r.bits_per_byte, -r.score / math.log10(2) / (r.n_bytes + 1), rel_tol=1e-9)


TEXTS = ["", None, "a", "Aa aA", "über Öl 𝔸", " \n\t ", "abc abc abc abd", prose(1, 60), prose(2, 30).upper(), "x" * 300, "\x00\x7f"]


def test_scores_against_plain_trees(frame):
    texts = list(enumerate(TEXTS)) + [(None, "ohne id"), (3, TEXTS[3]), (3, TEXTS[3]), (50, prose(9, 40) + " nie gesehen ")]
    df = frame([doc(*t) for t in texts]).selectExpr("*", "1 as key", "2 as n", "3 as uid", "4 as words")
    learned = [t for i, t in texts if i != 50]
    plain = Plain(learned)
    for common in (1 << 18, 40, 0):  # which keys are sent to all tasks changes nothing
        model = C.train(df.where("doc_id is null or doc_id <> 50"), common=common)
        assert (model.tokens, model.types, model.docs) == (plain.total, plain.types, plain.docs)
        assert all(len(k) <= common for k, _ in model.common.values())
        check(C.score(df, model).collect(), texts, plain)


def test_probabilities_of_the_next_byte_sum_to_one():
    plain = Plain(["abra cadabra", "über", ""])
    for before in (b"arba", b"a\xfe\xfe\xfe", b"qqqq", b"\xfe" * 4):
        assert math.isclose(sum(10 ** plain.byte(y, before) for y in range(256)), 1, rel_tol=1e-9)


def test_query_on_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in read_table(spark, sf, "documents").select("doc_id", "text").collect()]
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 1}
    plain = Plain([t for i, t in rows if i not in held])
    got = {r.doc_id: r for r in QUERIES["op12_context_trees"](spark, sf).collect()}
    assert set(got) == {i for i, _ in rows} and len(held) > 20
    for i, t in rows:
        r = got[i]
        assert (r.held_out, r.train_tokens, (r.n_tokens, r.n_known)) == (i in held, plain.total, plain.base(t)[:2])
        assert math.isclose(r.base_score, plain.base(t)[2], rel_tol=1e-9)
    few = [(i, t) for i, t in rows if len(t or "") < 1500][:25]
    assert all(math.isclose(got[i].score, plain.score(t), rel_tol=1e-8, abs_tol=1e-8) for i, t in few)
    # on texts that training never saw, trees need far fewer bits than bytes by themselves
    texts = {i: (t or "").encode() for i, t in rows}
    n = Counter(b for i, t in rows if i not in held for b in texts[i])
    alone = sum(-math.log2((n[b] + 0.5) / (sum(n.values()) + 128)) for i in held for b in texts[i])
    assert -sum(got[i].score for i in held) / math.log10(2) < 0.75 * alone


def test_empty_tables_and_a_long_text(frame, spark):
    none = C.train(frame([]))
    assert (none.tokens, none.types, C.score(frame([]), none).count()) == (0, 0, 0)
    r = C.score(frame([doc(1, "ab")]), none).first()
    assert (r.n_known, r.base_score) == (0, 0.0) and math.isclose(r.score, 24 * math.log10(0.5))
    long = prose(3, 400_000)
    df = frame([doc(1, long), doc(2, prose(4, 50))])
    r = C.score(df, C.train(df)).where("doc_id = 1").first()
    assert r.n_bytes == len(long) > 3_000_000 and 0 < r.bits_per_byte < 3


def test_log_gamma():
    x = np.concatenate([np.arange(1, 400) / 2, [1e4 + 0.5, 1e9, 1e15]])
    assert np.allclose(C.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)


def test_held_out_ids(frame):
    rows = frame([doc(i, "") for i in (0, 1, 2, 3, 77, None)]).select("doc_id", C.is_held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 1) for r in rows)

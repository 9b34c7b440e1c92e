import base64
import random
import re
from collections import Counter

import pytest
import zstandard

from encore.llm.compression import Band, CompressionRules, compression_report, keep_compressible
from encore.sources.tables import read_table
from llm.conftest import doc, prose

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text, rules=CompressionRules()):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    three = list(zip(w, w[1:], w[2:], strict=False))
    n = Counter(three)
    covered = {i + k for i, t in enumerate(three) if n[t] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    b, z = text.encode(), zstandard.ZstdCompressor(level=rules.level)
    lo = hi = 1.0
    if not text.isascii():
        order = sorted(set(text))
        if len(order) <= 256:
            b = bytes(order.index(c) for c in text)
        else:
            assert max(order) < "\U00010000"
            b, lo, hi = text.encode("utf-16-le"), rules.wide_lowest, rules.wide_highest
    band = [x for x in rules.bands if len(b) >= x.min_bytes][-1]
    ratio = len(b) / len(z.compress(b)) if b else 0.0
    size = rules.chunk_bytes
    full = [size / len(z.compress(b[j:j + size])) for j in range(0, len(b), size) if len(b) - j >= size]
    bad = any(sum(x) > rules.chunk_share * len(full) for x in ([r > rules.chunk_highest * hi for r in full], [r < rules.chunk_lowest * lo for r in full]))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed,
            not failed and band.lowest * lo <= ratio <= band.highest * hi and not bad)


def got(df):
    return [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in df]


def test_all_documents_against_plain_version(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = compression_report(docs).collect()
    assert len(rows) == len(texts)
    assert got(rows) == [plain(texts[r.doc_id]) for r in rows]


def test_edge_cases(frame):
    noise = "".join(chr(33 + (i * i * 2654435761 >> 7) % 90) + (" " if i % 23 == 0 else "") for i in range(9000))
    texts = [None, "", " \t\n\x0b\x0c\r", "é x", "a a a a a", "x\ny\nx\n \n \n", prose(1, 60), prose(1, 60), prose(2, 40000),
             "w" * 300_000, "the end is near " * 5000, noise, "| # " * 80]
    df = frame([doc(None if i == 3 else i, t) for i, t in enumerate(texts)])
    by = {(r.n_bytes, r.n_words, r.doc_id): r for r in compression_report(df).collect()}
    want = sorted(plain(t) for t in texts)
    assert sorted(got(by.values())) == want and len(by) == len(texts)


def test_verdicts(frame):
    rng = [(i * 48271 * 48271 + i * i * 7) % 9973 for i in range(30000)]
    hard = " ".join("".join(chr(0x4E00 + (x * 31 + k * 977 + x * k) % 20000) for k in range(3)) for x in rng[:9000])
    rows = {r.doc_id: r.verdict for r in compression_report(frame([
        doc(1, prose(3, 500)), doc(2, "short"), doc(3, "".join(f"{i} same words each time only numbers differ here\n" for i in range(2000))),
        doc(4, hard)])).collect()}
    assert rows[1] == "kept" and rows[2] == "base" and rows[3] in ("base", "repetitive") and rows[4] == "kept" or rows[4].startswith("incomp")


def encoded(n, seed=1):
    return base64.b64encode(random.Random(seed).randbytes(n * 3 // 4)).decode()


def test_one_text_per_verdict(frame):
    few = prose(5, 1000)
    text = prose(6, 12000)
    texts = {"kept": prose(3, 500), "base": "short", "repetitive": few + " " + " ".join([few[:1500]] * 3), "incompressible": few[:3000] + " " + encoded(3000),
             "repetitive_chunks": text[:55000] + few[:700] * 42, "incompressible_chunks": text[:55000] + encoded(27000)}
    loose = CompressionRules(bands=(Band(0, 0.0, 99.0),))  # whole texts pass, so the chunks decide
    for name, text in texts.items():
        rules = loose if name.endswith("chunks") else CompressionRules()
        assert [r.verdict for r in compression_report(frame([doc(1, text)]), rules).collect()] == [name]


def test_the_place_of_junk_does_not_matter(frame):
    loose = CompressionRules(bands=(Band(0, 0.0, 99.0),))
    for few, junk in ((prose(3, 500)[:4096], encoded(3900)), (prose(4, 300)[:2000], encoded(1800))):
        both = [few + " " + junk, junk + " " + few]
        rows = compression_report(frame([doc(i, t) for i, t in enumerate(both)]), loose).collect()
        assert [r.verdict for r in rows] == ["incompressible_chunks"] * 2
        same = few + " " + few[-300:] * (13 if len(few) > 4000 else 6)
        rows = compression_report(frame([doc(0, same)]), loose).collect()
        assert rows[0].verdict == "repetitive_chunks" or rows[0].base_failed
    rows = {r.doc_id: r for r in compression_report(frame([doc(n, (prose(8, 2000) + prose(9, 2000))[:n]) for n in (1000, 1024, 1500, 4095, 4096, 4097, 8192)])).collect()}
    assert {n: r.chunks for n, r in rows.items()} == {1000: 0, 1024: 1, 1500: 2, 4095: 4, 4096: 1, 4097: 2, 8192: 2}
    assert all(r.kept for r in rows.values())


def test_empty_table_and_clashing_columns(spark, frame):
    assert compression_report(frame([])).count() == 0 and keep_compressible(frame([])).columns == ["doc_id", "text", "lang", "source", "n_chars"]
    df = frame([(1, prose(1, 80), "x", 3.5), (2, None, "y", None)], "doc_id long, text string, kept string, ratio double")
    assert compression_report(df).where("kept").count() == 1
    assert [tuple(r) for r in keep_compressible(df).collect()] == [(1, prose(1, 80), "x", 3.5)]


def test_a_missing_text_column_is_an_error(frame):
    with pytest.raises(Exception, match="text"):
        keep_compressible(frame([(1,)], "doc_id long"))


def other_script(text):
    """Every ASCII letter as a Cyrillic one, one to one."""
    return "".join(chr(0x0410 + ord(c) - 65) if "A" <= c <= "Z" else chr(0x0450 + ord(c) - 97) if "a" <= c <= "z" else c for c in text)


def test_another_script_is_judged_alike(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.text]
    make = lambda f: spark.createDataFrame([(i, f(t)) for i, t in rows], "doc_id long, text string")
    a, b = ({r.doc_id: r.verdict for r in compression_report(make(f)).collect()} for f in (lambda t: t, other_script))
    kept = [sum(v == "kept" for v in x.values()) for x in (a, b)]
    assert kept[0] > 800 and abs(kept[0] - kept[1]) <= 0.01 * kept[0], kept
    assert sum(a[i] == b[i] for i in a) >= 0.98 * len(a)
    assert len({v for v in b.values()}) > 1


def test_many_distinct_characters():
    from encore.llm.compression import script_free
    assert script_free(b"abc") == (b"abc", False) and script_free("äbä".encode()) == (bytes([1, 0, 1]), False)
    wide = "".join(chr(0x4E00 + k) for k in range(300))
    assert script_free(wide.encode()) == (wide.encode("utf-16-le"), True)
    assert len(script_free((wide + "\U0001F600").encode())[0]) == 602 and script_free(b"\xff\xfe")[1] is False

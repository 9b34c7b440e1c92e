"""Operator 6, PII: information-theoretic sanitisation, in DataFrame expressions only.

Personal data of fixed shape (e-mail and IP addresses, card and phone numbers) are the protected entities. A term
of a document with a mention discloses the entity as far as knowing the term tells the entity: with document counts
over the whole corpus, PMI(t, e) = log2(N * n(t, e) / (n(t) * n(e))) as a share of the entity's own information
IC(e) = log2(N / n(e)). A share of 1 means that the term occurs with the entity only. Terms above the lower
threshold are generalised to the class of their shape, above the higher one removed, wherever they occur, also in
documents without the entity; entities are replaced by their kind. A term must be seen with the entity in
``support`` documents, so chance meetings don't count.

Positions come from ``regexp_extract_all`` and ``split`` with the same pattern, whose results interleave.
Patterns use possessive quantifiers and borders, so runs of any length are read once, without recursion.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# The base patterns. A match cannot start inside a run that an earlier start has tried.
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"[\p{L}\p{N}]++"
MARK = "\x01"
SPAN = "array<struct<start:long,rank:int,end:long,value:string>>"
HIT = "array<struct<start:bigint,end:bigint,value:string>>"
#: Words placed together where all words of a text are wanted.
BLOCK = 64
#: Bits a disclosing term in the bitmap that leaves out other words, and its least and largest size (2 MB) in bits.
TERM_BITS, LEAST_BITS, MOST_BITS = 64, 1 << 16, 1 << 24


@dataclass(frozen=True)
class Disclosure:
    """support: documents that must hold term and entity; narrow: only words within ``context`` characters of a
    mention are tried as terms, otherwise those of the whole text."""

    generalise: float = 0.8
    remove: float = 0.95
    support: int = 3
    context: int = 60
    min_length: int = 3
    narrow: bool = False


def _pairs(text: Column, pattern: str) -> Column:
    """(gap before it, value) of every match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))


def _placed(pairs: Column) -> Column:
    """(at, out): the length of all pairs, and (start, end, value) of each."""
    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.cast("long").alias("start"), end.cast("long").alias("end"), x["value"].alias("value")))).alias("out"))

    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.array().cast(HIT).alias("out")), step)


def _interleaved(text: Column, pattern: str) -> Column:
    """(start, end, value) of every match, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(F.size(found) > 0, _placed(_pairs(text, pattern))["out"]).otherwise(F.array().cast(HIT))


def _shift(words: Column, by: Column) -> Column:
    return F.transform(words, lambda w: F.struct((w["start"] + by).alias("start"), (w["end"] + by).alias("end"), w["value"].alias("value")))


def _place_all(pairs: Column) -> Column:
    """(start, end, value) of every pair, in blocks, as appending to one array is quadratic."""
    def blocks(pairs: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / BLOCK).cast("int")),
                           lambda b: _placed(F.slice(pairs, b * BLOCK + 1, F.lit(BLOCK))))

    def step(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(_shift(x["out"], acc["at"]))).alias("out"))

    # the one-item array binds the pairs, which would otherwise be made again for every block
    placed = F.transform(F.array(pairs), lambda x: F.when(F.size(x) > 0, blocks(x)))[0]
    out = F.flatten(F.aggregate(placed, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{HIT}>").alias("out")), step)["out"])
    return F.coalesce(out, F.array().cast(HIT))


def _all_words(text: Column, p: Disclosure) -> Column:
    """(start, end, value) of every word of a text."""
    return F.filter(_place_all(_pairs(text, WORD)), lambda w: F.length(w["value"]) >= p.min_length)


def _words(text: Column, p: Disclosure, wanted: Callable[[Column], Column]) -> Column:
    """(start, end, value) of the ``wanted`` words of a text (gaps that look wanted are among them).

    Wanted words are put between marks and the text is cut there, so only they are placed, whatever the text's length.
    """
    marked = F.transform(F.regexp_extract_all(F.translate(text, MARK, " "), F.lit(rf"{WORD}|[^\p{{L}}\p{{N}}]++"), F.lit(0)),
                         lambda w: F.when((F.length(w) >= p.min_length) & wanted(w), F.concat(F.lit(MARK), w, F.lit(MARK))).otherwise(w))
    parts = F.split(F.array_join(marked, ""), MARK, -1)
    pairs = F.transform(F.array(parts), lambda x: F.when(F.size(x) > 1, F.transform(
        F.sequence(F.lit(0), F.size(x) - 3, F.lit(2)), lambda k: F.struct(F.get(x, k).alias("gap"), F.get(x, k + 1).alias("value")))))[0]
    return _place_all(F.coalesce(pairs, F.array().cast("array<struct<gap:string,value:string>>")))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    d = F.reverse(_digits(value))
    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda a, i: a + F.when(
        i % 2 == 1, F.substring(d, i, F.lit(1)).cast("int")).otherwise(
        (F.substring(d, i, F.lit(1)).cast("int") * 2 / 10).cast("int") + F.substring(d, i, F.lit(1)).cast("int") * 2 % 10))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0++(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(_digits(value)).between(14, 19) & _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _findings(text: Column, rank: int, kind: str, pattern: str) -> Column:
    hits = F.filter(_interleaved(text, pattern), lambda m: _valid(kind, m["value"]))
    return F.transform(hits, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), m["value"].alias("value")))


def base_spans(text: Column) -> Column:
    """All base findings of a text, by start, then kind: array<struct<start, rank, end, value>>."""
    none = F.array().cast(SPAN)
    parts = []
    for rank, (kind, pattern, sign) in enumerate(zip(KINDS, (EMAIL, IP, CARD, PHONE), ("@", ".", None, "+"), strict=True)):
        own = _findings(text, rank, kind, pattern)
        here = text.contains(sign) if sign else F.lit(True)
        # each pattern needs digits, or for e-mail the sign: most texts are done after one quick look
        parts.append(F.when(here if kind == "email" else here & text.rlike("[0-9][^0-9]?[0-9]" if kind == "card" else "[0-9]"), own).otherwise(none))
    return F.array_sort(F.concat(*parts))


def _entity(s: Column) -> Column:
    return F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1),
                       F.when(s["rank"] >= 2, _digits(s["value"])).otherwise(F.lower(s["value"])))


def _near_words(text: Column, s: Column, p: Disclosure) -> Column:
    """(start, end, value) of the whole words within ``context`` characters of a span."""
    lo = F.greatest(s["start"] - p.context, F.lit(0))
    left = F.substring(text, (lo + 1).cast("int"), (s["start"] - lo).cast("int"))
    right = F.substring(text, (s["end"] + 1).cast("int"), F.lit(p.context))
    before = F.filter(_shift(_interleaved(left, WORD), lo), lambda w: (w["start"] > lo) | (lo == 0))
    stop = s["end"] + p.context
    after = F.filter(_shift(_interleaved(right, WORD), s["end"]), lambda w: (w["end"] < stop) | (F.length(text) <= stop))
    return F.filter(F.concat(before, after), lambda w: F.length(w["value"]) >= p.min_length)


def row_uid(id_col: str = "doc_id", text_col: str = "text") -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def find_personal_data(docs: DataFrame, p: Disclosure = Disclosure(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, uid, base and terms (arrays of (start, rank or disclosure, end, value)), in code points.

    Null texts are empty; repeated rows each get a row and count as a document each; null ids stay null; whole texts
    of any length; other columns are ignored; an empty table gives an empty result. A term inside a base finding is
    not looked at; one on a threshold is above it. A term that discloses several entities takes the highest
    disclosure. An entity that every document holds has no information to disclose.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("uid", row_uid())
    base = rows.withColumn("base", base_spans(text))
    # the row's id comes before explode: in one select with it, Spark would number the mentions
    found = base.select("doc_id", "uid", F.monotonically_increasing_id().alias("row"), "base", F.when(F.size("base") > 0, text).alias("own")).checkpoint()
    total = rows.count()

    mentions = found.where("own is not null")
    held = mentions.select("row", F.explode(F.array_distinct(F.transform("base", _entity))).alias("entity"))
    n_e = held.groupBy("entity").agg(F.count("*").alias("n_e"), *_signature()) \
        .where(F.col("n_e") >= p.support).withColumn("ic", F.log2(F.lit(float(total)) / F.col("n_e"))).where("ic > 0").checkpoint()
    n_te = _met_narrow(mentions, n_e, p) if p.narrow else _met(mentions, held, n_e, total, p)
    spoken = F.array_distinct(F.transform(F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda w: F.length(w) >= p.min_length), F.lower))
    n_t = rows.select(F.explode_outer(spoken).alias("term")).where("term is not null").groupBy("term").agg(F.count("*").alias("n_t"))
    close = n_te.join(n_t, "term") \
        .withColumn("disclosure", F.log2(F.lit(float(total)) * F.col("n_te") / (F.col("n_t") * F.col("n_e"))) / F.col("ic")) \
        .where(F.col("disclosure") >= p.generalise).groupBy("term").agg(F.max("disclosure").alias("disclosure")).checkpoint()

    maybe = _bitmap(close)
    # explode_outer, as Spark would put explode's test for empty arrays, and with it all the work, before it once more
    words = rows.select("uid", F.explode_outer(_words(text, p, lambda v: maybe(F.lower(v)))).alias("w")).where("w is not null")
    terms = words.select("uid", F.lower("w.value").alias("term"), "w.start", "w.end", "w.value").join(close, "term") \
        .groupBy("uid", "start", "end", "value").agg(F.max("disclosure").alias("disclosure")) \
        .groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "disclosure", "end", "value"))).alias("all"))
    none = F.array().cast("array<struct<start:bigint,disclosure:double,end:bigint,value:string>>")
    return found.select("doc_id", "uid", "base").join(terms, "uid", "left").select(
        "doc_id", "uid", "base", F.coalesce(F.filter("all", lambda w: ~_inside(w)), none).alias("terms"))


def _bitmap(close: DataFrame) -> Callable[[Column], Column]:
    """A test that passes every term of ``close`` and few other words, so that few are shuffled to the join with it.

    The bitmap grows with the number of terms up to a fixed size; beyond it, it passes more words, never fewer terms.
    """
    n = min(MOST_BITS, max(LEAST_BITS, 1 << (TERM_BITS * close.count()).bit_length()))
    bucket = lambda term: F.pmod(F.xxhash64(term), F.lit(n))
    bits = {r.k: r.v for r in close.select(bucket("term").alias("b")).groupBy(F.floor(F.col("b") / 64).alias("k")).agg(
        F.expr("bit_or(shiftleft(1L, cast(b % 64 as int)))").alias("v")).collect()}
    bitmap = F.split(F.lit(",".join(str(bits.get(k, 0)) for k in range(n // 64))), ",").cast("array<bigint>")
    return lambda w: F.getbit(F.get(bitmap, F.floor(bucket(w) / 64).cast("int")), (bucket(w) % 64).cast("int")) == 1


def _inside(w: Column) -> Column:
    return F.exists("base", lambda b: (w["start"] < b["end"]) & (b["start"] < w["end"]))


def _signature() -> tuple[Column, Column]:
    """Two hashes of the set of rows that a group holds, each row once."""
    return tuple(F.expr(f"bit_xor(xxhash64(row, {k}))").alias(f"rows{k}") for k in (0, 1))


def _met(mentions: DataFrame, held: DataFrame, n_e: DataFrame, total: int, p: Disclosure) -> DataFrame:
    """(term, n_te, n_e, ic): in how many documents a term and an entity of ``n_e`` meet, if they could reach the threshold.

    Entities of the same documents count alike, and so do terms: one of each such class stands for all, so a directory
    of many numbers that is copied again and again gives one pair, not all numbers times all words. With n_te <= n_e
    and n_te <= n(t), a pair whose best case stays below the threshold is left out before it is counted.
    """
    held = held.join(n_e, "entity", "left_semi")
    words = F.array_distinct(F.transform(F.filter(_all_words(F.col("own"), p), lambda w: ~_inside(w)), lambda w: F.lower(w["value"])))
    said = mentions.join(held, "row", "left_semi").select("row", F.explode(words).alias("term")).checkpoint()
    set_of = ["n", "rows0", "rows1"]
    terms = said.groupBy("term").agg(F.count("*").alias("n"), *_signature()).where(F.col("n") >= p.support)
    classes = terms.groupBy(*set_of).agg(F.min("term").alias("first")).checkpoint()
    entities = n_e.groupBy(F.col("n_e"), "rows0", "rows1").agg(F.min("entity").alias("entity"), F.first("ic").alias("ic"))
    left = held.join(entities.select("entity", "n_e", "ic"), "entity")
    right = said.join(classes.select(F.col("first").alias("term"), "n"), "term")
    best = F.log2(F.lit(float(total)) / F.greatest("n_e", "n"))
    met = left.join(right, "row").where(best >= F.col("ic") * (p.generalise - 1e-9)) \
        .groupBy("entity", F.col("term").alias("first")).agg(F.count("*").alias("n_te"), F.first("n_e").alias("n_e"), F.first("ic").alias("ic")) \
        .where(F.col("n_te") >= p.support)
    members = terms.join(classes, set_of).select("term", "first")
    return met.join(members, "first").select("term", "n_te", "n_e", "ic")


def _met_narrow(mentions: DataFrame, n_e: DataFrame, p: Disclosure) -> DataFrame:
    """As ``_met``, for the words within ``context`` characters of the entity's mentions."""
    near = mentions.select("row", "base", "own", F.explode("base").alias("s")) \
        .select("row", _entity(F.col("s")).alias("entity"), F.filter(_near_words(F.col("own"), F.col("s"), p), lambda w: ~_inside(w)).alias("words"))
    met = near.join(n_e, "entity", "left_semi").select("row", "entity", F.explode("words.value").alias("w")) \
        .select("row", "entity", F.lower("w").alias("term")).distinct().groupBy("entity", "term").agg(F.count("*").alias("n_te"))
    return met.where(F.col("n_te") >= p.support).join(n_e, "entity").select("term", "n_te", "n_e", "ic")


def span_text(spans: Column) -> Column:
    """kind:start:end of (start, rank, end) structs, comma-joined; ranks beyond the kinds are terms."""
    kinds = F.array(*map(F.lit, (*KINDS, TERM)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def all_spans(base: Column, terms: Column) -> Column:
    """Base and term spans together, by start, then kind."""
    short = lambda s, rank: F.struct(s["start"].alias("start"), rank.alias("rank"), s["end"].alias("end"))
    return F.array_sort(F.concat(F.transform(base, lambda s: short(s, s["rank"])), F.transform(terms, lambda s: short(s, F.lit(len(KINDS))))))


def sanitise(docs: DataFrame, found: DataFrame, p: Disclosure = Disclosure(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with entities replaced by their kind in brackets, generalised terms by their class, others removed.

    Overlapping findings are replaced by the first of them. Rows without findings stay unchanged, null texts null.
    """
    label = F.element_at(F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS)), F.col("s.rank") + 1)
    shape = F.when(F.col("s.value").rlike(r"^[\p{N}]+$"), "[NUMBER]").when(F.col("s.value").rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
    cuts = found.select("uid", F.explode("base").alias("s")).select("uid", "s.start", "s.end", label.alias("put")).unionByName(
        found.select("uid", F.explode("terms").alias("s")).select("uid", "s.start", "s.end", F.when(F.col("s.disclosure") >= p.remove, "").otherwise(shape).alias("put")))
    cuts = cuts.distinct().groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "end", "put"))).alias("_cuts"))
    text = F.col(f"row.{text_col}")

    def step(acc: Column, c: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (c["start"] - acc["at"]).cast("int"))
        return F.when(c["start"] >= acc["at"], F.struct(c["end"].alias("at"), F.concat(acc["out"], gap, c["put"]).alias("out"))) \
            .otherwise(F.struct(F.greatest(acc["at"], c["end"]).alias("at"), acc["out"].alias("out")))

    done = F.aggregate("_cuts", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")  # whole, so no column name can clash
    joined = docs.select(row_uid(id_col, text_col).alias("uid"), row).join(cuts, "uid", "left")
    new = F.when(F.col("_cuts").isNull(), text).otherwise(done).alias(text_col)
    return joined.select(*(new if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns))

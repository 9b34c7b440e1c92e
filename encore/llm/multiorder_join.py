"""Operator 7, n-gram Jaccard join: prefix filters under several global token orders, then verification.

A document is the set of its distinct 5-word shingles (64-bit hashes). Two sets with Jaccard >= t have an
overlap of at least ceil(t * n) of either set, so under *any* global order of all shingles their prefixes of
length m - ceil(t * n) + 1 share a shingle (m: shingles of the set that occur in any other set; the rest can
never be shared, so they are left out of the sets and of the prefixes). Three orders are used: by document
frequency (rare first) and by two hash functions. The first order proposes candidates, which must also share
a prefix shingle under the other two before their overlap is counted.

Jobs, each a DataFrame step with Spark doing the partitioning:

1. ``signatures``: one pass over the texts, (row, n, 64-bit signature of the set). Equal sets are one class;
   everything below works on classes, so a group of copies, whatever its size, is one node.
2. shingle frequencies: map tasks sort the shingles of a batch of texts and send packed runs (8 bytes a shingle)
   to the task of their hash range, which keeps those that two classes hold. A shingle held by many texts of a
   batch is sent as *one* entry saying so, and its texts get it directly, so no task receives a third of all
   texts for a passage that a third of them share; such shingles rank last in the frequency order.
3. per class: its shared shingles; classes where fewer than ceil(t * n) are shared have no partner.
4. links, round 1: in each posting list (classes with the same first-order prefix shingle) everyone is compared
   with the class that has the smallest share of shingles of its own: in a group of edited copies that is the text
   they were made from, or the least edited one. Verified links are merged into components.
5. links, round 2: all other pairs of a posting list whose members are in *different* components. Entries meet by
   shingle and size class, in the range of sizes that their position leaves. Pairs within one component are not
   even formed: their result is known. So a large group of near copies costs its size, not its square, as do pages
   of one template that are too different to link, and no link between components is lost.

Results are exact up to 64-bit hash collisions of shingles and signatures (48 bits inside a candidate pair).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.graph import components
from encore.llm.textops import LOWER, U64, fmix, slices, sorted_distinct, text_bytes, window_hashes, word_hashes, words

TOKEN_BITS = 48
_TOKEN = U64((1 << TOKEN_BITS) - 1)
_LAST_RANK = 255
#: Parts of a component when its id is given back to its classes.
SALTS = 64


@dataclass(frozen=True)
class JoinParams:
    """percent: least Jaccard similarity in percent. batch_tokens: shingles a map task sorts and packs at once.

    common: a shingle of at least so many different texts of one batch travels pre-aggregated. pieces: a counting task
    works through its hash range in so many pieces. None of these three changes the result.
    """

    words: int = 5
    percent: int = 75
    batch_tokens: int = 1 << 20
    common: int = 64
    pieces: int = 8


def _sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    data, at = text_bytes(column)
    for lo, hi in slices(at):
        own = at[lo:hi + 1] - at[lo]
        part = LOWER[data[int(at[lo]):int(at[hi])]]
        starts, ends, first = words(part, own)
        h = word_hashes(part, starts, ends)
        runs = window_hashes(h, k)
        for d in range(hi - lo):
            a, b = int(first[d]), int(first[d + 1])
            if b - a >= k:
                yield sorted_distinct(runs[a:b - k + 1])
            elif b > a:  # all words as one sequence, never equal to a window of k words
                yield fmix(window_hashes(h[a:b], b - a) + U64(b - a))
            else:
                yield np.zeros(0, U64)


def _signature(s: np.ndarray) -> int:
    """Of a set, as a signed 64-bit number."""
    x = xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s))
    return x - (1 << 64) if x >> 63 else x


def signatures(docs: DataFrame, p: JoinParams, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, uid, n_shingles, sig) per row; uid is a hash of id and text, sig is null for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sig = [], []
            for s in _sets(b.column(2), p.words):
                n.append(len(s))
                sig.append(_signature(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(sig, pa.int64())],
                                             names=["doc_id", "uid", "n_shingles", "sig"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), row_uid(id_col, text_col).alias("uid"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, uid long, n_shingles long, sig long")


def row_uid(id_col: str = "doc_id", text_col: str = "text"):
    """A row's hash: equal for repeated rows only."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


# --- shared shingles of every class -------------------------------------------------------------------

#: A run of packed shingles. part: hash range whose task counts it; home: class range whose task gathers it, or -1.
#: sigs, ns: classes of the run and their sizes; counts: shingles by class; vals: packed shingles; common: see JoinParams.
_RUN = "part int, home int, sigs binary, ns binary, counts binary, vals binary, common binary"
_RUN_COLUMNS = [x.split()[0] for x in _RUN.split(", ")]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=_RUN_COLUMNS)


def _homeward(sigs: np.ndarray, ns: np.ndarray, sid: np.ndarray, vals: np.ndarray, parts: int) -> list[tuple]:
    """Runs for the class ranges (by way of the task of the same number): vals grouped by class (sid indexes sigs and ns)."""
    if not len(vals):
        return []
    home = (fmix(sigs.view(U64)) % U64(parts)).astype(np.int64)
    order = np.lexsort((sid, home[sid]))
    sid, vals = sid[order], vals[order]
    at = home[sid]
    cuts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1], [True])))
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own, counts = np.unique(sid[a:b], return_counts=True)
        out.append((int(at[a]), int(at[a]), sigs[own].tobytes(), ns[own].astype(np.int32).tobytes(),
                    counts.astype(np.int32).tobytes(), vals[a:b].tobytes(), None))
    return out


def _pack(sets: dict[int, np.ndarray], parts: int, common: int) -> list[tuple]:
    """Runs of a batch of classes, for the hash ranges (and straight home, for common shingles)."""
    sigs, ns = np.array(list(sets), np.int64), np.array([len(s) for s in sets.values()], np.int64)
    packed = np.concatenate(list(sets.values()))  # in place from here: a batch of shingles is large
    packed >>= U64(64 - TOKEN_BITS)
    packed <<= U64(16)
    packed |= np.repeat(np.arange(len(ns), dtype=U64), ns)
    packed.sort()
    token = packed >> U64(16)
    cuts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1], [True])))
    many = np.repeat(np.diff(cuts) >= common, np.diff(cuts))
    often = np.unique(token[many])
    out = _homeward(sigs, ns, (packed[many] & U64(0xFFFF)).astype(np.int64), token[many] | U64(_LAST_RANK << TOKEN_BITS), parts)
    packed, token = packed[~many], token[~many]
    edges = [(i << TOKEN_BITS) // parts for i in range(1, parts)]
    at = np.searchsorted(token, np.array(edges, U64))
    also = np.searchsorted(often, np.array(edges, U64))
    bounds, bounds2 = [0, *at.tolist(), len(packed)], [0, *also.tolist(), len(often)]
    for i in range(parts):
        own, told = packed[bounds[i]:bounds[i + 1]], often[bounds2[i]:bounds2[i + 1]]
        if len(own) or len(told):
            used, new = np.unique(own & U64(0xFFFF), return_inverse=True)
            used = used.astype(np.int64)
            own = (own & ~U64(0xFFFF)) | new.astype(U64)
            out.append((i, -1, sigs[used].tobytes(), ns[used].astype(np.int32).tobytes(), None, own.tobytes(), told.tobytes()))
    return out


def _shared(token: np.ndarray, sid: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed rank and token, class) of the entries whose token two classes hold, or that is known to be common."""
    order = np.argsort(token)
    token, sid = token[order], sid[order]
    del order
    known = np.isin(token, often) if len(often) else np.zeros(len(token), bool)
    more = known.copy()
    alike = token[1:] == token[:-1]
    more[1:] |= alike
    more[:-1] |= alike
    token, sid, known = token[more], sid[more], known[more]
    order = np.lexsort((sid, token))
    token, sid, known = token[order], sid[order], known[order]
    new = np.ones(len(token), bool)  # a class counts once, though several batches sent it
    new[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
    token, sid, known = token[new], sid[new], known[new]
    cuts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1], [True]))) if len(token) else np.zeros(1, np.int64)
    df = np.repeat(np.diff(cuts), np.diff(cuts))
    keep = known | (df > 1)
    rank = np.where(known, _LAST_RANK, np.minimum(4 * np.log2(np.maximum(df, 1)), _LAST_RANK - 1)).astype(U64)
    return token[keep] | rank[keep] << U64(TOKEN_BITS), sid[keep]


def _shared_shingles(docs: DataFrame, p: JoinParams, text_col: str) -> DataFrame:
    """(sig, n, vals): classes that share at least ceil(t * n) shingles with others, vals in first order."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        size = 0
        for b in batches:
            for s in _sets(b.column(0), p.words):
                if len(s) and (sig := _signature(s)) not in sets:
                    sets[sig] = s
                    size += len(s)
                    if size >= p.batch_tokens or len(sets) == 1 << 16:
                        yield _rows(_pack(sets, parts, p.common))
                        sets, size = {}, 0
        if sets:
            yield _rows(_pack(sets, parts, p.common))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, sigs, ns, common, base = [], [], [], [], 0
        for b in batches:
            own = []
            for r in b.to_pylist():
                if r["home"] >= 0:
                    own.append(tuple(r[c] for c in _RUN_COLUMNS))
                    continue
                runs.append((np.frombuffer(r["vals"], U64), base))
                sigs.append(np.frombuffer(r["sigs"], np.int64))
                ns.append(np.frombuffer(r["ns"], np.int32))
                common.append(np.frombuffer(r["common"], U64))
                base += len(sigs[-1])
            if own:
                yield _rows(own)
        if not runs:
            return
        sigs, which, sid = np.unique(np.concatenate(sigs), return_index=True, return_inverse=True)
        ns, often, sid = np.concatenate(ns)[which], np.unique(np.concatenate(common)), sid.astype(np.int32)
        # runs are sorted, so the range is counted piece by piece: the work arrays hold one piece
        borders = np.linspace(0, 1 << TOKEN_BITS, 1 + max(1, p.pieces) * parts).astype(U64) << U64(16)
        first = min((int(v[0]) for v, _ in runs if len(v)), default=0)
        last = max((int(v[-1]) for v, _ in runs if len(v)), default=0)
        inner = borders[(borders > first) & (borders <= last)]
        cuts = [np.concatenate(([0], np.searchsorted(v, inner), [len(v)])) for v, _ in runs]
        kept = []
        for k in range(len(inner) + 1):
            part = [(v[c[k]:c[k + 1]], at) for (v, at), c in zip(runs, cuts, strict=True) if c[k] < c[k + 1]]
            if part:
                kept.append(_shared(np.concatenate([v >> U64(16) for v, _ in part]),
                                    np.concatenate([sid[(v & U64(0xFFFF)).astype(np.int64) + at] for v, at in part]), often))
        if kept:
            out = _homeward(sigs, ns, np.concatenate([x for _, x in kept]).astype(np.int64), np.concatenate([v for v, _ in kept]), parts)
            if out:
                yield _rows(out)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, n, val = [], [], []
        for b in batches:
            for r in b.to_pylist():
                counts = np.frombuffer(r["counts"], np.int32)
                sig.append(np.repeat(np.frombuffer(r["sigs"], np.int64), counts))
                n.append(np.repeat(np.frombuffer(r["ns"], np.int32), counts))
                val.append(np.frombuffer(r["vals"], U64))
        if not sig:
            return
        sig, n, val = np.concatenate(sig), np.concatenate(n), np.concatenate(val)
        order = np.lexsort((val, sig))
        sig, n, val = sig[order], n[order], val[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (val[1:] != val[:-1])
        sig, n, val = sig[new], n[new], val[new]
        cuts = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1], [True])))
        first, m = cuts[:-1], np.diff(cuts)
        size = n[first].astype(np.int64)
        live = np.flatnonzero(100 * m >= p.percent * size)
        for lo in range(0, len(live), 1000):
            own = live[lo:lo + 1000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sig[first[own]], pa.int64()), pa.array(size[own], pa.int64()),
                 pa.array([val[first[i]:first[i] + m[i]].tobytes() for i in own], pa.binary()),
                 pa.array([val[first[i]:first[i] + _prefix(m[i], size[i], p.percent)].astype(np.int64) for i in own], pa.list_(pa.int64()))],
                names=["sig", "n", "vals", "prefix"])

    runs = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(pack, _RUN)
    counted = runs.repartitionById(parts, F.col("part")).mapInArrow(count, _RUN)
    return counted.repartitionById(parts, F.col("home")).mapInArrow(gather, "sig long, n long, vals binary, prefix array<long>")


def _prefix(m: int, n: int, percent: int) -> int:
    return int(m) - int(-(-percent * int(n) // 100)) + 1


# --- candidates and verification ----------------------------------------------------------------------

def _hash_order_prefix(tokens: np.ndarray, length: int, order: int) -> np.ndarray:
    """The first tokens under the order-th hash order."""
    h = fmix(tokens ^ U64(order * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return np.partition(h, length - 1)[:length] if length < len(h) else h


def _verify(pairs: DataFrame, shared: DataFrame, p: JoinParams) -> DataFrame:
    """The pairs (a, b) whose classes are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, sides = [b.column(i).to_numpy() for i in (2, 3)], [packed(b.column(i)) for i in (4, 5)]
            keep = np.zeros(b.num_rows, bool)
            for k in range(b.num_rows):
                x, y = (v[at[k]:at[k + 1]] & _TOKEN for v, at in sides)
                na, nb = int(sizes[0][k]), int(sizes[1][k])
                px, py = _prefix(len(x), na, p.percent), _prefix(len(y), nb, p.percent)
                keep[k] = all(len(np.intersect1d(_hash_order_prefix(x, px, o), _hash_order_prefix(y, py, o), True)) for o in (1, 2)) \
                    and 100 * (both := len(np.intersect1d(x, y, True))) >= p.percent * (na + nb - both)
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The packed shingles of a column of binaries and where each row's begin."""
        data, at = text_bytes(column)
        return np.frombuffer(data[at[0]:at[-1]].tobytes(), U64), (at - at[0]) // 8

    side = lambda c: shared.select(F.col("sig").alias(c), F.col("n").alias(f"n_{c}"), F.col("vals").alias(f"v_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "v_a", "v_b")
    return both.mapInArrow(run, "a long, b long")


def _apart(post: DataFrame, p: JoinParams) -> DataFrame:
    """(a, b), a < b, from posting entries (val, sig, n, m, pos, component): the pairs of one list that are in different
    components and that sizes and positions allow.

    What a class still shares from this shingle on, m - pos, bounds the two sizes' sum; so every entry has its own range
    of partners' sizes. Entries meet by shingle and size class, the larger set going to the classes of its range: pages of
    one template with too much text of their own have no range left and meet nobody. Components of a list meet first, by
    their extreme sizes; of two that may fit, the one with fewer members is spelled out before the other's members are
    compared with it. Members of one component are never paired.
    """
    size_class = lambda n: F.floor(F.log(F.col(n).cast("double")) / F.lit(float(np.log(1.1))))
    most = F.floor(F.lit(100 + p.percent) * (F.col("m") - F.col("pos")) / F.lit(p.percent)) - F.col("n")  # the partner's size
    post = post.withColumn("most", most)
    small = post.where("most >= n").select("val", size_class("n").alias("size"), "component", "sig", "n", "most")
    large = post.select("val", "component", "sig", "n", F.ceil(F.lit(p.percent) * F.col("n") / F.lit(100)).alias("lo"),
                        F.least("n", "most").alias("top")).where("lo <= top")
    large = large.withColumn("size", F.explode(F.sequence(size_class("lo"), size_class("top"))))
    x = small.select("val", "size", F.col("component").alias("cx"), F.col("sig").alias("x"), F.col("n").alias("nx"), "most")
    y = large.select("val", "size", F.col("component").alias("cy"), F.col("sig").alias("y"), F.col("n").alias("ny"), "lo", "top")
    groups_x = x.groupBy("val", "size", "cx").agg(F.min("nx").alias("least_x"), F.max("most").alias("most_x"), F.count("*").alias("kx"))
    groups_y = y.groupBy("val", "size", "cy").agg(F.max("top").alias("top_y"), F.min("ny").alias("least_y"), F.count("*").alias("ky"))
    may = groups_x.join(groups_y, ["val", "size"]).where("cx <> cy and least_x <= top_y and most_x >= least_y").checkpoint()
    fit = "nx between lo and top and ny <= most and (nx < ny or x < y)"
    few_x = may.where("kx <= ky").join(x, ["val", "size", "cx"]).where("nx <= top_y and most >= least_y") \
        .join(y, ["val", "size", "cy"]).where(fit)
    few_y = may.where("kx > ky").join(y, ["val", "size", "cy"]).where("top >= least_x and ny <= most_x") \
        .join(x, ["val", "size", "cx"]).where(fit)
    ends = (F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return few_x.select(*ends).unionByName(few_y.select(*ends)).distinct()


def class_links(docs: DataFrame, p: JoinParams = JoinParams(), text_col: str = "text") -> DataFrame:
    """(sig, component) of all classes with a link to another class; component is the least sig reachable."""
    shared = _shared_shingles(docs, p, text_col).checkpoint()
    post = shared.select("sig", "n", F.octet_length("vals").alias("m"), F.posexplode("prefix").alias("pos", "val")) \
        .withColumn("m", (F.col("m") / 8).cast("long"))
    fits = lambda a, b: (100 * F.least(a, b) >= p.percent * F.greatest(a, b))
    alone = (1000 * (F.col("n") - F.col("m")) / F.col("n")).cast("int").alias("alone")  # what it shares with nobody
    lists = post.groupBy("val").agg(F.min(F.struct(alone, "sig", "n")).alias("lead"), F.count("*").alias("held")).where("held > 1")
    first = post.join(lists, "val").where((F.col("sig") != F.col("lead.sig")) & fits(F.col("n"), F.col("lead.n"))) \
        .select(F.col("lead.sig").alias("a"), F.col("sig").alias("b")).distinct().checkpoint()
    linked = _verify(first, shared, p).checkpoint()
    near = components(linked).checkpoint()

    placed = post.join(near.select(F.col("node").alias("sig"), "component"), "sig", "left") \
        .withColumn("component", F.coalesce("component", "sig")).checkpoint()
    split = placed.groupBy("val").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("val")
    second = _apart(placed.join(split, "val", "left_semi"), p)
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _verify(second.join(tried, ["a", "b"], "left_anti"), shared, p)
    whole = components(linked.unionByName(more))
    return whole.select(F.col("node").alias("sig"), "component")


def near_duplicates(docs: DataFrame, p: JoinParams = JoinParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, uid, n_shingles, component_id) per row: the least doc_id reachable over links, itself included.

    Cases: null or empty texts and texts without words have an empty set, n_shingles 0, and are linked with nothing;
    texts with fewer words than a shingle are one shingle; repeated rows and equal texts are linked. A null doc_id
    stays null and is never a component_id; a component of such rows only has a null component_id. Rows that share a
    doc_id but not the text are separate documents. Whole texts of any length; other columns are ignored; an empty
    table gives an empty result. The result is lazy; its inputs lie in spark.checkpoint.dir.
    """
    rows = signatures(docs, p, id_col, text_col).checkpoint()
    classes = rows.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("least"))
    classes = classes.join(class_links(docs, p, text_col), "sig", "left").checkpoint()
    alone = classes.where("component is null").select(F.col("sig").alias("class_sig"), F.col("least").alias("component_id"))
    # a component may hold a third of all classes: its id comes back by (component, salt), once for each salt it has
    linked = classes.where("component is not null").withColumn("salt", F.pmod(F.xxhash64("sig"), F.lit(SALTS)))
    group = linked.groupBy("component", "salt").agg(F.min("least").alias("least")).groupBy("component") \
        .agg(F.min("least").alias("component_id"), F.collect_list("salt").alias("salts"))
    group = group.select("component", "component_id", F.explode("salts").alias("salt"))
    named = alone.unionByName(linked.join(group, ["component", "salt"]).select(F.col("sig").alias("class_sig"), "component_id"))
    out = rows.join(named, rows.sig == F.col("class_sig"), "left")
    return out.select("doc_id", "uid", "n_shingles", F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one_per_group(docs: DataFrame, p: JoinParams = JoinParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of every component the row with the least doc_id stays.

    Repeated rows count once; of rows that share the least doc_id and are linked one stays. Rows with an empty set all
    stay, as do rows whose component has no doc_id at all.
    """
    found = near_duplicates(docs, p, id_col, text_col)
    lone = F.col("n_shingles").eqNullSafe(0)
    stay = found.where(lone | F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id")))
    one = stay.where(~lone & F.col("component_id").isNotNull()).groupBy("component_id").agg(F.min("uid").alias("_uid"))
    rest = stay.where(lone | F.col("component_id").isNull()).select(F.col("uid").alias("_uid")).distinct()
    chosen = one.select("_uid").unionByName(rest).distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")  # whole, so no column name can clash
    kept = docs.select(row_uid(id_col, text_col).alias("_uid"), row).join(chosen, "_uid", "left_semi")
    return kept.dropDuplicates(["_uid"]).select("row.*")

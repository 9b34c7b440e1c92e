"""Operator 10, secret scans: rules for known shapes, a character convolutional network for the rest.

Rules find three kinds of secrets; every other candidate goes, with its surrounding context, through a small
character CNN written in numpy: byte embeddings and an inside-the-candidate flag, one convolution, ReLU, maximum and
mean over positions, logistic output. A candidate is a run of 8 or more token characters, base findings cut out of it,
that is not just words, numbers and words with a number; runs of 16 or more letters are candidates even so.

The network is trained on labelled findings: values that the rules found in the corpus (secret), runs of a harmless
shape (long words, numbers, ids), and the findings of many formats that ship with it (``secret_formats``); what
neither the rules nor the shape knows is judged, but never learned from. The keyword in front is blanked out in half
of the rules' values, so that the value's own shape has to be learned. The threshold must hold for formats the network
has not seen: in three folds a rule's kind and a third of the shipped formats, secret and harmless, are left out of
training and scored; these scores calibrate (Platt), and the threshold is the highest that keeps the required recall on
them. All findings of the corpus train, calibrate and set the threshold: those of a frequent label are dealt over tasks by
hash, every task goes on from one start over its own, and the networks are averaged. However many they are, they weigh
together as ``CnnParams.sample`` findings, so that they don't drown the other formats.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.secret_formats import shipped
from encore.llm.textops import slices, text_bytes

# The rules of the base findings.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 8, 16, 32
KINDS = ("assign", "access", "hex", "cnn")

CONTEXT, PIECE, STEP, WIDTH = 24, 64, 48, 5
LENGTH = PIECE + 2 * CONTEXT
CANDIDATE_MIN, WORD_MIN, LETTERS = 8, 12, 16
FOLDS, BATCH = 3, 128


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


DIGIT = _table(b"0123456789")
HEX = _table(b"0123456789abcdef")
RUN = DIGIT | _table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-")


@dataclass(frozen=True)
class CnnParams:
    """sample: what a label of the corpus weighs at most, in shipped findings; all of its findings share that weight alike.
    recall: share of the secrets of left-out formats that must pass. formats: shipped findings of each format. shard:
    findings of frequent labels a task trains on. steps: least steps a task takes, going over its findings again."""

    sample: int = 400
    recall: float = 0.98
    filters: int = 24
    dims: int = 8
    epochs: int = 12
    seed: int = 10
    formats: int = 40
    shard: int = 20_000
    steps: int = 150


@dataclass
class CnnModel:
    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: float
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 1.1


# --- candidates ---------------------------------------------------------------------------------------

def _runs(flags: np.ndarray, own: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of set flags of at least ``least`` bytes, cut at text borders."""
    n = len(flags)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[own] = True
    begins, stops = flags.copy(), flags.copy()
    begins[1:] &= ~flags[:-1] | edge[1:n]
    stops[:-1] &= ~flags[1:] | edge[1:n]
    s, e = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    long = e - s >= least
    return s[long], e[long]


def base_findings(text: bytes) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, value start, value end) in bytes; hex runs are found by the caller's table."""
    found = [(m.start(), 0, m.end(), *m.span(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    return found + [(m.start(), 1, m.end(), *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]


def _scan(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, bytes, list, list]]:
    """(row, text, base findings, other candidates) of every row that has any, in order; offsets in bytes."""
    for lo, hi in slices(at):
        base = int(at[lo])
        own, part = at[lo:hi + 1] - base, data[base:int(at[hi])]
        whole = part.tobytes()
        small = whole.lower()
        texts: dict[int, tuple[list, list]] = {}
        hits = [i for k in KEYWORDS for i in _places(small, k)] + list(_places(whole, b"AKIA"))
        for d in sorted(set((np.searchsorted(own, np.array(hits, np.int64), "right") - 1).tolist())) if hits else []:
            if got := base_findings(whole[own[d]:own[d + 1]]):
                texts[d] = (got, [])
        for s, e, kind in ((*_runs(HEX[part], own, HEX_MIN), 0), (*_runs(RUN[part], own, CANDIDATE_MIN), 1)):
            row = np.searchsorted(own, s, "right") - 1
            for d, i, j in zip(row.tolist(), (s - own[row]).tolist(), (e - own[row]).tolist(), strict=True):
                texts.setdefault(d, ([], []))[kind].append((i, j) if kind else (i, 2, j, i, j))
        for d in sorted(texts):
            found, others = texts[d]
            found.sort()
            yield lo + d, whole[own[d]:own[d + 1]], found, _outside(others, found)


def _places(text: bytes, what: bytes) -> Iterator[int]:
    i = text.find(what)
    while i >= 0:
        yield i
        i = text.find(what, i + len(what))


def _outside(runs: list[tuple[int, int]], found: list[tuple], least: int = CANDIDATE_MIN) -> list[tuple[int, int]]:
    """What base findings (in order of start) leave of the runs (in order too): pieces of at least ``least`` bytes."""
    out, taken, k = [], -1, 0
    for i, j in runs:
        while k < len(found) and found[k][0] < j:
            if found[k][0] - max(i, taken) >= least:
                out.append((max(i, taken), found[k][0]))
            taken, k = max(taken, found[k][2]), k + 1
        if j - max(i, taken) >= least:
            out.append((max(i, taken), j))
    return out


HARMLESS = re.compile(rb"(?:[+/_=-]|(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+|[A-Z]?[a-z]+[0-9]+[a-z]*)(?![A-Za-z0-9]))++")
LONG = re.compile(rb"[A-Za-z]{%d}" % LETTERS)


def _is_harmless(text: bytes, i: int, j: int) -> bool:
    """Words, numbers (cards, phones, dates) and ids of one word and one number, joined by separators."""
    return HARMLESS.fullmatch(text, i, j) is not None


def _is_candidate(text: bytes, i: int, j: int) -> bool:
    return not _is_harmless(text, i, j) or LONG.search(text, i, j) is not None


def windows(text: bytes, i: int, j: int, blank: bool = False) -> Iterator[bytes]:
    """LENGTH bytes (inside flag in the high bit would clash with UTF-8, so the length of the piece leads) a piece."""
    for a in range(i, max(j - PIECE + STEP, i + 1), STEP):
        b = min(a + PIECE, j)
        left = b" " * CONTEXT if blank else text[max(0, a - CONTEXT):a].rjust(CONTEXT)
        yield bytes([b - a]) + (left + text[a:b] + text[b:b + CONTEXT].ljust(CONTEXT)).ljust(LENGTH)


# --- the network --------------------------------------------------------------------------------------

def _inputs(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, inside flags), one row each."""
    x = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), LENGTH + 1)
    k = np.arange(LENGTH)[None]
    return x[:, 1:], ((k >= CONTEXT) & (k < CONTEXT + x[:, :1].astype(np.int64))).astype(np.float32)


def _tables(m: CnnModel) -> np.ndarray:
    """(place in the window, byte + 256 if inside, filter): what that byte adds to the filter there; the middle one has the
    bias, and outside the candidate a penalty (context counts, but less than the candidate itself)."""
    conv = m.conv.reshape(WIDTH, -1, len(m.bias))
    outside = m.embed @ conv[:, :-1]
    t = np.concatenate([outside, outside + conv[:, -1:]], 1)
    t[WIDTH // 2] += m.bias
    t[WIDTH // 2, :256] -= 2.0
    return t


def _forward(m: CnnModel, x: np.ndarray, inside: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, ...]:
    """(activations, place of each filter's maximum, its value, mean inside the candidate, logit)."""
    code, n = x + (inside > 0) * np.intp(256), LENGTH - WIDTH + 1
    a = np.take(tables[0], code[:, :n], 0)
    more = np.empty_like(a)
    for k in range(1, WIDTH):
        a += np.take(tables[k], code[:, k:k + n], 0, out=more, mode="clip")
    here = inside[:, WIDTH // 2:WIDTH // 2 + n]
    best = a.argmax(1)
    top = np.take_along_axis(a, best[:, None], 1)[:, 0]
    share = here / np.maximum(here.sum(1, keepdims=True), 1)
    mean = (share[:, None] @ np.maximum(a, 0, out=more))[:, 0]
    return a, best, top, mean, np.maximum(top, 0) @ m.out[:len(m.bias)] + mean @ m.out[len(m.bias):] + m.shift


def _gradients(m: CnnModel, x: np.ndarray, inside: np.ndarray, err: np.ndarray, a: np.ndarray, best: np.ndarray, top: np.ndarray) -> list[np.ndarray]:
    """Gradients of the embeddings, the convolution and its bias: only places inside and of a maximum have any."""
    f, d = len(m.bias), m.embed.shape[1]
    here = inside[:, WIDTH // 2:WIDTH // 2 + a.shape[1]]
    lit = here > 0
    np.put_along_axis(lit, best, True, 1)
    row, place = np.nonzero(lit)
    number = np.zeros(lit.shape, np.intp)
    number[row, place] = np.arange(len(row))
    share = (err[:, None] * here / np.maximum(here.sum(1, keepdims=True), 1))[row, place]
    back = m.out[f:] * share[:, None] * (a[row, place] > 0)  # the mean's part, then the maximum's
    back[np.take_along_axis(number, best, 1), np.arange(f)] += err[:, None] * m.out[:f] * (top > 0)
    at = place[:, None] + np.arange(WIDTH)
    own = x[row[:, None], at].astype(np.intp)
    z = np.concatenate([m.embed[own], inside[row[:, None], at][:, :, None]], 2).reshape(len(row), -1)
    grad_z = (back @ m.conv.T).reshape(len(row), WIDTH, d + 1)[..., :d]
    grad_e = np.bincount((own[:, :, None] * d + np.arange(d)).ravel(), grad_z.ravel(), m.embed.size)
    return [grad_e.reshape(m.embed.shape).astype(np.float32), z.T @ back, back.sum(0)]


def fit(rows: list[bytes], labels: np.ndarray, p: CnnParams, weights: np.ndarray | None = None, start: CnnModel | None = None,
        rate: float = 0.01, epochs: int | None = None) -> CnnModel:
    """Train by Adam on the logistic loss, both labels weighing alike; the same rows in the same order give the same network.
    ``start`` is a network to go on from."""
    rng = np.random.default_rng(p.seed)
    size, f = WIDTH * (p.dims + 1), p.filters
    m = CnnModel(rng.normal(0, 0.3, (256, p.dims)).astype(np.float32), rng.normal(0, size ** -0.5, (size, f)).astype(np.float32),
                 np.zeros(f, np.float32), rng.normal(0, 0.3, 2 * f).astype(np.float32), 0.0)
    if start is not None:
        m = unpacked(packed(start), p)
    own = np.ones(len(rows)) if weights is None else weights / weights.mean()
    share = (own * labels).mean()
    weight = (own * np.where(labels == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))).astype(np.float32)
    params = [m.embed, m.conv, m.bias, m.out, np.full(1, m.shift, np.float32)]
    moment = [[np.zeros_like(v), np.zeros_like(v)] for v in params]
    step = 0
    for _ in range(epochs or p.epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            i = order[lo:lo + BATCH]
            x, inside = _inputs([rows[k] for k in i.tolist()])
            a, best, top, mean, logit = _forward(m, x, inside, _tables(m))
            err = (weight[i] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[i])).astype(np.float32) / len(i)
            grads = [*_gradients(m, x, inside, err, a, best, top), np.concatenate([err @ np.maximum(top, 0), err @ mean]), np.array([err.sum()], np.float32)]
            step += 1
            for v, g, mv in zip(params, grads, moment, strict=True):
                mv[0] += 0.1 * (g - mv[0])
                mv[1] += 0.01 * (g * g - mv[1])
                v -= rate * (mv[0] / (1 - 0.9 ** step)) / (np.sqrt(mv[1] / (1 - 0.99 ** step)) + 1e-8)
            m.shift = float(params[4][0])
    return m


def packed(m: CnnModel) -> np.ndarray:
    """The network's numbers in one row."""
    return np.concatenate([m.embed.ravel(), m.conv.ravel(), m.bias, m.out, [m.shift]]).astype(np.float32)


def unpacked(v: np.ndarray, p: CnnParams) -> CnnModel:
    size, f = WIDTH * (p.dims + 1), p.filters
    embed, conv, bias, out, shift = np.split(v.astype(np.float32), np.cumsum([256 * p.dims, size * f, f, 2 * f]))
    return CnnModel(embed.reshape(256, p.dims), conv.reshape(size, f), bias, out, float(shift[0]))


def _logits(m: CnnModel, rows: list[bytes]) -> np.ndarray:
    tables = _tables(m)
    out = [_forward(m, *_inputs(rows[lo:lo + BATCH]), tables)[-1] for lo in range(0, len(rows), BATCH)]
    return np.concatenate(out) if out else np.zeros(0)


def calibrated(m: CnnModel, s: np.ndarray, labels: np.ndarray, recall: float, weights: np.ndarray | None = None) -> CnnModel:
    """Platt scaling of scores by Newton steps; then the highest threshold with the asked recall and a standard error to spare."""
    slope, offset = 1.0, 0.0
    u = np.ones(len(s)) if weights is None else weights
    n_good, n_bad = (u * labels).sum(), (u * (1 - labels)).sum()
    target = np.where(labels == 1, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(slope * s + offset, -30, 30)))
        g = np.array([(u * (q - target) * s).sum() + 1e-3 * (slope - 1), (u * (q - target)).sum()])
        v = u * (q * (1 - q) + 1e-6)
        h = np.array([[(v * s * s).sum() + 1e-3, (v * s).sum()], [(v * s).sum(), v.sum()]])
        d = np.linalg.solve(h, g)
        slope, offset = slope - float(np.clip(d[0], -1, 1)), offset - float(np.clip(d[1], -2, 2))
    m.slope, m.offset = max(slope, 1e-3), offset
    good, u = s[labels == 1], u[labels == 1]
    order = good.argsort(kind="stable")
    least = np.searchsorted(np.cumsum(u[order]), max(0.0, (1 - recall) * n_good - math.sqrt(recall * (1 - recall) * n_good)), "right")
    m.threshold = float(1 / (1 + np.exp(-np.clip(m.slope * good[order[min(least, len(good) - 1)]] + m.offset, -50, 50))))
    return m


def calibrate(m: CnnModel, rows: list[bytes], labels: np.ndarray, recall: float) -> CnnModel:
    """``calibrated`` on rows that ``m`` has not seen."""
    return calibrated(m, _logits(m, rows), labels, recall)


def probabilities(m: CnnModel, rows: list[bytes]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(m.slope * _logits(m, rows) + m.offset, -50, 50)))


# --- jobs ---------------------------------------------------------------------------------------------

def labelled_findings(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(label, row): 1, 2, 3 for values that the rules found, by kind (every other one without the text before it), 0 for
    long words, -2 for other candidates of a harmless shape, -1 for all else, which may be secrets without a rule."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels, rows = [], []
            for _, text, found, others in _scan(*text_bytes(b.column(0))):
                for k, x in enumerate(found):
                    for w in windows(text, x[3], x[4], blank=k % 2 == 1):
                        labels.append(1 + x[1])
                        rows.append(w)
                for i, j in others:
                    if j - i >= WORD_MIN and not _is_candidate(text, i, j):
                        for w in windows(text, i, j):
                            labels.append(-2 if any(48 <= c <= 57 for c in text[i:j]) else 0)
                            rows.append(w)
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(rows, pa.binary())], names=["label", "row"])

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "label int, row binary")


def shipped_rows(n: int) -> list[tuple[str, int, bytes]]:
    """(format, label, row) of the shipped findings; formats in a fixed order."""
    return [(name, label, w) for name, label, text, i, j in shipped(n) for w in windows(text, i, j)]


def _fold(label: int, row: bytes) -> int:
    """A rule's kind is left out as a whole; harmless runs of the corpus are dealt to the folds."""
    return label - 1 if label > 0 else zlib.crc32(row) % FOLDS


def _tuned(dealt: DataFrame, starts: list[CnnModel], fixed: tuple[list[bytes], np.ndarray, np.ndarray], weigh: dict[int, float],
           p: CnnParams) -> list[CnnModel]:
    """Every partition goes on from ``starts`` over its findings and the ``fixed`` ones; the networks, averaged. Network k
    never sees fold k, the last one sees all. Sums are of whole numbers, so the order of tasks does not matter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sorted((r, k) for b in batches for k, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        if not own:
            return
        rows = [r for r, _ in own] + fixed[0]
        labels = np.concatenate([np.array([k > 0 for _, k in own], np.float32), fixed[1]])
        fold = np.concatenate([np.array([_fold(k, r) for r, k in own]), fixed[2]])
        weights = np.concatenate([np.array([weigh[k] for _, k in own]), np.ones(len(fixed[0]))])
        epochs = max(1, math.ceil(p.steps * BATCH / len(rows)))
        for k, start in enumerate(starts):
            use = np.flatnonzero(fold != k)
            m = fit([rows[i] for i in use.tolist()], labels[use], p, weights[use], start, 0.003, epochs)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.rint(packed(m) * 2.0 ** 32).astype(np.int64)], pa.list_(pa.int64()))],
                                             names=["net", "v"])

    every = dealt.select("label", "row").mapInArrow(run, "net int, v array<long>").select("net", F.posexplode("v").alias("at", "v"))
    out = [packed(m).astype(np.float64) for m in starts]
    for r in every.groupBy("net", "at").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n")).collect():
        out[r.net][r.at] = r.v / r.n / 2.0 ** 32
    return [unpacked(v, p) for v in out]


def _left_out_scores(dealt: DataFrame, nets: list[CnnModel]) -> list[tuple[int, float, int]]:
    """(label, score, findings): the scores of the networks that did not see them, rounded down to 1/256 between -64 and 64."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label, rows = b.column(0).to_numpy(), b.column(1).to_pylist()
            fold = np.array([_fold(k, r) for k, r in zip(label.tolist(), rows, strict=True)])
            for k in range(FOLDS):
                use = np.flatnonzero(fold == k)
                grid = np.clip(np.floor(_logits(nets[k], [rows[i] for i in use.tolist()]) * 256), -(1 << 14), 1 << 14).astype(np.int64)
                kinds, n = np.unique(np.stack([label[use].astype(np.int64), grid]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds[0], pa.int32()), pa.array(kinds[1], pa.int32()), pa.array(n, pa.int64())],
                                                 names=["label", "grid", "n"])

    counted = dealt.select("label", "row").mapInArrow(run, "label int, grid int, n long").groupBy("label", "grid").agg(F.sum("n").alias("n"))
    return sorted((r.label, r.grid / 256, r.n) for r in counted.collect())


def train(docs: DataFrame, p: CnnParams = CnnParams(), text_col: str = "text") -> CnnModel:
    """Fit on the shipped findings and all findings of the corpus, each distinct one once, with a threshold from formats left out.

    Candidates that neither a rule nor a harmless shape labels are left out: among them are the secrets to be found.
    Rule kinds, words and other harmless runs weigh apart, which keeps the rare ones in sight. Labels with at most
    ``p.sample`` findings go to every task as the shipped ones do; they make the start from which the tasks go on over the
    findings of the other labels. A corpus without findings, or an empty table, leaves the shipped ones: the network judges
    candidates at every size.
    """
    seen = labelled_findings(docs, text_col).distinct().checkpoint()
    held = {r.label: r.n for r in seen.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    many = {k: n for k, n in held.items() if n > p.sample}
    rows, y, fold = [], [], []
    for label, row in sorted((r.label, bytes(r.row)) for r in seen.where(~F.col("label").isin(*many)).collect()):
        rows.append(row)
        y.append(int(label > 0))
        fold.append(_fold(label, row))
    formats: dict[str, int] = {}
    for name, label, row in shipped_rows(p.formats):
        rows.append(row)
        y.append(label)
        fold.append(formats.setdefault(f"{label}{name}", len(formats)) % FOLDS)
    labels, fold = np.array(y, np.float32), np.array(fold)
    pick = lambda which: [r for r, w in zip(rows, which, strict=True) if w]
    nets = [fit(pick(fold != k), labels[fold != k], p) for k in range(FOLDS + 1)]
    shards = math.ceil(sum(many.values()) / p.shard)
    scored = []
    if shards:
        dealt = seen.where(F.col("label").isin(*many)).repartition(shards, "row")
        nets = _tuned(dealt, nets, (rows, labels, fold), {k: p.sample * shards / n for k, n in many.items()}, p)
        scored = _left_out_scores(dealt, nets)
    scores = np.zeros(len(rows))
    for k in range(FOLDS):
        scores[fold == k] = _logits(nets[k], pick(fold == k))
    weights = np.array([n * p.sample / many[k] for k, _, n in scored])
    return calibrated(nets[FOLDS], np.concatenate([scores, [s for _, s, _ in scored]]), np.concatenate([labels, [float(k > 0) for k, _, _ in scored]]),
                      p.recall, np.concatenate([np.ones(len(rows)), weights]))


def _findings(column: pa.Array, model: CnnModel) -> Iterator[tuple[int, bytes, list[tuple[int, int, int]]]]:
    """(row, text, [(start, kind, end)]) for rows with findings, offsets in bytes; candidates are scored in blocks."""
    block, rows, owners, waiting = 2048, [], [], []

    def flush():
        best: dict[int, float] = {}
        for o, q in zip(owners, probabilities(model, rows).tolist(), strict=True):
            best[o] = max(best.get(o, 0.0), q)
        for k, (d, text, found, cands) in enumerate(waiting):
            extra = [(i, 3, j) for c, (i, j) in enumerate(cands) if best[k << 32 | c] >= model.threshold]
            spans = sorted([x[:3] for x in found] + extra)
            if spans:
                yield d, text, spans
        rows.clear(), owners.clear(), waiting.clear()

    for d, text, found, others in _scan(*text_bytes(column)):
        cands = [x for x in others if _is_candidate(text, *x)]
        for c, (i, j) in enumerate(cands):
            got = list(windows(text, i, j))
            rows += got
            owners += [len(waiting) << 32 | c] * len(got)
        waiting.append((d, text, found, cands))
        if len(rows) >= block or len(waiting) >= block:
            yield from flush()
    yield from flush()


def _in_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if text.isascii():
        return spans
    lead = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [(int(lead[s]), k, int(lead[e])) for s, k, e in spans]


def scan_secrets(docs: DataFrame, model: CnnModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, spans array<struct<kind, start, end>> in code points (by start, then kind), counts a kind.

    Null texts are empty and have no findings; repeated rows each get a row; null ids stay null; whole texts of any
    length; other columns are ignored; an empty table gives an empty result. What a base finding leaves of a run is a
    candidate of its own; one longer than a window is cut into overlapping pieces and takes their highest score; a score on
    the threshold counts as a finding. Map-only.
    """
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans: list[list] = [[] for _ in range(b.num_rows)]
            counts = np.zeros((4, b.num_rows), np.int64)
            for d, text, found in _findings(b.column(1), model):
                for s, k, e in _in_code_points(text, found):
                    counts[k, d] += 1
                    spans[d].append({"kind": KINDS[k], "start": s, "end": e})
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, span), *(pa.array(c) for c in counts)],
                                             names=["doc_id", "spans", *(f"n_{k}" for k in KINDS)])

    pair = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return pair.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>, "
                                "n_assign long, n_access long, n_hex long, n_cnn long")


def span_digest(spans, kinds: tuple[str, ...] | None = None):
    """kind:start:end of the spans (of these kinds), comma-joined."""
    own = F.filter(spans, lambda x: x["kind"].isin(*kinds)) if kinds else spans
    return F.array_join(F.transform(own, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact_secrets(docs: DataFrame, model: CnnModel, text_col: str = "text", length_col: str | None = "n_chars",
                   mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every finding's text replaced by ``mask`` (overlapping ones by one) and its length column renewed.

    Rows without findings stay as they are, null texts too; same cases as ``scan_secrets``.
    """
    at, names = docs.columns.index(text_col), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new: dict[int, str] = {}
            for d, text, found in _findings(b.column(at), model):
                out, end = [], 0
                for s, _, e in found:
                    if s >= end:
                        out += [text[end:s], mask.encode()]
                    end = max(end, e)
                new[d] = (b"".join(out) + text[end:]).decode()
            if new:
                texts = b.column(at).to_pylist()
                for d, x in new.items():
                    texts[d] = x
                cols = list(b.columns)
                cols[at] = pa.array(texts, b.column(at).type)
                if length_col in names:
                    k = names.index(length_col)
                    sizes = b.column(k).to_pylist()
                    for d, x in new.items():
                        sizes[d] = len(x)
                    cols[k] = pa.array(sizes, b.column(k).type)
                b = pa.RecordBatch.from_arrays(cols, schema=b.schema)
            yield b

    return docs.mapInArrow(run, docs.schema)

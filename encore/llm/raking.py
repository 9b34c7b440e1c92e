"""Operator 9, mixing sources to target weights: iterative proportional fitting.

Tokens are summed per cell (source, language, topic); the cell weights are raked until their marginals are the
targets of all three dimensions; a document is kept with its cell's calibrated probability, decided by a hash.
Categories without a target form one class, ``other``, so the table of cells is bounded by the target lists,
not by the data: (sources + 1) * (languages + 1) * (topics + 1) rows reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "other"
DIMENSIONS = ("source", "lang", "topic")


@dataclass(frozen=True)
class MixTargets:
    """Target shares of tokens by category; ``other`` is the share of what is not named, in each dimension.

    Shares are scaled to sum to 1 over the categories that have tokens. budget: expected tokens kept, as a share of
    all; where a probability would pass 1 it is 1, and the other cells take up the rest of the budget.
    """

    source: dict[str, float]
    lang: dict[str, float]
    topic: dict[str, float]
    other: float = 0.01
    budget: float = 0.6
    seed: int = 9
    tolerance: float = 1e-10
    max_rounds: int = 2000


def _grouped(column: Column, named: dict[str, float]) -> Column:
    return F.when(column.isin(*named), column).otherwise(F.lit(OTHER))


def rake(tokens: np.ndarray, targets: list[np.ndarray], tolerance: float, max_rounds: int) -> np.ndarray:
    """Weights, in sum 1, proportional to ``tokens`` times one factor a dimension, with the target marginals.

    Targets of empty categories are dealt to the others. Where the empty cells make the targets contradict each other
    the last dimension's marginals hold.
    """
    w = tokens / tokens.sum()
    for d, t in enumerate(targets):
        axes = tuple(i for i in range(w.ndim) if i != d)
        targets[d] = np.where(w.sum(axes) > 0, t, 0.0)
        targets[d] = targets[d] / targets[d].sum() if targets[d].sum() else w.sum(axes)
    for _ in range(max_rounds):
        before = w
        for d, t in enumerate(targets):
            axes = tuple(i for i in range(w.ndim) if i != d)
            have = w.sum(axes)
            shape = [-1 if i == d else 1 for i in range(w.ndim)]
            w = w * np.divide(t, have, out=np.zeros_like(t), where=have > 0).reshape(shape)
        if np.abs(w - before).max() < tolerance:
            break
    return w


def probabilities(tokens: np.ndarray, weights: np.ndarray, budget: float) -> np.ndarray:
    """min(1, c * weight / tokens) of every cell, with c such that the expected tokens are budget * all."""
    factor = np.divide(weights, tokens, out=np.zeros_like(weights), where=tokens > 0)
    order = np.argsort(-factor.ravel())
    f, t = factor.ravel()[order], tokens.ravel()[order].astype(float)
    want = min(budget * t.sum(), t[f > 0].sum())
    full = np.concatenate(([0.0], np.cumsum(t)))  # tokens of the cells kept whole
    rest = np.concatenate((np.cumsum((f * t)[::-1])[::-1], [0.0]))
    for k in range(len(f)):
        if rest[k] <= 0:
            break
        c = (want - full[k]) / rest[k]
        if c * f[k] <= 1 + 1e-12:
            return np.minimum(1.0, np.maximum(c, 0.0) * factor)
    return np.where(factor > 0, 1.0, 0.0)


def mix(docs: DataFrame, targets: MixTargets, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang",
        topic_col: str = "topic", tokens_col: str = "n_tokens", salt_cols: tuple[str, ...] = ("text",)) -> DataFrame:
    """``docs`` with cell_source, cell_lang, cell_topic, probability and sampled (existing ones are replaced).

    ``sampled`` compares a hash of id, ``salt_cols`` and seed with the probability, so the sample does not change with
    the layout of the data, and repeated rows are kept or left together. A null category, or one without a target,
    is ``other``; null or negative token counts are 0; documents without tokens weigh nothing and get their cell's
    probability, 1 where the whole cell has no tokens. An empty table stays empty. One aggregation with partial sums:
    a source with a third of all rows is a handful of cells. Two passes, no shuffle of documents.
    """
    named = [targets.source, targets.lang, targets.topic]
    cells = [f"cell_{d}" for d in DIMENSIONS]
    docs = docs.drop(*cells, "probability", "sampled")
    keyed = docs.withColumns({c: _grouped(F.col(x), n) for c, x, n in zip(cells, (source_col, lang_col, topic_col), named, strict=True)})
    weight = F.greatest(F.coalesce(F.col(tokens_col).cast("long"), F.lit(0)), F.lit(0))
    sums = keyed.groupBy(*cells).agg(F.sum(weight).alias("tokens")).collect()  # bounded by the target lists
    names = [[*n, OTHER] if OTHER not in n else list(n) for n in named]
    at = [{x: i for i, x in enumerate(n)} for n in names]
    tokens = np.zeros([len(n) for n in names])
    for r in sums:
        tokens[tuple(a[r[c]] for a, c in zip(at, cells, strict=True))] = r.tokens or 0
    if tokens.sum():
        shares = [np.array([n.get(x, targets.other) for x in own]) for n, own in zip(named, names, strict=True)]
        p = np.where(tokens > 0, probabilities(tokens, rake(tokens, shares, targets.tolerance, targets.max_rounds), targets.budget), 1.0)
    else:
        p = np.ones_like(tokens)
    # one literal a cell that has tokens: nested maps of the bounded table
    pairs = [x for i in zip(*np.nonzero(tokens), strict=True)
             for x in (F.lit("\x1f".join(n[k] for n, k in zip(names, i, strict=True))), F.lit(float(p[i])))]
    table = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
    chance = F.coalesce(F.try_element_at(table, F.concat_ws("\x1f", *cells)), F.lit(1.0))
    draw = F.pmod(F.xxhash64(F.col(id_col), *(F.col(c) for c in salt_cols), F.lit(targets.seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return keyed.withColumn("probability", chance).withColumn("sampled", draw < F.col("probability"))


def with_topics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` (words) and ``topic``, the form of the text: empty, table, markup, list or prose.

    table: a bar in every ten words; markup: one character in twenty is a symbol; list: a line break in every eight
    words. A null text is empty. Existing columns of these names are replaced.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    count = lambda what: F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))
    marks = F.length(text) - F.length(F.translate(text, "#*$%&<>", ""))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    topic = F.when(F.col("n_tokens") == 0, "empty").when(10 * count("|") >= F.col("n_tokens"), "table") \
        .when(20 * marks >= F.length(text), "markup").when(8 * count("\n") >= F.col("n_tokens"), "list").otherwise("prose")
    return docs.withColumn("n_tokens", words).withColumn("topic", topic)

"""Operator 3, token counts: edit-aware counting with a segment tree of pre-tokens per document.

A document's pre-tokens (the tokenizer's regular expression) lie in leaves of a segment tree; every node sums
the characters and tokens below it. An edit (position, characters removed, text put in) goes down the tree to
the pre-token in front of it, splits the text anew from a few pre-tokens before the edit until a new border
meets an old one behind it, encodes only these pieces, and renews the sums on the paths above the touched
leaves. The expression never looks behind a pre-token's start, so from the first common border on nothing
changes; it looks ahead at most over one run of spaces, which ``BEFORE`` pre-tokens cover.

A piece's tokens depend on the piece alone (byte-pair merges never cross pre-tokens), so counts add up.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens of a new leaf, and pre-tokens split anew in front of an edit.
LEAF, BEFORE = 64, 3
#: Pieces whose counts a worker remembers; beyond, the memory starts anew (results do not change).
REMEMBERED = 500_000
TREE = "struct<leaf:binary,chars:binary,tokens:binary>"


@dataclass(frozen=True)
class Ranks:
    """A byte-level vocabulary: ``bytes rank`` lines in base 64, and the pattern of its pre-tokens."""

    lines: bytes
    pattern: str


def read_ranks(path: str, pattern: str) -> Ranks:
    """Read on the driver; bounded by the vocabulary, sent to tasks with the function."""
    with open(path, "rb") as f:
        return Ranks(f.read(), pattern)


class Counter:
    """Counts tokens of pieces in one worker."""

    def __init__(self, r: Ranks):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, r.lines.splitlines())}
        self.encoding = tiktoken.Encoding("counting", pat_str=r.pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(r.pattern)
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        self.size[list(ranks.values())] = list(map(len, ranks))
        self.known: dict[str, int] = {}

    def text_counts(self, text: str) -> tuple[list[int], list[int]]:
        """(characters, tokens) of every pre-token of a text, encoded in one call: borders of tokens meet borders of pieces."""
        lens = np.fromiter(map(len, self.pattern.findall(text)), np.int64)
        if not len(lens):
            return [], []
        raw = np.frombuffer(text.encode(), np.uint8)
        at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # byte of every character
        ends = np.cumsum(self.size[self.encoding.encode_to_numpy(text, disallowed_special=())])
        upto = np.searchsorted(ends, at[np.cumsum(lens)]) + 1
        return lens.tolist(), np.diff(upto, prepend=0).tolist()

    def counts(self, pieces: list[str]) -> list[int]:
        known, encode = self.known, self.encoding.encode_ordinary
        if len(known) > REMEMBERED:
            known.clear()
        for p in set(pieces):
            if p not in known:
                known[p] = len(encode(p))
        return list(map(known.__getitem__, pieces))


class Tree:
    """The pre-tokens of one document: leaves (lists of (characters, tokens)) under an implicit binary tree."""

    def __init__(self, leaves: list[tuple[list[int], list[int]]]):
        self.leaves = leaves or [([], [])]
        self.base = 1 << max(len(self.leaves) - 1, 0).bit_length()
        self.chars = np.zeros(2 * self.base, np.int64)
        self.tokens = np.zeros(2 * self.base, np.int64)
        for sums, k in ((self.chars, 0), (self.tokens, 1)):
            sums[self.base:self.base + len(self.leaves)] = [sum(x[k]) for x in self.leaves]
            at = self.base
            while at > 1:
                sums[at // 2:at] = sums[at:2 * at].reshape(-1, 2).sum(1)
                at //= 2

    @classmethod
    def of(cls, text: str, counter: Counter) -> Tree:
        lens, counts = counter.text_counts(text)
        return cls([(lens[i:i + LEAF], counts[i:i + LEAF]) for i in range(0, len(lens), LEAF)])

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def _leaf_at(self, pos: int) -> tuple[int, int]:
        """(leaf, its start) that holds character ``pos``; the last leaf for the end of the text."""
        node, start = 1, 0
        while node < self.base:
            node *= 2
            if pos >= start + self.chars[node] and self.chars[node + 1]:
                start += int(self.chars[node])
                node += 1
        return node - self.base, start

    def _renew(self, leaf: int) -> None:
        node = self.base + leaf
        self.chars[node], self.tokens[node] = sum(self.leaves[leaf][0]), sum(self.leaves[leaf][1])
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, text: str, pos: int, removed: int, put: str, counter: Counter) -> tuple[str, int]:
        """Apply one edit (places beyond the text are moved to its end); the new text, and pieces encoded anew."""
        pos = min(max(pos, 0), len(text))
        stop = min(pos + max(removed, 0), len(text))
        new = text[:pos] + put + text[stop:]
        if new == text:
            return text, 0
        shift = len(new) - len(text)
        # the pre-token holding the character before the edit, then BEFORE more
        leaf, start = self._leaf_at(max(pos - 1, 0))
        i, at = 0, start
        lens = self.leaves[leaf][0]
        while i < len(lens) and at + lens[i] < pos:
            at += lens[i]
            i += 1
        back = BEFORE
        while back and (i or leaf):
            if i == 0:
                leaf -= 1
                i = len(self.leaves[leaf][0])
                continue
            i -= 1
            at -= self.leaves[leaf][0][i]
            back -= 1
        # split anew until a border behind the edit is an old border too
        pieces: list[str] = []
        old_leaf, old_i, old_at, end = leaf, i, at, at
        for m in counter.pattern.finditer(new, at):
            end = m.end()
            pieces.append(m[0])
            if end >= pos + len(put):
                while old_at + shift < end or old_at < stop:
                    if old_i == len(self.leaves[old_leaf][0]):
                        if old_leaf + 1 == len(self.leaves):
                            break
                        old_leaf, old_i = old_leaf + 1, 0
                        continue
                    old_at += self.leaves[old_leaf][0][old_i]
                    old_i += 1
                if old_at + shift == end and old_at >= stop:
                    break
        else:  # the rest of the text changed (or is gone)
            old_leaf, old_i = len(self.leaves) - 1, len(self.leaves[-1][0])
        fresh = (list(map(len, pieces)), counter.counts(pieces))
        tail = [x[old_i:] for x in self.leaves[old_leaf]]
        for k in range(leaf + 1, old_leaf + 1):
            self.leaves[k] = ([], [])
        head = [x[:i] for x in self.leaves[leaf]]
        if old_leaf == leaf:
            self.leaves[leaf] = (head[0] + fresh[0] + tail[0], head[1] + fresh[1] + tail[1])
        else:
            self.leaves[leaf] = (head[0] + fresh[0], head[1] + fresh[1])
            self.leaves[old_leaf] = (tail[0], tail[1])
        if len(self.leaves[leaf][0]) > 8 * LEAF:  # a long insertion: deal the leaves out anew
            flat = [[v for x in self.leaves for v in x[k]] for k in (0, 1)]
            self.__init__([(flat[0][j:j + LEAF], flat[1][j:j + LEAF]) for j in range(0, len(flat[0]), LEAF)])
        else:
            for k in range(leaf, old_leaf + 1):
                self._renew(k)
        return new, len(pieces)

    def pack(self) -> dict[str, bytes]:
        kinds = ((np.cumsum([0, *(len(x[0]) for x in self.leaves)]),), [x[0] for x in self.leaves], [x[1] for x in self.leaves])
        return {k: (np.concatenate([np.asarray(y, np.int64) for y in v]) if len(v) else np.zeros(0)).astype(np.int32).tobytes()
                for k, v in zip(("leaf", "chars", "tokens"), kinds, strict=True)}

    @classmethod
    def unpack(cls, x: dict[str, bytes]) -> Tree:
        at, lens, counts = (np.frombuffer(x[k], np.int32).tolist() for k in ("leaf", "chars", "tokens"))
        return cls([(lens[a:b], counts[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)])


def build_trees(docs: DataFrame, ranks: Ranks, text_col: str = "text") -> DataFrame:
    """``docs`` with ``tree`` and ``n_tokens`` (existing columns of these names are replaced).

    A null text has a null tree and count, an empty one an empty tree and 0; whole texts; repeated rows and other
    columns pass unchanged; an empty table stays empty. Map-only.
    """
    docs = docs.drop("tree", "n_tokens")
    at = docs.columns.index(text_col)
    out = docs.withColumn("tree", F.lit(None).cast(TREE)).withColumn("n_tokens", F.lit(None).cast("long")).schema
    kind = pa.struct([(k, pa.binary()) for k in ("leaf", "chars", "tokens")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks)
        for whole in batches:
            for b in _parts(whole, at):
                trees = [None if t is None else Tree.of(t, counter) for t in b.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array([t and t.pack() for t in trees], kind), pa.array([None if t is None else t.total for t in trees], pa.int64())],
                    names=[*b.schema.names, "tree", "n_tokens"])

    return docs.mapInArrow(run, out)


def _parts(b: pa.RecordBatch, at: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    step = max(1, b.num_rows * most // max(b.column(at).nbytes, 1))
    for lo in range(0, b.num_rows, step):
        yield b.slice(lo, step)


EDITS = "array<struct<pos:long,removed:long,put:string>>"


def count_edited(docs: DataFrame, ranks: Ranks, edits_col: str = "edits", text_col: str = "text", id_col: str = "doc_id",
                 tree_col: str | None = None, keep_text: bool = False) -> DataFrame:
    """Apply every row's edits (in their order, each to the text the last one left) and count tokens before and after.

    Returns doc_id, n_tokens, n_tokens_edited, n_edits, n_pieces (pre-tokens after the edits), n_encoded (pre-tokens
    encoded for the edits) and, with ``keep_text``, the new text and tree. ``tree_col`` names stored trees; without
    it they are built in the same pass. Null texts count as null (their edits are skipped), null or empty edit lists
    change nothing, a null position is 0, a null count removes nothing, a null insertion puts nothing; positions
    beyond the text mean its end. Repeated rows each get a row; other columns are ignored; an empty table gives an
    empty result. One document's edits follow each other, so they run in one task; documents are independent. Map-only.
    """
    kind = pa.struct([(k, pa.binary()) for k in ("leaf", "chars", "tokens")])
    cols = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(edits_col).cast(EDITS).alias("edits")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks)
        for whole in batches:
            for b in _parts(whole, 1):
                rows, kept = [], []
                stored = b.column(3).to_pylist() if tree_col else [None] * b.num_rows
                for text, edits, packed in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), stored, strict=True):
                    if text is None:
                        rows.append((None, None, len(edits or []), None, None))
                        kept.append((None, None))
                        continue
                    tree = Tree.unpack(packed) if packed else Tree.of(text, counter)
                    first, again = tree.total, 0
                    for e in edits or []:
                        if e is not None:
                            text, n = tree.edit(text, e["pos"] or 0, e["removed"] or 0, e["put"] or "", counter)
                            again += n
                    rows.append((first, tree.total, len(edits or []), sum(len(x[0]) for x in tree.leaves), again))
                    kept.append((text, tree.pack() if keep_text else None))
                out = [b.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(5))]
                names = ["doc_id", "n_tokens", "n_tokens_edited", "n_edits", "n_pieces", "n_encoded"]
                if keep_text:
                    out += [pa.array([k[0] for k in kept], pa.string()), pa.array([k[1] for k in kept], kind)]
                    names += ["text", "tree"]
                yield pa.RecordBatch.from_arrays(out, names=names)

    if tree_col:
        cols.append(F.col(tree_col).cast(TREE).alias("tree"))
    extra = f", text string, tree {TREE}" if keep_text else ""
    return docs.select(*cols).mapInArrow(run, "doc_id long, n_tokens long, n_tokens_edited long, n_edits long, n_pieces long, "
                                              f"n_encoded long{extra}")


def drawn_edits(id_col: str = "doc_id", text_col: str = "text", n: int = 3):
    """``n`` edits drawn from a row's own id and text by hashes: a replacement, an insertion, a removal, and so on."""
    size = F.coalesce(F.length(text_col), F.lit(0)).cast("long")
    at = lambda k: F.pmod(F.xxhash64(F.col(id_col), F.lit(k)), size + 1)
    edits = []
    for k in range(n):
        put = F.coalesce(F.substring(F.col(text_col), (at(100 + k) + 1).cast("int"), F.lit(9 + 4 * k)), F.lit(""))
        edits.append(F.struct(at(k).alias("pos"), F.lit(0 if k % 3 == 1 else 12).cast("long").alias("removed"),
                              (F.lit("") if k % 3 == 2 else put).alias("put")))
    return F.array(*edits)

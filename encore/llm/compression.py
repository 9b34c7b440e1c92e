"""Operator 2, quality rules: compression bands.

zstandard ratios (bytes / compressed bytes) of the whole document and of its fixed chunks must lie
in a band that depends on the document's length: above it the text is repetitive, below it
incompressible (encoded blobs, random characters). Short texts compress badly by nature, so the
bands rise with length. The limits lie just outside the ratios of 10000 documents of prose in four
languages: there a text whose last quarter is base64 falls below its band, one of which 30 % repeats above it.

What is compressed are characters, not UTF-8: a text that is not ASCII is first written with one byte a character (its
distinct characters numbered in order), so a script of two bytes a letter meets the same bands as one of one byte.
Texts of more than 256 distinct characters (logographic scripts) take two bytes a character, carry more information in
each, and have bands of their own (``wide_lowest``, ``wide_highest``, as shares of the others).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.textops import IS_SPACE, slices, text_bytes, window_hashes, word_hashes, words


@dataclass(frozen=True)
class Band:
    """Limits for documents of at least ``min_bytes`` bytes (up to the next band)."""

    min_bytes: int
    lowest: float
    highest: float


@dataclass(frozen=True)
class CompressionRules:
    """Parameters; lengths are bytes of the text as compressed. ``chunk_share``: a document goes when more than this share of its chunks is out of band.

    Chunks lie end to end; where they leave a rest, one more ends at the text's end. Texts shorter than ``chunk_bytes``
    are measured in ``short_bytes`` chunks with limits of their own, still shorter ones only as a whole.
    """

    bands: tuple[Band, ...] = (
        Band(0, 0.0, 2.2), Band(256, 1.33, 1.96), Band(512, 1.44, 2.05), Band(1024, 1.65, 2.25), Band(2048, 1.8, 2.35),
        Band(4096, 1.95, 2.45), Band(8192, 2.05, 2.5), Band(16384, 2.1, 2.6), Band(65536, 2.1, 2.75))
    chunk_bytes: int = 4096
    chunk_lowest: float = 1.85
    chunk_highest: float = 2.7
    short_bytes: int = 1024
    short_lowest: float = 1.52
    short_highest: float = 2.4
    chunk_share: float = 0.25
    wide_lowest: float = 0.55
    wide_highest: float = 0.9
    level: int = 3
    min_words: int = 50
    max_repeat_percent: int = 50


SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
           "kept boolean, n_bytes long, ratio double, chunks long, chunks_high long, chunks_low long, verdict string")
COLUMN_TYPES = dict(x.split() for x in COLUMNS.split(", "))
ARROW = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}
VERDICTS = ("kept", "base", "repetitive", "incompressible", "repetitive_chunks", "incompressible_chunks")


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[at[1:]] - total[at[:-1]]


def _repeat_words(windows: np.ndarray, n_words: int) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if n_words < 4:
        return 0
    w = windows[:n_words - 2]
    order = np.argsort(w)
    s = w[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(w), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n_words, bool)
    for k in range(3):
        covered[k:k + len(w)] |= twice
    return int(covered.sum())


def _dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def script_free(text: bytes) -> tuple[bytes, bool]:
    """(the text with one byte a character, or two where it has more than 256 distinct ones; whether it has)."""
    if text.isascii():
        return text, False
    codes = np.frombuffer(text.decode(errors="replace").encode("utf-32-le"), np.uint32)
    used, number = np.unique(codes, return_inverse=True)
    if len(used) <= 256:
        return number.astype(np.uint8).tobytes(), False
    return (codes.astype(np.uint16) if used[-1] < 1 << 16 else number.astype(np.uint32 if len(used) >= 1 << 16 else np.uint16)).tobytes(), True


def _measure(column: pa.Array, rules: CompressionRules) -> dict[str, list]:
    data, at = text_bytes(column)
    pack = zstandard.ZstdCompressor(level=rules.level)
    out: dict[str, list] = {k: [] for k in COLUMN_TYPES}
    floors = np.array([b.min_bytes for b in rules.bands])
    for lo, hi in slices(at):
        base, own = int(at[lo]), at[lo:hi + 1] - at[lo]
        part = data[base:int(at[hi])]
        starts, ends, first = words(part, own)
        three = window_hashes(word_hashes(part, starts, ends), 3)
        n_words = np.diff(first)
        chars = _sums(((part & 0xC0) != 0x80) & ~IS_SPACE[part], own)
        symbols = _sums(SYMBOL[part], own)
        for d in range(hi - lo):
            text, nw = part[own[d]:own[d + 1]].tobytes(), int(n_words[d])
            n_bytes, dup = len(text), _dup_lines(text)
            text, wide = script_free(text)
            n, low_by, high_by = len(text), rules.wide_lowest if wide else 1.0, rules.wide_highest if wide else 1.0
            repeat = _repeat_words(three[first[d]:], nw)
            failed = nw < rules.min_words or 100 * repeat > rules.max_repeat_percent * nw
            ratio = n / len(pack.compress(text)) if n else 0.0
            size, lowest, highest = (rules.chunk_bytes, rules.chunk_lowest, rules.chunk_highest) if n >= rules.chunk_bytes else \
                (rules.short_bytes, rules.short_lowest, rules.short_highest)
            full = [size / len(pack.compress(text[j:j + size])) for j in range(0, n - size + 1, size)]
            tail = [size / len(pack.compress(text[n - size:]))] if n > size and n % size else []
            # a good tail excuses no share that the full chunks pass by themselves
            out_of = lambda far: any(sum(map(far, c)) > rules.chunk_share * len(c) for c in (full, full + tail))  # noqa: B023, E731
            lowest, highest = lowest * low_by, highest * high_by
            too_high, too_low = out_of(lambda r: r > highest), out_of(lambda r: r < lowest)  # noqa: B023
            full += tail
            high, low = sum(r > highest for r in full), sum(r < lowest for r in full)
            band = rules.bands[int(np.searchsorted(floors, n, "right")) - 1]
            verdict = VERDICTS[1 if failed else 2 if ratio > band.highest * high_by else 3 if ratio < band.lowest * low_by
                               else 4 if too_high else 5 if too_low else 0]
            for k, v in zip(out, (nw, int(chars[d]), int(symbols[d]), dup, repeat, failed, verdict == "kept",
                                  n_bytes, ratio, len(full), high, low, verdict), strict=True):
                out[k].append(v)
    return out


def compression_report(docs: DataFrame, rules: CompressionRules = CompressionRules(), id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, the base counts, the ratios, ``kept`` and the ``verdict`` that decided.

    A null text counts as empty: no words, ``base_failed``, not kept. A null id stays null, repeated rows each
    get a row, whole texts of any length are measured (compressed as a whole and chunk by chunk up to the last
    byte; below ``short_bytes`` only as a whole). Other columns are ignored, an empty table gives an empty result. A ratio on the limit is inside the band. Map-only: no shuffle, one pass.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = _measure(b.column(1), rules)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, ARROW[COLUMN_TYPES[k]]) for k, v in got.items())],
                                             names=["doc_id", *got])

    pair = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return pair.mapInArrow(run, f"doc_id long, {COLUMNS}")


def _keep_flags(column: pa.Array, rules: CompressionRules) -> pa.Array:
    return pa.array(_measure(column, rules)["kept"], pa.bool_())


def keep_compressible(docs: DataFrame, rules: CompressionRules = CompressionRules(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns, unchanged) that the rules keep; same cases as ``compression_report``."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(_keep_flags(b.column(at), rules))

    return docs.mapInArrow(run, docs.schema)

"""Operator 8, SentencePiece encoding and decoding: batched numpy Viterbi.

A text is encoded to the sequence of vocabulary pieces with the highest sum of piece scores. The words of a
batch that were not seen before are grouped by length; all words of a length advance together: for every
substring length one vectorised hash probe of the sorted piece keys, for every end position one vectorised
maximum over the starts, whose index is the back pointer. Ties go to the longer last piece. A character that is
no piece costs ``UNKNOWN`` below the worst piece and is written as its UTF-8 bytes (byte pieces).

The model file holds pieces and scores; the best-scoring segmentation under them is what the library's unigram
mode computes (the tests compare with it). A model of the merge kind gets the same treatment: its pieces and
scores are taken as they are, so ids can differ from those of the merge order, decoding is the same.

A word longer than ``LONG`` characters goes alone, in stretches of positions: the probes of a stretch are vectorised over
its positions, a ring of the last sums (one for each piece length) moves on, and one byte a character is kept as back pointer.

Text is cut before every space that follows another character, and around characters that occur in no
other piece; no piece crosses such a place (checked when the model is read), so words can be encoded apart.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.textops import U64, fmix

SPACE = "▁"
UNKNOWN = 10.0
#: Words kept with their ids in a worker; beyond, the memory starts anew (results do not change).
REMEMBERED = 100_000
#: Characters of the words kept so; a word of many megabytes is not kept beyond its batch.
REMEMBERED_CHARS = 1 << 22
#: Words of one length that advance together.
BLOCK = 8192
#: Longer words advance alone, STRETCH positions at a time; memory is that of a stretch and some bytes a character.
LONG, STRETCH = 2048, 1 << 15
_STEP = U64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Vocabulary:
    """What encoding and decoding need of a model: bounded by the model's size, sent to tasks with the function."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    plain: tuple[int, ...]
    bytes_at: tuple[int, ...]
    prefix: bool


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces of a SentencePiece model file, read on the driver."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    if model.normalizer_spec.name != "identity" or model.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("only models without text normalisation give exact round trips")
    sp = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    n = sp.get_piece_size()
    pieces = tuple(sp.id_to_piece(i) for i in range(n))
    plain = tuple(i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)))
    at = {p: i for i, p in enumerate(pieces) if sp.is_byte(i)}
    if len(at) != 256:
        raise ValueError("the model has no byte pieces")
    if any(SPACE in pieces[i].lstrip(SPACE) for i in plain):
        raise ValueError("a piece crosses a word border")
    return Vocabulary(pieces, tuple(sp.get_score(i) for i in range(n)), plain, tuple(at[f"<0x{b:02X}>"] for b in range(256)),
                      model.normalizer_spec.add_dummy_prefix)


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, v: Vocabulary):
        self.v, plain = v, v.plain
        keys = self._keys([v.pieces[i] for i in plain])
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(plain, np.int64)[order]
        if len(self.keys) and (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have the same hash")
        self.scores = np.array(v.scores)[self.ids]
        self.unknown = min(v.scores[i] for i in plain) - UNKNOWN
        self.longest = max(len(v.pieces[i]) for i in plain)
        self.seen_bits = np.zeros(1 << 20, bool)
        self.seen_bits[(self.keys & U64((1 << 20) - 1)).astype(np.int64)] = True
        inner = {c for i in plain if len(v.pieces[i]) > 1 for c in v.pieces[i]}
        apart = re.escape("".join(c for c in "\n\t\r\x0b\x0c" if c not in inner))
        self.cut = re.compile(f" *[^ {apart}]+| +" + (f"|[{apart}]" if apart else ""))
        self.kind = np.uint16 if len(v.pieces) <= 1 << 16 else np.uint32
        self.known: dict[str, bytes] = {}
        self.held = 0
        self.table = [b"" if i in (0, 1, 2) else p.replace(SPACE, " ").encode() for i, p in enumerate(v.pieces)]
        for b, i in enumerate(v.bytes_at):
            self.table[i] = bytes([b])

    @staticmethod
    def _codes(words: list[str]) -> np.ndarray:
        """Code points of words of one length, a row each."""
        return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)

    @classmethod
    def _keys(cls, pieces: list[str]) -> np.ndarray:
        out = np.zeros(len(pieces), U64)
        by: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by.setdefault(len(p), []).append(i)
        for length, at in by.items():
            h = cls._rolling(cls._codes([pieces[i] for i in at]))
            out[at] = cls._between(h, length)[:, 0]
        return out

    @staticmethod
    def _rolling(codes: np.ndarray) -> np.ndarray:
        h = np.zeros((len(codes), codes.shape[1] + 1), U64)
        for j in range(codes.shape[1]):
            h[:, j + 1] = h[:, j] * _STEP + codes[:, j] + U64(1)
        return h

    @staticmethod
    def _between(h: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the substrings of ``length`` at every start, a row each word."""
        power = U64(pow(int(_STEP), length, 1 << 64))
        return fmix(h[:, length:] - h[:, :h.shape[1] - length] * power + U64(length))

    def _best(self, codes: np.ndarray) -> list[bytes]:
        """Ids of words of one length, by Viterbi over all rows together."""
        n, length = codes.shape
        h = self._rolling(codes)
        most = min(length, self.longest)
        gain = np.full((most, n, length), -np.inf)  # by length - 1, word, start
        piece = np.full((most, n, length), -1, np.int64)
        for k in range(1, most + 1):
            sub = self._between(h, k)
            maybe = np.flatnonzero(self.seen_bits[(sub & U64((1 << 20) - 1)).astype(np.int64)])
            probe = sub.ravel()[maybe]
            at = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
            hit = self.keys[at] == probe
            row, col = np.divmod(maybe[hit], length - k + 1)
            gain[k - 1, row, col] = self.scores[at[hit]]
            piece[k - 1, row, col] = self.ids[at[hit]]
        gain[0][piece[0] < 0] = self.unknown
        total = np.zeros((n, length + 1))
        back = np.zeros((n, length + 1), np.int64)
        for e in range(1, length + 1):
            ks = range(min(e, most), 0, -1)  # the longest first: argmax keeps it in a tie
            options = np.stack([total[:, e - k] + gain[k - 1, :, e - k] for k in ks], 1)
            pick = options.argmax(1)
            back[:, e] = min(e, most) - pick
            total[:, e] = options[np.arange(n), pick]
        end, rows, steps = np.full(n, length), np.arange(n), []
        while (end > 0).any():
            k = back[rows, end]
            start = end - k
            got = np.where(end > 0, piece[np.maximum(k, 1) - 1, rows, np.maximum(start, 0)], -2)
            steps.append((got, start))
            end = np.where(end > 0, start, 0)
        ids = np.stack([g for g, _ in steps[::-1]], 1)
        at = np.stack([s for _, s in steps[::-1]], 1)
        plain = (ids != -1).all(1)
        live = ids >= 0
        flat, counts = ids[live].astype(self.kind).tobytes(), live.sum(1)
        size = np.dtype(self.kind).itemsize
        ends = np.cumsum(counts) * size
        out = [flat[e - c * size:e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
        for i in np.flatnonzero(~plain):
            own: list[int] = []
            for g, s in zip(ids[i].tolist(), at[i].tolist(), strict=True):
                if g == -1:
                    own += [self.v.bytes_at[b] for b in chr(codes[i, s]).encode("utf-8", "surrogatepass")]
                elif g >= 0:
                    own.append(g)
            out[i] = np.array(own, self.kind).tobytes()
        return out

    def _probe(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, starts, places among the keys) of the pieces of each length in one row of characters."""
        sub = np.zeros(len(codes) + 1, U64)
        for k in range(1, min(len(codes), self.longest) + 1):
            sub = sub[:-1] * _STEP + codes[k - 1:] + U64(1)
            key = fmix(sub + U64(k))
            maybe = np.flatnonzero(self.seen_bits[(key & U64((1 << 20) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.keys, key[maybe]), len(self.keys) - 1)
            hit = self.keys[at] == key[maybe]
            yield k, maybe[hit], at[hit]

    def _best_long(self, word: str) -> bytes:
        """Ids of one long word: the same recurrence and ties as ``_best``, a stretch of end positions at a time."""
        codes, most = self._codes([word])[0], self.longest
        n = len(codes)
        back = np.zeros(n + 1, np.uint8)
        ring = np.full(most, -np.inf)  # best sums at the last ``most`` ends, oldest first
        ring[-1] = 0.0
        for lo in range(0, n, STRETCH):
            hi, first = min(lo + STRETCH, n), max(0, lo - most + 1)
            gain = np.full((hi - lo, most), -np.inf)  # by end, longest piece first: argmax keeps it in a tie
            gain[:, -1] = self.unknown
            for k, start, at in self._probe(codes[first:hi]):
                end = start + first + k - 1 - lo
                inside = end >= 0
                gain[end[inside], most - k] = self.scores[at[inside]]
            total = np.concatenate([ring, np.zeros(hi - lo)])
            pick = np.zeros(hi - lo, np.uint8)
            for e in range(hi - lo):
                option = total[e:e + most] + gain[e]
                j = option.argmax()
                total[e + most], pick[e] = option[j], most - j
            back[lo + 1:hi + 1], ring = pick, total[-most:]
        step, e, cuts = back.tobytes(), n, []
        while e:
            cuts.append(e)
            e -= step[e]
        ends = np.array(cuts[::-1], np.int64)
        return self._ids_between(codes, np.concatenate([[0], ends[:-1]]), ends)

    def _ids_between(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
        """Ids of the pieces that a word was cut into; characters that are no piece as their bytes."""
        out = []
        for lo in range(0, len(ends), STRETCH):
            s, e = starts[lo:lo + STRETCH], ends[lo:lo + STRETCH]
            ids = np.full(len(s), -1, np.int64)
            for k in range(1, self.longest + 1):
                own = np.flatnonzero(e - s == k)
                if len(own):
                    key = self._between(self._rolling(codes[s[own, None] + np.arange(k)]), k)[:, 0]
                    at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                    ids[own] = np.where(self.keys[at] == key, self.ids[at], -1)
            if (ids >= 0).all():
                out.append(ids.astype(self.kind).tobytes())
            else:
                parts = [[i] if i >= 0 else [self.v.bytes_at[b] for b in chr(codes[a]).encode("utf-8", "surrogatepass")]
                         for i, a in zip(ids.tolist(), s.tolist(), strict=True)]
                out.append(np.array([i for p in parts for i in p], self.kind).tobytes())
        return b"".join(out)

    def learn(self, words: set[str]) -> None:
        by: dict[int, list[str]] = {}
        for w in words:
            self.held += len(w)
            if len(w) > LONG:
                self.known[w] = self._best_long(w.replace(" ", SPACE))
            else:
                by.setdefault(len(w), []).append(w)
        for length, own in by.items():
            step = max(1, min(BLOCK, (1 << 21) // (length * min(length, self.longest))))
            for lo in range(0, len(own), step):
                part = own[lo:lo + step]
                self.known.update(zip(part, self._best(self._codes([w.replace(" ", SPACE) for w in part])), strict=True))

    def encode_batch(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of every text; a null or empty text has none."""
        lo, n = 0, len(texts)
        while lo < n:
            hi, chars = lo, 0
            while hi < n and (hi == lo or chars < 1 << 19):
                chars += len(texts[hi] or "")
                hi += 1
            cut = [self.cut.findall((" " if self.v.prefix else "") + t) if t else [] for t in texts[lo:hi]]
            if len(self.known) > REMEMBERED or self.held > REMEMBERED_CHARS:
                self.known.clear()
                self.held = 0
            known = self.known
            self.learn({w for w in set().union(*cut) if w not in known})
            get = known.__getitem__
            for c in cut:
                yield np.frombuffer(b"".join(map(get, c)), self.kind)
            lo = hi

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the space that encoding puts in front."""
        raw = b"".join(map(self.table.__getitem__, ids.tolist()))
        return raw[1 if self.v.prefix and raw[:1] == b" " else 0:].decode("utf-8", "replace")


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with a column ``out_col`` array<int> of piece ids (an existing column of that name is replaced).

    A null text gives null ids, an empty text an empty array; ties go to the longer last piece; whole texts of any
    length, also of one word (memory: a batch of texts, the tables of one block of words, about 20 bytes a character of a long word); repeated rows and other columns pass
    unchanged; an empty table stays empty. Map-only.
    """
    docs = docs.drop(out_col) if out_col in docs.columns else docs
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary)
        for b in batches:
            for part in _parts(b, at):
                texts = part.column(at).to_pylist()
                ids = [None if t is None else x for t, x in zip(texts, codec.encode_batch(texts), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*part.schema.names, out_col])

    return docs.mapInArrow(run, docs.withColumn(out_col, F.lit(None).cast("array<int>")).schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; null ids give null. ``encode`` then ``decode`` gives the text back,
    except that the character U+2581 comes back as a space."""
    encoded = encoded.drop(out_col) if out_col in encoded.columns else encoded
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary)
        for b in batches:
            texts = [None if not x.is_valid else codec.decode(x.values.to_numpy(zero_copy_only=False)) for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, out_col])

    return encoded.mapInArrow(run, encoded.withColumn(out_col, F.lit(None).cast("string")).schema)


def _parts(b: pa.RecordBatch, at: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a few MB of text each: ids take several times the bytes of the text."""
    size = b.column(at).nbytes
    step = max(1, b.num_rows * most // max(size, 1))
    for lo in range(0, b.num_rows, step):
        yield b.slice(lo, step)


def token_report(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_crc32 (of the ids as little-endian 32-bit numbers) and whether decoding gives
    the text back. A null text has null results; cases else as ``encode``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary)
        for b in batches:
            for part in _parts(b, 1):
                texts, out = part.column(1).to_pylist(), []
                for t, ids in zip(texts, codec.encode_batch(texts), strict=True):
                    out.append((None, None, None) if t is None else (len(ids), zlib.crc32(ids.astype("<u4").tobytes()), codec.decode(ids) == t))
                cols = [pa.array([x[i] for x in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], names=["doc_id", "n_tokens", "ids_crc32", "round_trip"])

    pair = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return pair.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")


def model_path(spark: SparkSession, default: str = "/opt/tokenizers/piece_bpe_32k.model") -> str:
    """The model file: the session's ``encore.llm.piece_model``, else the public one of this machine."""
    return spark.conf.get("encore.llm.piece_model", default)

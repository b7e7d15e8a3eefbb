"""SentencePiece encoding and decoding by a shared-prefix Viterbi pass.

The text is marked as the model asks (spaces become the mark, one is put in front) and cut before each run of marks; no piece
crosses such a place.  Distinct marked words are sorted, which is the depth-first order of their trie: from one word to
the next the pass steps back to the common prefix and goes on from there, so the forward values of a shared prefix are
computed once.

Forward value of a prefix, by the kind of model:

* unigram: the best sum of piece scores and the start of its last piece (Viterbi);
* BPE: the start of the last piece of the prefix's own encoding.  Merges decide, not sums, but the same recursion holds: a row
  of pieces is the encoding exactly if every two neighbours are the encoding of what they spell, so a prefix is extended by the
  one piece that agrees with the last piece before it.

Characters no piece covers become byte pieces, or the unknown piece where the model has none.  Results equal the
library's.  Null and empty texts have no pieces and decode to the empty text.  Repeated rows are coded alike; a text of any length,
one unbroken word too, is one row; an empty table gives no rows.  Models whose normaliser rewrites
characters are refused.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import small_batches

MARK = "▁"
CACHE_WORDS = 150_000  # bound of a worker's memory for finished words; clearing it changes no result
PAIR_MEMORY = 500_000  # bound of remembered pairs of pieces
NO_PIECE = 1 << 23  # stands before a word's first piece
UNKNOWN_NUMBERS = 1 << 20  # ids are below; characters without a piece are numbered from here on
UNIGRAM, BPE = 1, 2  # model types of the file format
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0


class Codec:
    """Encoder and decoder of one model file, for use inside a task."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models with the identity normaliser and kept spaces are supported")
        if proto.trainer_spec.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        if any(p.type in (USER_DEFINED, UNUSED) for p in proto.pieces) or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("user-defined pieces and marks as suffixes are not supported")
        self.merges = proto.trainer_spec.model_type == BPE
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.bytes = [i for i, p in enumerate(proto.pieces) if p.type == BYTE]
        self.longest = max(map(len, self.ids))
        self.suffixes = {p[i:] for p in self.ids for i in range(len(p))}  # a longer piece can end so
        self.penalty = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        self.plain = not crossing
        self.words = re.compile("(?s).+" if crossing else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.pieces = [
            bytes([self.bytes.index(i)]) if p.type == BYTE
            else b"" if p.type == CONTROL
            else " ⁇ ".encode() if p.type == UNKNOWN
            else p.piece.replace(MARK, " ").encode()
            for i, p in enumerate(proto.pieces)
        ]
        self.pairs: dict[int, bool] = {}
        self.done: dict[str, bytes] = {}

    # -- merge model ---------------------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """Merges applied one by one, best score first, leftmost among equals.  Used on two pieces at a time."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def agree(self, left: str, right: str, key: int) -> bool:
        """Whether ``left`` and ``right`` stay two pieces when they stand side by side; remembered under ``key``."""
        if len(self.pairs) > PAIR_MEMORY:
            self.pairs.clear()
        parts = self.merged(left + right)
        found = self.pairs[key] = parts == ([left, right] if left else [right])
        return found

    def number(self, char: str) -> int:
        """A number above all ids for a character that is no piece."""
        return UNKNOWN_NUMBERS + ord(char)

    # -- the pass over sorted words ------------------------------------------------------

    def segmented(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """(word, its pieces) for distinct words in sorted order, forward values kept along the common prefix."""
        start: list[int] = [0]  # start[i]: where the last piece of the prefix of i characters begins
        value: list = [NO_PIECE if self.merges else 0.0]  # value[i]: that piece's number, or the prefix's best sum
        extend = self._extend_merges if self.merges else self._extend_sums
        before = ""
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del start[shared + 1:], value[shared + 1:]
            extend(word, start, value)
            before = word
            pieces, end = [], len(word)
            while end:
                pieces.append(word[start[end]:end])
                end = start[end]
            yield word, pieces[::-1]

    def _extend_merges(self, word: str, start: list[int], last: list[int]) -> None:
        number, suffixes, pairs, agree = self.ids.get, self.suffixes, self.pairs, self.agree
        for end in range(len(start), len(word) + 1):
            at = end - 1
            while True:
                piece = word[at:end]
                right = number(piece)
                if right is None and at == end - 1:
                    right = self.number(piece)
                if right is not None:
                    key = last[at] << 22 | right
                    known = pairs.get(key)
                    if known or known is None and agree(word[start[at]:at], piece, key):
                        start.append(at)
                        last.append(right)
                        break
                at -= 1
                if at < 0 or word[at:end] not in suffixes:  # a model whose pieces do not follow from its merges
                    raise ValueError(f"no encoding of {word[:end]!r}")

    def _extend_sums(self, word: str, start: list[int], best: list[float]) -> None:
        scores, longest, penalty = self.scores, self.longest, self.penalty
        for end in range(len(start), len(word) + 1):
            top, place = None, end - 1
            for at in range(max(0, end - longest), end):
                score = scores.get(word[at:end])
                if score is None:
                    if at < end - 1:
                        continue
                    score = penalty
                if top is None or best[at] + score > top:
                    top, place = best[at] + score, at
            best.append(top)
            start.append(place)

    def piece_ids(self, pieces: list[str]) -> list[int]:
        try:
            return [self.ids[p] for p in pieces]
        except KeyError:
            pass
        out: list[int] = []
        for piece in pieces:
            known = self.ids.get(piece)
            if known is not None:
                out.append(known)
            elif self.bytes:
                out.extend(self.bytes[b] for b in piece.encode())
            elif not (out and out[-1] == self.unknown):  # neighbours that are unknown are one piece
                out.append(self.unknown)
        return out

    # -- texts ---------------------------------------------------------------------------

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        marked = [self._words(t) if t else [] for t in texts]
        done = self.done
        if len(done) > CACHE_WORDS:
            done.clear()
        new = set().union(*marked)
        new.difference_update(done)
        # A word without a mark of its own stands behind one space.
        for word, pieces in self.segmented(sorted({w if w.startswith(MARK) or not self.prefix else MARK + w for w in new})):
            ids = array("i", self.piece_ids(pieces)).tobytes()
            if word in new:
                done[word] = ids
            if word[1:2] != MARK and word[1:] in new:
                done[word[1:]] = ids
        return [np.frombuffer(b"".join(map(done.__getitem__, words)), "<i4") for words in marked]

    def _words(self, text: str) -> list[str]:
        """Marked words; in texts of single spaces the words between them, whose mark is implied."""
        if self.prefix and MARK not in text and self.plain:
            words = text.split(" ")
            if "" not in words:
                return words
        return self.words.findall(self.prefix + text.replace(" ", MARK))

    def decode(self, ids: Iterable[int]) -> str:
        pieces = self.pieces
        text = b"".join([pieces[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_CODECS: dict[str, Codec] = {}


def codec_of(model: bytes) -> Codec:
    """One codec per worker process and model, so pairs that agree serve the next task too."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))


def _kept(docs: DataFrame, keep: list[str] | None, made: tuple[str, ...]) -> tuple[list[str], DataFrame]:
    names = [c for c in (keep if keep is not None else docs.columns) if c not in made]
    asked = names if "text" in names else [*names, "text"]
    return names, docs.select(*[f"`{c}`" for c in asked])


def encode(docs: DataFrame, model_path: str, keep: list[str] | None = None, decoded: bool = False) -> DataFrame:
    """``keep`` columns (all, if None) plus ids (array<int>), and ``decoded``, the text the ids give, if asked for.

    The model file is read on the driver and sent along (half a megabyte).  Columns of the new names are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    names, asked = _kept(docs, keep, ("ids", "decoded"))
    sent = spark.sparkContext.broadcast(model_bytes(model_path))
    fields = [docs.schema[c] for c in names] + [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField("decoded", T.StringType())] * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(sent.value)
        for batch in batches:
            ids = codec.encode(batch.column("text").to_pylist())
            more = [pa.array([codec.decode(i.tolist()) for i in ids], pa.string())] if decoded else []
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), _lists(ids), *more], [f.name for f in fields])
        codec.done.clear()

    return asked.mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, model_path: str) -> DataFrame:
    """``df`` with ``decoded`` from its ``ids`` (array of numbers; null as empty)."""
    spark = df.sparkSession
    small_batches(spark)
    names = [c for c in df.columns if c != "decoded"]
    sent = spark.sparkContext.broadcast(model_bytes(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(sent.value)
        for batch in batches:
            text = [codec.decode(i or ()) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(text, pa.string())], [*names, "decoded"])

    return df.select(*[f"`{c}`" for c in names]).mapInArrow(
        run, T.StructType([df.schema[c] for c in names] + [T.StructField("decoded", T.StringType())]))


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (over little-endian 32-bit ids), same (whether the ids decode to the text).

    Marks that stand in a text themselves decode to spaces, as they do in the library.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model_bytes(model_path))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(sent.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = codec.encode(texts)
            same = [codec.decode(i.tolist()) == (t or "").replace(MARK, " ") for t, i in zip(texts, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(i) for i in ids], pa.int64()),
                pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()), pa.array(same),
            ], ["doc_id", "n_tokens", "ids_crc32", "same"])
        codec.done.clear()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_crc32 bigint, same boolean")

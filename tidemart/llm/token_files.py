"""Token ids as flat binary files with 64-bit document offsets.

Documents are dealt into ranges of ascending doc_id, then of the hash of their text, so rows of one id, or of none, may
lie in several files; each task writes one pair of files:

* ``<name>.ids``: the ids of its documents, end id included, as little-endian unsigned integers, 16 or 32 bits by vocabulary size;
* ``<name>.idx``: the number of documents n, n + 1 offsets into the ids, n doc_ids, as little-endian signed 64-bit
  integers, then n bytes that are 0 where the doc_id is null.

Every attempt of a task writes under a name of its own and only the names that tasks return count, so repeated tasks leave
nothing wrong behind.  The driver sees one row per file; the prefix sums over their counts are the files' bases.
Readers map the files into memory where the store is a local one and read them otherwise.

Null and empty texts hold the end id only.  Null doc_ids come first; documents of equal doc_id follow each other by the hash of their text, then by text.
An empty table gives no files' worth of rows.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches
from .files import is_local, one_per_task, opened, shared_folder

END_ID = 1
CACHE_WORDS = 1_000_000  # bound of a worker's memory for finished words, kept from task to task; clearing it changes no result
READ_DOCS = 4096
ROW_WORDS = 200

#: A run of these behind letters is a pre-token of its own (an apostrophe may begin one with letters).
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordEncoder:
    """A tokenizers-library file whose rules drop white space: equal words are encoded once.

    Nothing in such a tokenizer looks across white space, nor from letters to the signs behind them.  New words of letters are
    encoded in rows, parted by spaces, and the row's ids are cut at the tokens that end a word; a row with another number
    of these than words is encoded word by word.  Words of letters with signs behind them are put together from both
    parts; all others are encoded on their own.  What this relies on is tried out when a file is loaded.
    """

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.done: dict[str, bytes] = {"": b""}
        self.ends = np.zeros(self.size, bool)
        bpe = json.loads(model)["model"]
        if suffix := bpe.get("end_of_word_suffix"):
            self.ends[[i for piece, i in bpe["vocab"].items() if piece.endswith(suffix)]] = True
        for parts in (("a", " ", "b"), ("a", "\n", "b"), ("a", " \t ", "b"), *(("ab", sign * 2) for sign in TAIL)):
            if self._ids("".join(parts)) != [i for p in parts for i in self._ids(p)]:
                raise ValueError("this tokenizer keeps white space or joins words with signs; words cannot be encoded apart")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _alone(self, words: list[str]) -> None:
        for w, e in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
            self.done[w] = np.array(e.ids, "<u4").tobytes()

    def _in_rows(self, words: list[str]) -> None:
        rows = [words[i:i + ROW_WORDS] for i in range(0, len(words), ROW_WORDS)]
        found = self.tokenizer.encode_batch_fast([" ".join(r) for r in rows], add_special_tokens=False)
        for row, encoding in zip(rows, found, strict=True):
            ids = np.array(encoding.ids, "<u4")
            closing = np.flatnonzero(self.ends[ids]) + 1  # each word has one at least
            if len(closing) != len(row) or closing[-1] != len(ids):
                self._alone(row)
                continue
            raw, places = ids.tobytes(), [0, *(closing * 4).tolist()]
            self.done.update((w, raw[a:b]) for w, a, b in zip(row, places, places[1:]))

    def _learn(self, new: set[str]) -> None:
        done = self.done
        letters, signed, others = set(), [], []
        for w in new:
            if w.isalpha():
                letters.add(w)
            elif (stem := w.rstrip(TAIL)).isalpha():
                signed.append((w, stem, w[len(stem):]))
            else:
                others.append(w)
        letters.update(stem for _, stem, _ in signed)
        letters.difference_update(done)
        others.extend({tail for _, _, tail in signed}.difference(done))
        letters = list(letters)
        for at in range(0, len(letters), 100 * ROW_WORDS):
            self._in_rows(letters[at:at + 100 * ROW_WORDS])
        for at in range(0, len(others), 10_000):
            self._alone(others[at:at + 10_000])
        for w, stem, tail in signed:
            done[w] = done[stem] + done[tail]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        words = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if t else [] for t in texts]
        if len(self.done) > CACHE_WORDS:
            self.forget()
        new = set().union(*words)
        new.difference_update(self.done)
        self._learn(new)
        get = self.done.__getitem__
        return [np.frombuffer(b"".join(map(get, ws)), "<u4") for ws in words]

    def forget(self) -> None:
        self.done.clear()
        self.done[""] = b""


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(model: str) -> WordEncoder:
    key = hashlib.sha256(model.encode()).hexdigest()
    if key not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(model)
    return _ENCODERS[key]


def write_tokens(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> list[tuple]:
    """Writes the files; (uri, base, n_docs, n_tokens, id_bytes) per file in ascending doc_id order."""
    small_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        model = f.read()
    width = 2 if max(encoder_of(model).size, end_id + 1) <= 1 << 16 else 4
    sent = spark.sparkContext.broadcast(model)  # one vocabulary file
    folder = shared_folder(spark, "tokens")
    store, root = opened(folder)
    store.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(sent.value)
        part = TaskContext.get().partitionId()
        uri = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        store, path = opened(uri)
        end = np.array([end_id], f"<u{width}").tobytes()
        sizes, names, known = [np.zeros(1, np.int64)], [], []
        with store.open_output_stream(f"{path}.ids", compression=None) as out:
            for batch in batches:
                ids = encoder.encode(batch.column("text").to_pylist())
                for i in ids:
                    out.write(i.astype(f"<u{width}").tobytes() + end)
                sizes.append(np.array([len(i) + 1 for i in ids], np.int64))
                column = batch.column("doc_id")
                known.append(column.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8))
                names.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        offsets = np.cumsum(np.concatenate(sizes)).astype("<i8")
        n = len(offsets) - 1
        with store.open_output_stream(f"{path}.idx", compression=None) as out:
            for array in (np.array([n], "<i8"), offsets, *names, *known):
                out.write(array.tobytes())
        yield pa.RecordBatch.from_pydict({"part": [part], "uri": [uri], "n_docs": [n], "n_tokens": [int(offsets[-1])]})

    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    ordered = hashed.repartitionByRange(F.col("doc_id").asc_nulls_first(), "hash") \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "hash", F.col("text").asc_nulls_first()).drop("hash")
    files = sorted(ordered.mapInArrow(write, "part bigint, uri string, n_docs bigint, n_tokens bigint").collect())  # one row a file
    bases = accumulate((f.n_tokens for f in files), initial=0)
    return [(f.uri, base, f.n_docs, f.n_tokens, width) for f, base in zip(files, bases) if f.n_docs]


def mapped(uri: str, suffix: str, dtype: str) -> np.ndarray:
    """A file as an array: mapped into memory in a local store, else read."""
    store, path = opened(uri + suffix)
    if is_local(store):
        return np.memmap(path, dtype, "r") if store.get_file_info(path).size else np.zeros(0, dtype)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype)


def read_documents(uri: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, doc_ids, 0/1 for known doc_ids) of one pair of files."""
    raw = mapped(uri, ".idx", "u1")
    n = int(raw[:8].view("<i8")[0])
    numbers = raw[8:8 + 8 * (2 * n + 1)].view("<i8")
    return numbers[:n + 1], numbers[n + 1:], raw[8 + 8 * (2 * n + 1):]


def read_tokens(spark: SparkSession, files: list[tuple], digest_only: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (over unsigned 32-bit ids) and, unless ``digest_only``, ids."""
    kind = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ("" if digest_only else ", ids array<bigint>")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                ids = mapped(f["uri"], ".ids", f"<u{f['id_bytes']}")
                offsets, names, known = read_documents(f["uri"])
                for at in range(0, f["n_docs"], READ_DOCS):
                    ends = offsets[at:at + READ_DOCS + 1]
                    parts = [ids[a:b].astype("<u4") for a, b in zip(ends[:-1], ends[1:], strict=True)]
                    columns = {
                        "doc_id": pa.array(np.array(names[at:at + len(parts)]), mask=known[at:at + len(parts)] == 0),
                        "start": pa.array(ends[:-1] + f["base"]), "n_tokens": pa.array(np.diff(ends)),
                        "ids_crc32": pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
                    }
                    if not digest_only:
                        columns["ids"] = pa.array([p.astype(np.int64) for p in parts], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(columns)

    rows = one_per_task(spark, files, "uri string, base bigint, n_docs bigint, n_tokens bigint, id_bytes int")
    return rows.mapInArrow(read, kind)

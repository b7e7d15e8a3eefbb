"""Groups of spelling variants by blocked Gram matrices.

Words are maximal runs of Latin letters, A-Z lower-cased.  One run in ``NOISE`` (by the checksum of document and run) loses a
letter, as a typist might lose one.  Two words are near if one inserted, deleted or replaced code point turns one into the other.

One replaced letter changes two letter counts by one, an inserted or deleted one changes one count: near words have letter
count vectors at a squared distance of at most two.  Within a block of words, a NumPy product of the count matrices of one
length and of the same or the next length gives all squared distances at once; pairs at most two apart are verified letter by
letter.  Which words share a block: the letters are dealt to ``SEGMENTS`` segments, and as a near pair differs in at most two,
it agrees on all counts of at least two of the four.  Every pair of segments is a grid, every content of those two segments a
block of it; a near pair is met in some grid, and given by the first that has it.  Blocks of over ``TILE_WORDS`` words are cut
into slices by hash, and each pair of slices is a tile of its own, so that no task holds more than two slices at a time.

Null texts have no words, a null doc_id counts as the empty text in checksums.  Repeated rows count again.  Words of any length
are taken, a text of one unbroken word too; their verification runs in pieces of bounded size.  An empty table gives no rows.
Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, staged

RUN = re.compile("[A-Za-zÀ-ÿ]+")
NOISE = 199
LEAST_LETTERS, LEAST_COUNT, FORM_RATIO = 6, 5, 5
FLUSH_WORDS = 300_000  # distinct words a task holds before it hands their counts on
TILE_WORDS = 2_048
CELLS = 1 << 22  # of a product, and of the letters compared at once
ROUNDS = 40  # a form has five times the rows of its word, so chains stay under log5 of the rows

LETTERS = [chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100))]
SEGMENTS = 4
GRIDS = tuple(combinations(range(SEGMENTS), 2))


def segments() -> list[str]:
    """The letters dealt in turn, so that each segment has frequent and rare ones."""
    return ["".join(LETTERS[i::SEGMENTS]) for i in range(SEGMENTS)]


# ---- counting --------------------------------------------------------------------------

LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def words_of(doc_id, text: str, noise: int, least_letters: int) -> Iterator[tuple[str, int]]:
    """(word, n) of one text, letters lost included."""
    # In UTF-8 the bytes of A-Z stand for nothing else.
    low = text.encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass")
    begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(low)).items():
        if len(run) < least_letters:
            continue
        h = zlib.crc32(run.encode(), begun)
        if h % noise == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least_letters:
                continue
        yield run, n


def word_counts(docs: DataFrame, noise: int = NOISE, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least ``least_letters`` code points and ``least_count`` occurrences in all texts."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})
            seen.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in words_of(doc_id, text, noise, least_letters):
                    seen[word] += n
                if len(seen) > FLUSH_WORDS:
                    yield flush()
        yield flush()

    found = docs.where("text IS NOT NULL").select("doc_id", "text").mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---- blocks ----------------------------------------------------------------------------

def _content(word: Column, pair: tuple[int, int]) -> Column:
    """The sorted letters of a word that belong to two segments: equal for words with equal counts there."""
    others = "".join(s for i, s in enumerate(segments()) if i not in pair)
    return F.array_join(F.array_sort(F.split(F.translate(word, others, ""), "")), "")


def tiles(spark: SparkSession, words: DataFrame, tile_words: int = TILE_WORDS) -> DataFrame:
    """(word, n, grid, tile, part): every word once per grid; in a block of several slices once per tile of its slice.

    ``part`` tells the two slices of a tile apart: 0 and 1, or 2 where a tile pairs one slice with itself.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(g).alias("grid"), F.xxhash64(F.lit(g), _content(F.col("word"), pair)).alias("cell"))
                                for g, pair in enumerate(GRIDS)]))
    celled = words.select("word", "n", cells.alias("c")).select("word", "n", "c.grid", "c.cell")
    # Written down, the list of large blocks has a known size; where it is too large to be broadcast, both sides of the
    # join have an exchange of their own, and the skew rule splits a large block.
    large = staged(spark, celled.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > tile_words)
                   .select("cell", F.ceil(F.col("size") / tile_words).cast("int").alias("slices")), "large-blocks")
    sliced = celled.join(large, "cell", "left")
    own = F.pmod(F.xxhash64("word", F.lit(7)), F.coalesce("slices", F.lit(1))).cast("int")
    met = F.transform(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1), lambda s: F.struct(
        F.xxhash64("cell", F.least(s, F.col("own")), F.greatest(s, F.col("own"))).alias("tile"),
        F.when(s == F.col("own"), 2).when(s > F.col("own"), 0).otherwise(1).alias("part")))
    placed = sliced.withColumn("own", own).withColumn("met", F.when(F.col("slices").isNull(), F.array(
        F.struct(F.col("cell").alias("tile"), F.lit(2).alias("part")))).otherwise(met))
    return placed.select("word", "n", "grid", F.explode("met").alias("m")).select("word", "n", "grid", "m.tile", "m.part")


# ---- one tile --------------------------------------------------------------------------

COLUMN = np.full(256, len(LETTERS), np.int64)
COLUMN[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
FIRST_GRID = [next((g for g, (i, j) in enumerate(GRIDS) if not (bits >> i & 1 or bits >> j & 1)), -1) for bits in range(1 << SEGMENTS)]


def letter_counts(words: list[bytes]) -> np.ndarray:
    """A row of counts per word (Latin-1 bytes), exact in its type for the squares of all lengths at hand."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    row = np.repeat(np.arange(len(words)), sizes)
    cells = row * (len(LETTERS) + 1) + COLUMN[np.frombuffer(b"".join(words), np.uint8)]
    counts = np.bincount(cells, minlength=len(words) * (len(LETTERS) + 1)).reshape(len(words), -1)
    return counts.astype(np.float32 if sizes.max(initial=0) < 2_000 else np.float64)


def close_pairs(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of ``a`` and ``b`` at a squared distance of at most two, some rows of ``a`` at a time."""
    squares_a, squares_b, step = (a * a).sum(1), (b * b).sum(1), max(1, CELLS // max(1, len(b)))
    for at in range(0, len(a), step):
        distance = squares_a[at:at + step, None] + squares_b[None, :] - 2 * (a[at:at + step] @ b.T)
        i, j = np.nonzero(distance <= 2)
        yield i + at, j


def one_edit(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For lists of words, each list of one length, that of ``b`` equal or one more: True where one edit makes them equal."""
    out = np.zeros(len(a), bool)
    if not a:
        return out
    short, long = len(a[0]), len(b[0])
    step = max(1, CELLS // long)
    for at in range(0, len(a), step):
        x = np.frombuffer(b"".join(a[at:at + step]), np.uint8).reshape(-1, short)
        y = np.frombuffer(b"".join(b[at:at + step]), np.uint8).reshape(-1, long)
        if short == long:
            out[at:at + step] = (x != y).sum(1) == 1
            continue
        head, tail = x != y[:, :short], (x != y[:, 1:])[:, ::-1]
        same = lambda d: np.where(d.any(1), d.argmax(1), short)
        out[at:at + step] = same(head) + same(tail) >= short
    return out


def near_in_tile(words: list[bytes], part: np.ndarray, grid: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the near pairs of a tile that no earlier grid gives, each once."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    counts = letter_counts(words)
    lengths: dict[int, list[np.ndarray]] = {
        int(n): [np.nonzero((sizes == n) & (part == p))[0] for p in range(3)] for n in np.unique(sizes)}
    left, right = [], []

    def take(rows_a: np.ndarray, rows_b: np.ndarray, triangle: bool) -> None:
        if not (len(rows_a) and len(rows_b)):
            return
        for i, j in close_pairs(counts[rows_a], counts[rows_b]):
            if triangle:
                i, j = i[i < j], j[i < j]
            i, j = rows_a[i], rows_b[j]
            real = one_edit([words[k] for k in i], [words[k] for k in j])
            i, j = i[real], j[real]
            changed = np.zeros(len(i), np.int64)
            for s in range(SEGMENTS):
                own = slice(s, len(LETTERS), SEGMENTS)
                changed |= (counts[i, own] != counts[j, own]).any(1).astype(np.int64) << s
            mine = np.array([FIRST_GRID[c] == grid for c in changed], bool)
            left.append(i[mine])
            right.append(j[mine])

    for n, (a, b, alone) in lengths.items():
        take(alone, alone, True)
        take(a, b, False)
        if n + 1 in lengths:
            next_a, next_b, next_alone = lengths[n + 1]
            take(alone, next_alone, False)
            take(a, next_b, False)
            take(b, next_a, False)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def near_words(spark: SparkSession, words: DataFrame, tile_words: int = TILE_WORDS) -> DataFrame:
    """(word, other, other_n): every near pair in both directions, once."""
    ordered = tiles(spark, words, tile_words).repartition("tile").sortWithinPartitions("tile", "grid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def solved(rows: pa.Table, starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Near pairs of the complete tiles of ``rows``."""
            word, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
            part, grid = rows.column("part").to_numpy(), rows.column("grid").to_numpy()
            made: list[tuple[np.ndarray, np.ndarray]] = []
            for at, end in zip(starts, ends, strict=True):
                if end - at > 1:
                    i, j = near_in_tile([w.encode("latin-1") for w in word[at:end]], part[at:end], int(grid[at]))
                    made.append((i + at, j + at))
            if made:
                i, j = (np.concatenate(x) for x in zip(*made, strict=True))
                for one, two in ((i, j), (j, i)):
                    if len(one):
                        yield pa.RecordBatch.from_arrays([
                            pa.array([word[k] for k in one], pa.string()), pa.array([word[k] for k in two], pa.string()),
                            pa.array(n[two], pa.int64())], ["word", "other", "other_n"])

        def complete(last: bool) -> Iterator[pa.RecordBatch]:
            rows = pa.concat_tables(held).combine_chunks()
            tile, grid = rows.column("tile").to_numpy(), rows.column("grid").to_numpy()
            cuts = np.nonzero((tile[1:] != tile[:-1]) | (grid[1:] != grid[:-1]))[0] + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(tile)]])
            held.clear()
            if not last:  # the last tile may go on in the next batch
                held.append(rows.slice(starts[-1]))
                starts, ends = starts[:-1], ends[:-1]
            yield from solved(rows, starts, ends)

        for batch in batches:
            if batch.num_rows:
                held.append(pa.Table.from_batches([batch]))
                if sum(t.num_rows for t in held) > 4 * TILE_WORDS:
                    yield from complete(False)
        if held:
            yield from complete(True)

    return ordered.mapInArrow(run, "word string, other string, other_n long")


# ---- forms and roots -------------------------------------------------------------------

def spelling_groups(spark: SparkSession, docs: DataFrame, ratio: int = FORM_RATIO, tile_words: int = TILE_WORDS, **counting) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n (ties: least in code-point order) if it has at least ``ratio`` times the word's n.
    ``root`` follows the forms to the last; a word without a form is its own root.
    """
    if ratio < 2:
        raise ValueError("a form needs at least twice its word's rows, else forms may go round in circles")
    words = staged(spark, word_counts(docs, **counting), "words")
    best = near_words(spark, words, tile_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("w"))).alias("b"))
    enough = F.coalesce(-F.col("b.m") >= ratio * F.col("n"), F.lit(False))
    formed = staged(spark, words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("b.w")).alias("form"),
        F.when(enough, -F.col("b.m")).alias("form_n")), "forms")
    links = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(ROUNDS):  # each round doubles the reach of every link
        links = staged(spark, links, "roots")
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if links.join(ahead, "root", "left_semi").isEmpty():
            break
        links = links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return formed.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Spelling variants of a vocabulary by search schemes on bidirectional FM-indexes.

Two words are near if one inserted, deleted or replaced code point turns one into the other.
The error spares one half of a word, so every near word begins with its first half or ends
with its second one.

1. Words are counted over all texts, in each task first.
2. The vocabulary is sorted twice, by words and by words read backwards, and cut into blocks
   of at most ``BLOCK`` characters. A block is the text ``#word#word#...#`` with an FM-index
   of it and of its reverse. A word goes as a query to the blocks whose range holds its
   first half, and backwards to those that hold its second half: one block mostly, several
   where very many words share a half.
3. A query's half is matched to the left in the index, up to the delimiter, which leaves the
   interval of suffix ranks of the words that begin with it. The search then turns round and
   extends the interval to the right over the other half, allowing one error, until the
   closing delimiter. Both indexes follow every step. All queries of a batch take their
   steps together, as arrays of intervals.
4. Pairs found meet by word; roots follow forms by doubling the way each round.

Words are of code points up to U+00FF, so an index takes at most about 400 bytes a character
of its block. A word is one row, and a block holds one whole word at least.

Defined cases: null texts have no words; a null id is an empty text in the hash that picks
the words to be misspelt; equal ids with the same word draw alike; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from noticelens.llm.common import stored
from noticelens.session import lookup

LEAST_LENGTH, LEAST_COUNT = 5, 3
# One in so many (document, word) pairs loses a letter.
MISSPELT = 97
# A form has at least so many times the occurrences.
RATIO = 2
# Characters of a block; queries searched together; words and characters counted at once.
BLOCK, BATCH, COUNTED, PART = 1 << 17, 4_096, 300_000, 1 << 20

# Lower-cased runs, so without A-Z.
_RUN = re.compile("[a-zÀ-ÿ]+")
_GAP = re.compile("[^a-zÀ-ÿ]")


def _parts(text: str) -> Iterator[str]:
    """The text in parts of bounded length that cut no run."""
    start = 0
    while start < len(text):
        gap = _GAP.search(text, start + PART)
        end = gap.start() if gap else len(text)
        yield text[start:end]
        start = end


def _count(batches: Iterator[pa.RecordBatch], misspelt: int, least: int) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()

    def counted() -> pa.RecordBatch:
        names, counts = list(total), list(total.values())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            head = zlib.crc32(f"{doc.as_py() or ''}:".encode())
            # Bytes are lower-cased in A-Z only.
            lowered = (text.as_py() or "").encode("utf-8", "replace").lower().decode()
            for part in _parts(lowered):
                for word, n in Counter(_RUN.findall(part)).items():
                    h = zlib.crc32(word.encode(), head)
                    if h % misspelt == 0:
                        k = h % len(word)
                        word = word[:k] + word[k + 1 :]
                    if len(word) >= least:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield counted()
                    total = Counter()
    if total:
        yield counted()


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    misspelt: int = MISSPELT,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n) of all words of all texts, some misspelt by the hash of document and word."""
    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    parts = rows.mapInArrow(lambda batches: _count(batches, misspelt, least_length), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def rotations(text: np.ndarray) -> np.ndarray:
    """Starts of the sorted rotations of a text, by doubling the length compared."""
    rank, span, size = text.astype(np.int64), 1, len(text)
    while True:
        pair = rank * (int(rank.max()) + 1) + np.roll(rank, -span)
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        rank = np.empty(size, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        span *= 2
        if rank[order[-1]] == size - 1 or span >= 2 * size:
            return order


def _smaller(text: np.ndarray, order: np.ndarray, letters: int) -> np.ndarray:
    """[i, c]: characters below c among the first i of the Burrows-Wheeler transform."""
    last = text[order - 1]
    table = np.zeros((len(text) + 1, letters + 2), dtype=np.int32)
    for c in range(letters):
        np.cumsum(last <= c, out=table[1:, c + 1])
    # One more letter that is nowhere stands for those that the block lacks.
    table[:, letters + 1] = table[:, letters]
    return table


class BiIndex:
    """FM-indexes of a delimited vocabulary and of its reverse.

    A pattern's occurrences are ``size`` ranks from ``fore`` in the one and from ``back`` in
    the other. Rotations stand for suffixes: two delimiters meet only where the text wraps,
    so they all differ and no word runs over the end.
    """

    def __init__(self, words: list[str]):
        raw = np.frombuffer(b"\0" + b"".join(w.encode("latin-1") + b"\0" for w in words), dtype=np.uint8)
        found = np.unique(raw)
        self.letters = len(found)
        self.code = np.full(256, self.letters, dtype=np.int64)
        self.code[found] = np.arange(self.letters)
        text = self.code[raw]
        self.order = rotations(text)
        self.fore = _smaller(text, self.order, self.letters)
        self.back = _smaller(text[::-1], rotations(text[::-1]), self.letters)
        self.before = self.fore[-1].astype(np.int64)
        self.word = np.cumsum(raw == 0) - 1

    @staticmethod
    def _extend(table, before, here, there, size, c):
        """Intervals after one more character on the side whose transform the table has."""
        low, high = table[here, c].astype(np.int64), table[here + size, c].astype(np.int64)
        first = table[here, c + 1] - low
        count = table[here + size, c + 1] - high - first
        return before[c] + first, there + high - low, count

    def to_left(self, fore, back, size, c):
        fore, back, size = self._extend(self.fore, self.before, fore, back, size, c)
        return fore, back, size

    def to_right(self, fore, back, size, c):
        back, fore, size = self._extend(self.back, self.before, back, fore, size, c)
        return fore, back, size

    def all_right(self, fore, back, size):
        """(row, character, fore, back, size) of every way to extend to the right."""
        low, high = self.back[back], self.back[back + size]
        count = np.diff(high, axis=1) - np.diff(low, axis=1)
        count[:, 0] = 0  # the delimiter is no letter
        row, c = np.nonzero(count[:, : self.letters])
        first = self.before[c] + low[row, c + 1] - low[row, c]
        return row, c, fore[row] + high[row, c] - low[row, c], first, count[row, c].astype(np.int64)

    def search(self, queries: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of the words that share the first ``half`` characters and have one
        error behind them; queries are rows of codes of one length."""
        length = queries.shape[1]
        who = np.arange(len(queries))
        fore = np.zeros(len(queries), dtype=np.int64)
        state = fore, fore.copy(), np.full(len(queries), len(self.order))

        def kept(who, state):
            alive = state[2] > 0
            return who[alive], tuple(x[alive] for x in state)

        def joined(*parts):
            owners = np.concatenate([p[0] for p in parts])
            return owners, tuple(np.concatenate([p[1][n] for p in parts]) for n in range(3))

        for place in range(half - 1, -1, -1):
            who, state = kept(who, self.to_left(*state, queries[who, place]))
        who, state = kept(who, self.to_left(*state, np.zeros(len(who), dtype=np.int64)))
        erred = who[:0], tuple(x[:0] for x in state)
        for place in range(half, length + 1):
            row, c, *ways = self.all_right(*state)
            owner = who[row]
            wanted = queries[owner, place] if place < length else np.full(len(owner), -1)
            other = c != wanted
            # An inserted letter; one like the letter that follows is inserted behind it.
            inserted = owner[other], tuple(x[other] for x in ways)
            if place == length:
                erred = joined(erred, inserted)
                break
            erred = joined(erred, inserted)
            erred = kept(erred[0], self.to_right(*erred[1], queries[erred[0], place]))
            # A replaced letter, a deleted one.
            erred = joined(erred, inserted, (who, state))
            who, state = owner[~other], tuple(x[~other] for x in ways)
        owner, (fore, _, _) = kept(erred[0], self.to_right(*erred[1], np.zeros(len(erred[0]), dtype=np.int64)))
        return owner, self.word[self.order[fore]]

    def near(self, words: list[str], halves: list[int]) -> Iterator[tuple[int, int]]:
        """Pairs (query, word of the block), repeats included."""
        alike: dict[tuple[int, int], list[int]] = {}
        for n, (word, half) in enumerate(zip(words, halves)):
            alike.setdefault((len(word), half), []).append(n)
        for (length, half), members in alike.items():
            raw = np.frombuffer("".join(words[n] for n in members).encode("latin-1"), dtype=np.uint8)
            owner, found = self.search(self.code[raw].reshape(-1, length), half)
            yield from zip(np.array(members)[owner].tolist(), found.tolist())


_PAIRS = "word string, near string, near_n long"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of words from rows (block, query, flipped, key, n), sorted by the first two."""
    block, index, words, counts, flipped = None, None, [], [], False

    def pairs(keys: list[str]) -> pa.RecordBatch:
        halves = [len(k) - len(k) // 2 if flipped else len(k) // 2 for k in keys]
        found = {(a, b) for a, b in index.near(keys, halves) if keys[a] != words[b]}
        turn = -1 if flipped else 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array([keys[a][::turn] for a, _ in found], pa.string()),
                pa.array([words[b][::turn] for _, b in found], pa.string()),
                pa.array([counts[b] for _, b in found], pa.int64()),
            ],
            names=["word", "near", "near_n"],
        )

    for batch in batches:
        blocks, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (asks[1:] != asks[:-1])) + 1
        for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(blocks)]):
            if blocks[first] != block:
                block, index, words, counts = blocks[first], None, [], []
                flipped = batch.column(2)[first].as_py()
            part = batch.slice(first, last - first)
            keys = part.column(3).to_pylist()
            if not asks[first]:
                words += keys
                counts += part.column(4).to_pylist()
                continue
            index = index or BiIndex(words)
            for n in range(0, len(keys), BATCH):
                yield pairs(keys[n : n + BATCH])


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n) of all near words of a stored table (word, n); pairs may repeat."""
    spark = words.sparkSession
    total = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    sided = words.select(F.explode(F.array(F.lit(False), F.lit(True))).alias("flipped"), "word", "n").select(
        "flipped", F.when(F.col("flipped"), F.reverse("word")).otherwise(F.col("word")).alias("key"), "n"
    )
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * total // block + 1)
    placed = sided.repartitionByRange(ranges, "flipped", "key").withColumn("range", F.spark_partition_id())
    placed = stored(placed, "sorted_words")
    so_far = Window.partitionBy("range", "flipped").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length("key") + 1).over(so_far), F.lit(0))
    # Ranges, sides in them, and pieces of bounded length, in the order of the keys.
    piece = F.struct("range", "flipped", F.floor(before / block).alias("piece"))
    placed = placed.withColumn("piece", piece)
    firsts = placed.groupBy("piece").agg(F.min("key").alias("first")).orderBy("piece").collect()
    number = {(r.piece.range, r.piece.flipped, r.piece.piece): n for n, r in enumerate(firsts)}
    if not number:
        return spark.createDataFrame([], _PAIRS)
    sides = {
        side: ([r.first for r in firsts if r.piece.flipped == side], [n for n, r in enumerate(firsts) if r.piece.flipped == side])
        for side in (False, True)
    }
    names = spark.createDataFrame([(*k, n) for k, n in number.items()], "range int, flipped boolean, piece long, block int")
    own = placed.select("range", "flipped", F.col("piece.piece").alias("piece"), "key", "n")
    index = own.join(F.broadcast(names), ["range", "flipped", "piece"]).select("block", F.lit(False).alias("query"), "flipped", "key", "n")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for flipped, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                first, blocks = sides[flipped]
                half = key[: len(key) - len(key) // 2 if flipped else len(key) // 2]
                low = max(bisect_right(first, half) - 1, 0)
                for n in range(low, bisect_right(first, half + "\U0010ffff")):
                    rows.append((blocks[n], True, flipped, key, None))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int32(), pa.bool_(), pa.bool_(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["block", "query", "flipped", "key", "n"]
            )

    asked = placed.select("flipped", "key").mapInArrow(route, "block int, query boolean, flipped boolean, key string, n long")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(number))
    both = index.unionByName(asked).repartition(tasks, "block").sortWithinPartitions("block", "query")
    return both.mapInArrow(_search, _PAIRS)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: the last one on the way along forms.

    ``forms`` is a stored table (word, form); each round doubles the way, and a form is at
    least twice as frequent as its word, so a few rounds do.
    """
    way = forms.select("word", F.col("form").alias("root"))
    while True:
        # No column names of the caller's are here, and the words are unique.
        further = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        way = stored(lookup(way, further, ["root"], "left", spread=["word"], materialised=True), "way")
        moved = way.filter("further is not null").count()
        way = way.select("word", F.coalesce("further", "root").alias("root"))
        if not moved:
            return way


def variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of (word, n), words being distinct.

    The form is the near word of largest n, the smallest of several, if it has at least
    ``ratio`` times the word's n; the root is where forms lead to.
    """
    words = stored(words.select("word", "n"), "vocabulary")
    near = (
        near_pairs(words, block)
        .groupBy("word")
        .agg(F.collect_set(F.struct((-F.col("near_n")).alias("less"), "near")).alias("near"))
        .select("word", F.size("near").cast("long").alias("n_near"), F.array_min("near").alias("best"))
    )
    fits = -F.col("best.less") >= ratio * F.col("n")
    # Written words take far less than their rows do, so a table of them is never broadcast by its size.
    judged = words.join(near.hint("merge"), "word", "left").select(
        "word",
        F.when(fits, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, -F.col("best.less")).alias("form_n"),
    )
    judged = stored(judged, "judged")
    ends = roots(judged.filter("form is not null").select("word", "form"))
    return judged.join(ends.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

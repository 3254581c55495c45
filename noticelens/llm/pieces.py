"""SentencePiece encoding and decoding of byte-pair models, by suffix-array matching.

Texts are cut where no piece can reach across (before white space, around characters
that no piece has). The distinct segments of a batch are concatenated and their suffixes
sorted to the depth of the longest piece; a binary search of every piece in that index
gives the range of its occurrences. The occurrences are edges; sorted by position they
are relaxed from left to right: an edge becomes the last piece of the text up to its end
if the pair of it and the last piece up to its start is its own encoding. That holds for
exactly one edge at each position, and the pieces found are those of the library, for
any order of scores: merges inside a segment never depend on what lies beyond a border
that no merge crosses. All edges that end as far into their segments are relaxed together;
a pair is judged by the merges that made its two pieces, step by step, and by what could
have been merged across their border meanwhile.

Characters without a piece become byte pieces. The ids of a segment are remembered by
the worker up to a bound. Tokenizers are read, never trained.

Defined cases: a null text is encoded as an empty one, which has no pieces; repeated
rows are encoded alike; other columns are not read; empty tables give empty results.
Decoding ids that are null or outside the vocabulary gives null or skips them, bytes that
are no UTF-8 become U+FFFD, and the sign U+2581 of a text comes back as a space.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelens.llm.common import Recent, kept, strings

SPACE = "▁"
# Bounds of a worker: remembered segments, characters indexed at once, segments of texts that
# wait for their ids, and slots for remembered pairs.
SEGMENTS, INDEXED, WAITING, SLOTS = 200_000, 800_000, 300_000, 1 << 20
# More than any piece id or code point offset; makes one key of two of them.
_CODES = 1 << 24


class Vocabulary:
    """The pieces of a model file."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        proto = ModelProto()
        proto.ParseFromString(model)
        kinds = {piece.type for piece in proto.pieces}
        if proto.trainer_spec.model_type != 2 or not kinds <= {1, 2, 3, 6} or 6 not in kinds:
            raise ValueError("a byte-pair model with byte fallback and no special pieces is needed")
        self.normalizer = SentencePieceProcessor(model_proto=model)
        self.pieces = [piece.piece for piece in proto.pieces]
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == 1}
        self.ids = {p.piece: n for n, p in enumerate(proto.pieces) if p.type == 1}
        self.byte_ids = {int(p.piece[1:-1], 16): n for n, p in enumerate(proto.pieces) if p.type == 6}
        self.bytes_of = [b""] * len(self.pieces)
        for piece, n in self.ids.items():
            self.bytes_of[n] = piece.replace(SPACE, " ").encode()
        for byte, n in self.byte_ids.items():
            self.bytes_of[n] = bytes([byte])
        self.drops_first_space = proto.normalizer_spec.add_dummy_prefix

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all pieces in a row, where those of each begin, and how many they are."""
        length = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        return np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8), np.cumsum(length) - length, length

    @cached_property
    def segment(self) -> re.Pattern:
        """Matches the segments that can be encoded on their own."""
        inner = any(SPACE in piece.lstrip(SPACE) for piece in self.ids)
        if inner:
            return re.compile("(?s).+")
        if any("\n" in piece for piece in self.ids):
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        return re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

    def merges(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """Plain byte-pair merging of a short text, best score first, then leftmost: its parts,
        and after each merge the score of it, the first and the last part."""
        parts, steps = list(text), []
        while len(parts) > 1:
            best, at = None, -1
            for n in range(len(parts) - 1):
                score = self.scores.get(parts[n] + parts[n + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, n
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            steps.append((best, parts[0], parts[-1]))
        return parts, steps

    def code(self, part: str) -> int:
        """The id of a piece; a character without one has a code beyond all ids."""
        return self.ids[part] if part in self.ids else len(self.pieces) + ord(part)

    @cached_property
    def reachable(self) -> tuple[list[str], np.ndarray]:
        """Pieces that are their own encoding, and their ids."""
        found = [p for p in self.ids if len(p) == 1 or self.merges(p)[0] == [p]]
        return found, np.array([self.ids[p] for p in found], dtype=np.int64)


class Pairs:
    """Judges whether two neighbouring pieces are the encoding of their text."""

    def __init__(self, words: Vocabulary):
        found, ids = words.reachable
        deep = max(map(len, found))
        self.size = len(words.pieces)
        # Of each piece before its n-th merge: that merge's score, its first and last part.
        self.score = np.full((self.size, deep), -np.inf)
        self.first = np.zeros((self.size, deep), dtype=np.int64)
        self.last = np.zeros((self.size, deep), dtype=np.int64)
        for piece, n in zip(found, ids.tolist()):
            self.first[n], self.last[n] = words.code(piece[0]), words.code(piece[-1])
            for step, (score, first, last) in enumerate(words.merges(piece)[1]):
                self.score[n, step] = score
                self.first[n, step + 1 :], self.last[n, step + 1 :] = words.code(first), words.code(last)
        ways = {-1: -np.inf}
        for piece, score in words.scores.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if all(len(part) == 1 or part in words.ids for part in (left, right)):
                    ways[words.code(left) * _CODES + words.code(right)] = score
        self.key = np.array(sorted(ways), dtype=np.int64)
        self.merged = np.array([ways[k] for k in self.key.tolist()])
        self.slots = np.full(SLOTS, -1, dtype=np.int64)
        self.known = np.zeros(SLOTS, dtype=bool)

    def stand(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * _CODES + right
        slot = ((key * 0x9E3779B97F4A7C1 >> 20) ^ key) % SLOTS
        good = self.known[slot]
        new = np.flatnonzero(self.slots[slot] != key)
        if len(new):
            _, at, back = np.unique(key[new], return_index=True, return_inverse=True)
            fresh = new[at]
            judged = self._judged(left[fresh], right[fresh])
            good[new] = judged[back]
            # Pairs may take the slot of another one; both arrays are set by the same one.
            self.slots[slot[fresh]] = key[fresh]
            mine = self.slots[slot[fresh]] == key[fresh]
            self.known[slot[fresh][mine]] = judged[mine]
        return good

    def _judged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Plays the merges of both pieces, best score first, then leftmost; the pair does not
        stand if a merge across the border comes first at any time."""
        good = np.ones(len(left), dtype=bool)
        # No piece has a character that has no piece itself.
        rest = np.flatnonzero((left < self.size) & (right < self.size))
        left, right = left[rest], right[rest]
        i, j = np.zeros(len(rest), dtype=np.int64), np.zeros(len(rest), dtype=np.int64)
        while len(rest):
            key = self.last[left, i] * _CODES + self.first[right, j]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            across = np.where(self.key[at] == key, self.merged[at], -np.inf)
            here, there = self.score[left, i], self.score[right, j]
            bad = (across > here) & (across >= there) & (across > -np.inf)
            good[rest[bad]] = False
            on = ~bad & ((here > -np.inf) | (there > -np.inf))
            rest, left, right, i, j, here, there = (x[on] for x in (rest, left, right, i, j, here, there))
            first = here >= there
            i, j = i + first, j + ~first
        return good


class PieceIndex:
    """Code points of all reachable pieces, ready to be searched in an index."""

    def __init__(self, words: Vocabulary):
        self.words = words
        found, self.ids = words.reachable
        self.lengths = np.array([len(p) for p in found], dtype=np.int64)
        self.depth = int(self.lengths.max())
        self.single = np.array([ord(p) for p in found if len(p) == 1], dtype=np.int64)
        self.points = np.zeros((len(found), self.depth), dtype=np.int64)
        for n, piece in enumerate(found):
            self.points[n, : len(piece)] = [ord(c) for c in piece]

    def occurrences(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece) of all occurrences of pieces in an array of code points.

        Code 0 separates segments and occurs in no piece.
        """
        alphabet = np.unique(text)
        bits = 8 if len(alphabet) < 255 else 16 if len(alphabet) < 65_535 else 21
        per = 63 // bits
        columns = -(-self.depth // per)
        code = np.searchsorted(alphabet, text) + 1
        padded = np.concatenate([code, np.zeros(columns * per, dtype=np.int64)])
        key = np.zeros(len(text) + (columns - 1) * per, dtype=np.int64)
        for n in range(per):
            key |= padded[n : n + len(key)] << (bits * (per - 1 - n))
        keys = [key[n * per : n * per + len(text)] for n in range(columns)]
        # Sorted by their first characters; where these are equal and all of one segment, by the
        # rest as well. No piece reaches beyond a segment, so others may stand in any order.
        suffixes = np.argsort(keys[0])
        ends = np.append(np.flatnonzero(text == 0), len(text))
        whole = ends[np.searchsorted(ends, suffixes)] - suffixes >= per
        same = np.diff(keys[0][suffixes]) == 0
        tied = np.flatnonzero((np.append(same, False) | np.append(False, same)) & whole)
        some = suffixes[tied]
        suffixes[tied] = some[np.lexsort([k[some] for k in keys[::-1]])]
        keys = [k[suffixes] for k in keys]

        at = np.searchsorted(alphabet, self.points)
        at[at == len(alphabet)] = 0
        here = (alphabet[at] == self.points) | (self.points == 0)
        usable = np.nonzero(here.all(axis=1))[0]
        wanted = np.zeros((len(usable), columns * per), dtype=np.int64)
        wanted[:, : self.depth] = np.where(self.points[usable] > 0, at[usable] + 1, 0)
        low = np.zeros(len(usable), dtype=np.int64)
        high = np.full(len(usable), len(text))
        for n in range(columns):
            # Pieces that end before these characters are found already.
            on = np.flatnonzero((wanted[:, n * per] > 0) & (low < high))
            part = wanted[on, n * per : (n + 1) * per]
            shifts = bits * np.arange(per - 1, -1, -1)
            least = (part << shifts).sum(axis=1)
            most = (np.where(part > 0, part, 2**bits - 1) << shifts).sum(axis=1)
            low[on], high[on] = (
                _searched(keys[n], low[on], high[on], least, False),
                _searched(keys[n], low[on], high[on], most, True),
            )
        counts = high - low
        first = np.repeat(low - np.concatenate([[0], counts.cumsum()[:-1]]), counts)
        return suffixes[first + np.arange(counts.sum())], np.repeat(usable, counts)


def _searched(values, low, high, wanted, after: bool) -> np.ndarray:
    """Binary search of each wanted value in its own sorted slice of ``values``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        found = values[np.minimum(middle, len(values) - 1)]
        right = open_ & ((found <= wanted) if after else (found < wanted))
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)


class Encoder:
    """Encodes texts; made once per Python worker."""

    def __init__(self, model: bytes):
        self.words = Vocabulary(model)
        self.index = PieceIndex(self.words)
        self.known = Recent()
        self.pairs = Pairs(self.words)

    def _relax(self, segments: list[str]) -> None:
        """Encode new segments and remember them."""
        size = len(self.words.pieces)
        points = np.frombuffer(
            ("\0".join(segments) + "\0").encode("utf-32-le"), dtype=np.uint32
        ).astype(np.int64)
        start, piece = self.index.occurrences(points)
        length, code = self.index.lengths[piece], self.index.ids[piece]
        # A character without a piece is an edge of its own.
        bare = np.nonzero(~np.isin(points, self.index.single) & (points > 0))[0]
        start = np.concatenate([start, bare])
        code = np.concatenate([code, size + points[bare]])
        end = start + np.concatenate([length, np.ones(len(bare), dtype=np.int64)])
        sizes = np.array([len(segment) for segment in segments])
        begin = np.cumsum(sizes + 1) - (sizes + 1)
        into = end - np.repeat(begin, sizes + 1)[start]
        order = np.argsort(into, kind="stable")
        start, end, code = start[order], end[order], code[order]
        cuts = np.searchsorted(into[order], np.arange(1, int(sizes.max(initial=0)) + 2))
        last = np.full(len(points) + 1, -1, dtype=np.int64)
        back = np.zeros(len(points) + 1, dtype=np.int64)
        first = np.zeros(len(points) + 1, dtype=bool)
        first[begin] = True
        for low, high in zip(cuts, cuts[1:]):
            origin, position, right = start[low:high], end[low:high], code[low:high]
            left = last[origin]
            good = first[origin]
            inner = np.flatnonzero(~good & (left >= 0))
            good[inner] = self.pairs.stand(left[inner], right[inner])
            last[position[good]], back[position[good]] = right[good], origin[good]
        # From the ends of all segments back to their beginnings, a piece of each at a time.
        at, active, steps = begin + sizes, np.flatnonzero(sizes), []
        while len(active):
            steps.append((active, last[at[active]]))
            at[active] = back[at[active]]
            active = active[at[active] > begin[active]]
        counts = np.zeros(len(segments), dtype=np.int64)
        for owners, _ in steps:
            counts[owners] += 1
        ends = np.cumsum(counts)
        ids = np.zeros(int(counts.sum()), dtype=np.int32)
        for n, (owners, codes) in enumerate(steps):
            ids[ends[owners] - 1 - n] = codes
        data, offsets = ids.tobytes(), (4 * ends).tolist()
        for segment, low, high in zip(segments, [0, *offsets], offsets):
            self.known[segment] = data[low:high]
        # Characters without a piece become bytes.
        for n in np.unique(np.searchsorted(ends, np.flatnonzero(ids >= size), side="right")).tolist():
            found = []
            for number in np.frombuffer(self.known[segments[n]], dtype=np.int32).tolist():
                found += [number] if number < size else [self.words.byte_ids[b] for b in chr(number - size).encode()]
            self.known[segments[n]] = array("i", found).tobytes()

    def _learn(self, segments: Iterable[str]) -> None:
        batch, size = [], 0
        for segment in segments:
            batch.append(segment)
            size += len(segment) + 1
            if size >= INDEXED:
                self._relax(batch)
                batch, size = [], 0
        if batch:
            self._relax(batch)

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of each text. New segments are gathered over many texts before indexing."""
        waiting, new, size, held = [], set(), 0, 0
        for text in texts:
            # The separator cannot be indexed, so a NUL is a segment of its own.
            parts = self._segments(text)
            waiting.append(parts)
            held += len(parts) + 1
            for part in self.known.unknown(parts).difference(new):
                new.add(part)
                size += len(part)
            if size >= INDEXED or held >= WAITING:
                yield from self._answers(waiting, new)
                waiting, new, size, held = [], set(), 0, 0
        yield from self._answers(waiting, new)

    def _segments(self, text: str) -> list[str]:
        parts = []
        for n, piece in enumerate(self.words.normalizer.normalize(text).split("\0")):
            if n:
                parts.append("\0")
            parts.extend(self.words.segment.findall(piece))
        return parts

    def _answers(self, waiting: list[list[str]], new: set[str]) -> Iterator[np.ndarray]:
        if "\0" in new:
            new.remove("\0")
            self.known["\0"] = np.array([self.words.byte_ids[0]], dtype=np.int32).tobytes()
        self._learn(new)
        for parts in waiting:
            yield np.frombuffer(b"".join(map(self.known.__getitem__, parts)), dtype=np.int32)
        self.known.turn(SEGMENTS)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(
    docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, pieces) with the ids of every whole text.

    ``model`` is a model file, a fixed size whatever the corpus; it is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast({"source": model})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(sent.value, Encoder)
        for batch in batches:
            ids, done = [], 0
            size = 0
            for found in encoder.encode(strings(batch.column(1))):
                ids.append(found)
                size += len(found)
                if size >= 2_000_000:
                    yield _batch(batch.column(0).slice(done, len(ids)), ids)
                    done, ids, size = done + len(ids), [], 0
            if ids:
                yield _batch(batch.column(0).slice(done, len(ids)), ids)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, pieces array<int>").withColumnRenamed("id", id_col)


def _batch(keys: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.cumsum([0, *(len(i) for i in ids)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
    return pa.RecordBatch.from_arrays([keys, lists], names=["id", "pieces"])


def _decoded(words: Vocabulary, ids: np.ndarray) -> str:
    size = len(words.bytes_of)
    if len(ids) and not (ids.min() >= 0 and ids.max() < size):
        ids = ids[(ids >= 0) & (ids < size)]
    flat, first, length = words.table
    sizes = length[ids]
    ends = np.cumsum(sizes)
    data = flat[np.repeat(first[ids] - (ends - sizes), sizes) + np.arange(sizes.sum())].tobytes()
    if words.drops_first_space and data[:1] == b" ":
        data = data[1:]
    return data.decode("utf-8", "replace")


def decode(
    rows: DataFrame, model: bytes, id_col: str = "doc_id", pieces_col: str = "pieces"
) -> DataFrame:
    """(id, text) of encoded rows."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(sent.value)
        for batch in batches:
            texts = [
                _decoded(words, ids.values.to_numpy(zero_copy_only=False)) if ids.is_valid else None
                for ids in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["id", "text"]
            )

    chosen = rows.select(F.col(id_col).alias("id"), F.col(pieces_col).alias("pieces"))
    id_type = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"id {id_type}, text string").withColumnRenamed("id", id_col)


def round_trip(
    docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_pieces, pieces_crc32, n_chars, text_crc32): a digest of the ids of every text,
    and of the text decoded from them.

    The checksums are of the ids as little-endian 32-bit integers and of UTF-8.
    """
    sent = docs.sparkSession.sparkContext.broadcast({"source": model})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(sent.value, Encoder)
        for batch in batches:
            rows = []
            for ids in encoder.encode(strings(batch.column(1))):
                text = _decoded(encoder.words, ids)
                rows.append((len(ids), zlib.crc32(ids.tobytes()), len(text), zlib.crc32(text.encode())))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)],
                names=["id", "n_pieces", "pieces_crc32", "n_chars", "text_crc32"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, n_pieces long, pieces_crc32 long, n_chars long, text_crc32 long"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)

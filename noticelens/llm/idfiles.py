"""Token ids in binary files: frequency ranks in byte-aligned variable-length coding.

Documents are put in id order by ranges. Every range (shard) is tokenized in blocks; the
ids of the whole corpus are counted, and an id is written as its rank by frequency, so
that the common ones take one byte. A block holds, apart from each other, two control
bits for the length of each rank and the bytes of the ranks; it is decoded by looking the
control bytes up in a table of lengths, with numpy.

A block of a file, little-endian throughout:

    4 bytes  "FRQ1"
    u64      ids of all documents before it
    u32 x 4  documents d, ids n, control bytes c, data bytes b
    d x i64  document ids, d x u8 whether each is there, d x u32 ids of each
    c        2 bits an id, from the low ones up: bytes of its rank less 1
    b        ranks, low byte first
    1        line feed

Blocks are written by Spark's text sink as lines of bytes, so any file system will do, one
folder a shard, and read as whole binary files; the line feed is the sink's. ``ranks`` next
to them holds the ids in rank order in the same coding, with itself as the rank.

Defined cases: a null text is empty and gets the end id only; equal ids are ordered by a
hash of the text, null ids come first; other columns are not read; an empty table gives
no files and an empty result. Strings of special tokens are those tokens, as the library
has it.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from noticelens.llm.common import kept, stored
from noticelens.session import lookup, shared_path

SHARD_BYTES = 16 << 20
BLOCK_IDS = 500_000
# Bounds of the words whose ids a worker remembers, of so many bytes in the mean, and of the
# bytes of text that are encoded together.
SEGMENTS, KEY_BYTES, CALL = 800_000, 64, 4 << 20

_MAGIC = b"FRQ1"
_HEAD = "<4sQIIII"
# Bytes of the four ranks of each control byte.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1).astype(np.uint8)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks below 2**32."""
    ranks = ranks.astype(np.uint32)
    length = np.ones(len(ranks), dtype=np.uint8)
    most = int(ranks.max(initial=0))
    for bound in (0xFF, 0xFFFF, 0xFFFFFF):
        if most > bound:
            length += ranks > bound
    codes = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    codes[: len(ranks)] = length - 1
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    ends = np.cumsum(length, dtype=np.int64)
    data = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    first = ends - length
    data[first] = ranks.astype(np.uint8)
    for byte in range(1, int(length.max(initial=0))):
        has = np.flatnonzero(length > byte)
        data[first[has] + byte] = (ranks[has] >> (8 * byte)).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ranks of control and data bytes."""
    length = _LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:count]
    first = np.cumsum(length, dtype=np.int64) - length
    values = np.frombuffer(data, dtype=np.uint8)
    ranks = values[first].astype(np.int64)
    for byte in range(1, int(length.max(initial=0))):
        has = np.flatnonzero(length > byte)
        ranks[has] |= values[first[has] + byte].astype(np.int64) << (8 * byte)
    return ranks


def _grouped(texts: Iterable[pa.Array], size: int) -> Iterator[pa.Array]:
    """The texts in arrays, each closed as soon as it has ``size`` bytes; null is empty."""
    group, held = [], 0
    for column in texts:
        column = column.cast(pa.large_string()).fill_null("")
        # One more a text, so that empty texts do not gather without end.
        ends, first = np.cumsum(_values(pc.binary_length(column)) + 1), 0
        while first < len(column):
            before = int(ends[first - 1]) if first else 0
            end = int(np.searchsorted(ends, before + size - held)) + 1
            group.append(column.slice(first, end - first))
            held += int(ends[min(end, len(column)) - 1]) - before
            first = end
            if held >= size:
                yield pa.concat_arrays(group)
                group, held = [], 0
    if group:
        yield pa.concat_arrays(group)


def _runs(values: np.ndarray, lengths: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Picked runs of those that lie one after the other in ``values``, and the length of each."""
    n = lengths[picked]
    index = np.repeat((np.cumsum(lengths) - lengths)[picked] - (np.cumsum(n) - n), n)
    index += np.arange(len(index))
    return values[index], n


def _values(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


class Remembered:
    """Ids of keys, of the new ones by ``encode``; begun anew when it has grown too large."""

    def __init__(self, encode: Callable[[Iterable[str]], Iterator[bytes]]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.keys = pa.array([], pa.large_string())
        self.ids, self.lengths = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)

    def find(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of ids, their lengths, and the run of each of the distinct ``keys``."""
        if self.keys.nbytes + self.ids.nbytes >= KEY_BYTES * SEGMENTS:
            self.clear()
        run = pc.index_in(keys, value_set=self.keys)
        new = keys.filter(run.is_null())
        run = _values(run.fill_null(-1)).astype(np.int64)
        run[run < 0] = len(self.keys) + np.arange(len(new))
        if len(new):
            found = list(self.encode(_values(new).tolist()))
            self.keys = pa.concat_arrays([self.keys, new])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), dtype=np.uint32)])
            self.lengths = np.concatenate([self.lengths, np.fromiter(map(len, found), np.int64, len(found)) // 4])
        return self.ids, self.lengths, run


class TextEncoder:
    """Ids of texts by a byte-level tokenizer, equal parts encoded once.

    Its pattern always cuts before a single space between two characters that are no white
    space, so the parts between such spaces are encoded on their own. Arrow finds the distinct
    ones among some megabytes of text. Those of printable ASCII and Latin letters are cut
    further by the same pattern here, all in one go, and only new words reach the tokenizer's
    model; other parts go through its own pattern. Ids of words are put together to those of
    parts and texts as arrays.
    """

    _cut = re.compile(r"(?<=\S) (?=\S)")
    # White space at an end or beside another; the characters are those of \s in a str pattern.
    _white = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    _wide = rf"^{_white}|{_white}\z|{_white}{{2}}"
    # Without a line feed at an end: in a row of parts it would stand beside the next space.
    _plain = r"^[!-~\x{c0}-\x{24f}]([\n!-~\x{c0}-\x{24f}]*[!-~\x{c0}-\x{24f}])?\z"
    # Fixed value: the pattern of the tokenizer, for those characters.
    _words = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        bare = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        plain = map(chr, [*b"\n ", *range(0x21, 0x7F), *range(0xC0, 0x250)])
        self.letters = {ord(c): bare.pre_tokenize_str(c)[0][0] for c in plain}
        self.words, self.odd = Remembered(self._by_model), Remembered(self._by_library)

    def _by_model(self, words: list[str]) -> Iterator[bytes]:
        for word in "\0".join(words).translate(self.letters).split("\0"):
            yield array("I", [token.id for token in self.model.tokenize(word)]).tobytes()

    def _by_library(self, parts: list[str]) -> Iterator[bytes]:
        for some in _grouped([pa.array(parts, pa.large_string())], CALL // 32):
            for found in self.tokenizer.encode_batch_fast(_values(some).tolist(), add_special_tokens=False):
                yield array("I", found.ids).tobytes()

    def _parts(self, texts: pa.Array, wide: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Parts of the texts and how many each has, first those of texts that are not ``wide``."""
        found = pc.split_pattern(texts.filter(pc.invert(wide)), " ")
        parts, counts = found.flatten(), _values(pc.list_value_length(found))
        cut = [self._cut.split(text) for text in _values(texts.filter(wide))]
        if not cut:
            return parts, counts
        parts = pa.concat_arrays([parts, pa.array(chain.from_iterable(cut), pa.large_string())])
        return parts, np.concatenate([counts, np.fromiter(map(len, cut), np.int64, len(cut))])

    def _part_ids(self, spaced: pa.Array, heads: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of ids, their lengths, and the run of each part: ``spaced`` ones, which have a
        space in front, then ``heads``."""
        plain = [
            pc.and_not(pc.match_substring_regex(parts, self._plain), pc.match_substring(parts, "<|"))
            for parts in (spaced, heads)
        ]
        row = spaced.filter(plain[0])
        row = pc.binary_join(pa.ListArray.from_arrays([0, len(row)], row), pa.scalar(" ", row.type))[0].as_py()
        words = self._words.findall(" " + row) if row else []
        cut = [self._words.findall(head) for head in _values(heads.filter(plain[1]))]
        coded = pa.array([*words, *chain.from_iterable(cut)], pa.large_string()).dictionary_encode()
        codes = _values(coded.indices)
        ids, lengths, run = self.words.find(coded.dictionary)
        ids, n = _runs(ids, lengths, run[codes])
        # A plain part has no space, so that in a row of them each space begins a part.
        begins = _values(pc.starts_with(coded.dictionary, " "))[codes[: len(words)]]
        begins = np.concatenate([np.flatnonzero(begins), len(words) + np.cumsum([0, *map(len, cut)])])
        lengths = np.diff(np.concatenate([[0], np.cumsum(n)])[begins])
        odd = [" " + part for part in _values(spaced.filter(pc.invert(plain[0])))]
        odd += _values(heads.filter(pc.invert(plain[1]))).tolist()
        coded = pa.array(odd, pa.large_string()).dictionary_encode()
        more, n, found = self.odd.find(coded.dictionary)
        plain = np.concatenate([_values(flags) for flags in plain])
        run = np.cumsum(plain) - 1
        run[~plain] = len(lengths) + found[_values(coded.indices)]
        return np.concatenate([ids, more]), np.concatenate([lengths, n]), run

    def _encoded(self, texts: pa.Array) -> Iterator[bytes]:
        wide = pc.match_substring_regex(texts, self._wide)
        parts, counts = self._parts(texts, wide)
        coded = parts.dictionary_encode()
        codes, ends = _values(coded.indices), np.cumsum(counts)
        later = np.ones(len(codes), dtype=bool)
        later[ends - counts] = False
        # A part at the start of a text has no space in front, which makes other ids.
        used = np.zeros((2, len(coded.dictionary)), dtype=bool)
        used[0, codes[later]] = used[1, codes[~later]] = True
        ids, lengths, run = self._part_ids(*(coded.dictionary.filter(pa.array(which)) for which in used))
        place = np.cumsum(used.reshape(-1)) - 1
        ids, n = _runs(ids, lengths, run[place[np.where(later, codes, codes + used.shape[1])]])
        ends = np.cumsum(n)[ends - 1]
        bounds = np.empty((len(texts), 2), dtype=np.int64)
        bounds[np.argsort(_values(wide), kind="stable")] = np.stack([np.concatenate([[0], ends[:-1]]), ends], axis=1)
        for first, end in bounds.tolist():
            yield ids[first:end].tobytes()

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text as 32-bit integers."""
        texts = iter(texts)
        return self.encode_columns(pa.array(some, pa.large_string()) for some in iter(lambda: list(islice(texts, 256)), []))

    def encode_columns(self, columns: Iterable[pa.Array]) -> Iterator[bytes]:
        """Ids of each text of some Arrow columns, as 32-bit integers; null is empty."""
        for some in _grouped(columns, CALL):
            yield from self._encoded(some)


def _tokenized(docs: DataFrame, tokenizer_json: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Blocks of documents in id order: (shard, block, first, n, docs, counts, ids).

    ``first`` counts the ids of the shard before the block; ``ids`` is compressed.
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    rows = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .repartitionByRange(shards, "id")
        .sortWithinPartitions("id", F.xxhash64("text"))
    )
    sent = docs.sparkSession.sparkContext.broadcast({"source": tokenizer_json})
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        encoder, shard = kept(sent.value, TextEncoder), TaskContext.get().partitionId()
        block, first, size = 0, 0, 0
        keys, counts, data = [], [], []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "shard": shard,
                        "block": block,
                        "first": first,
                        "n": size,
                        "docs": keys,
                        "counts": counts,
                        "ids": squeeze(b"".join(data)),
                    }
                ],
                schema=arrow,
            )

        waiting = deque()

        def texts() -> Iterator[pa.Array]:
            for batch in batches:
                waiting.extend(batch.column(0).to_pylist())
                yield batch.column(1)

        for ids in encoder.encode_columns(texts()):
            keys.append(waiting.popleft())
            counts.append(len(ids) // 4 + 1)
            data.append(ids + end)
            size += counts[-1]
            if size >= BLOCK_IDS:
                yield packed()
                block, first, size = block + 1, first + size, 0
                keys, counts, data = [], [], []
        if keys:
            yield packed()

    arrow = pa.schema(
        [
            ("shard", pa.int32()),
            ("block", pa.int32()),
            ("first", pa.int64()),
            ("n", pa.int64()),
            ("docs", pa.list_(pa.int64())),
            ("counts", pa.list_(pa.int32())),
            ("ids", pa.binary()),
        ]
    )
    schema = "shard int, block int, first long, n long, docs array<long>, counts array<int>, ids binary"
    return rows.mapInArrow(run, schema)


def _unsqueezed(ids: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(ids), dtype=np.uint32)


def _ranked(blocks: DataFrame) -> np.ndarray:
    """Ids by falling frequency in the corpus, then by id; at most the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                counts = np.bincount(_unsqueezed(ids))
                if len(counts) > len(total):
                    total, counts = counts, total
                total[: len(counts)] += counts
        used = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    rows = blocks.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = rows.toPandas().sort_values(["n", "id"], ascending=[False, True])
    return found["id"].to_numpy(np.int64)


def _shard_starts(blocks: DataFrame) -> DataFrame:
    """(shard, start): ids of all shards before. Sums run inside groups of shards and over
    the groups, so no task sees all shards."""
    totals = blocks.groupBy("shard").agg(F.sum("n").alias("n"))
    totals = totals.withColumn("_group", F.floor(F.col("shard") / 1024).cast("int"))
    groups = sorted(totals.groupBy("_group").agg(F.sum("n")).collect())
    before, starts = 0, [(-1, 0)]
    for group, n in groups:
        starts.append((group, before))
        before += n
    bases = totals.sparkSession.createDataFrame(starts, "_group int, _base long")
    inside = Window.partitionBy("_group").orderBy("shard")
    so_far = F.sum("n").over(inside) - F.col("n")
    return totals.withColumn("_in", so_far).join(F.broadcast(bases), "_group").select(
        "shard", (F.col("_base") + F.col("_in")).alias("start")
    )


def _block_bytes(start: int, keys: list, counts: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    there = np.array([k is not None for k in keys], dtype=np.uint8)
    ids = np.array([k or 0 for k in keys], dtype="<i8")
    head = struct.pack(_HEAD, _MAGIC, start, len(keys), len(ranks), len(control), len(data))
    return b"".join([head, ids.tobytes(), there.tobytes(), counts.astype("<u4").tobytes(), control, data])


def _parsed(content: memoryview) -> Iterator[tuple[int, list, np.ndarray, np.ndarray]]:
    """(start, document ids, ids of each, ranks) of each block of a file."""
    at = 0
    while at < len(content):
        magic, start, docs, n, controls, size = struct.unpack_from(_HEAD, content, at)
        if magic != _MAGIC:
            raise ValueError("not a block of token ids")
        at += struct.calcsize(_HEAD)
        parts = []
        for length in (8 * docs, docs, 4 * docs, controls, size):
            parts.append(content[at : at + length])
            at += length
        at += 1  # the line feed
        keys = np.frombuffer(parts[0], dtype="<i8").tolist()
        keys = [k if there else None for k, there in zip(keys, parts[1].tobytes())]
        yield start, keys, np.frombuffer(parts[2], dtype="<u4"), unpack(parts[3], parts[4], n)


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer_json: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every whole text, append ``end_id``, and write the files under ``path``.

    The tokenizer and the rank table have the size of the vocabulary; they are broadcast.
    """
    spark = docs.sparkSession
    blocks = stored(_tokenized(docs, tokenizer_json, end_id, id_col, text_col), "blocks")
    ids = _ranked(blocks)
    place = np.zeros(int(ids.max(initial=0)) + 1, dtype=np.int64)
    place[ids] = np.arange(len(ids))
    sent = spark.sparkContext.broadcast(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ranks = sent.value[_unsqueezed(row["ids"])]
                content = _block_bytes(row["start"], row["docs"], np.array(row["counts"]), ranks)
                yield pa.RecordBatch.from_pylist(
                    [{"shard": f"{row['shard']:08d}", "block": row["block"], "content": content}],
                    schema=pa.schema([("shard", pa.string()), ("block", pa.int32()), ("content", pa.binary())]),
                )

    placed = lookup(blocks, _shard_starts(blocks), ["shard"], spread=["block"]).select(
        "shard", "block", (F.col("start") + F.col("first")).alias("start"), "docs", "counts", "ids"
    )
    lines = placed.mapInArrow(run, "shard string, block int, content binary")
    (
        lines.sortWithinPartitions("shard", "block")
        .select("shard", F.col("content").cast("string").alias("value"))
        .write.partitionBy("shard")
        .text(f"{path}/ids")
    )
    ranks = _block_bytes(0, [0], np.array([len(ids)]), ids)
    table = spark.createDataFrame([(bytearray(ranks),)], "content binary")
    table.select(F.col("content").cast("string")).coalesce(1).write.text(f"{path}/ranks")


def read_ids(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files alone.

    The checksum is of the ids as little-endian unsigned 32-bit integers.
    """
    schema = f"{id_col} long, start long, n_tokens long, ids_crc32 long"
    ranks = spark.read.format("binaryFile").load(f"{path}/ranks/*.txt").select("content").collect()
    (table,) = [found for row in ranks for *_, found in _parsed(memoryview(row.content))]
    if not len(table):
        return spark.createDataFrame([], schema)
    sent = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for start, keys, counts, ranks in _parsed(memoryview(content.as_buffer())):
                    data = memoryview(sent.value[ranks].astype("<u4").tobytes())
                    ends = np.cumsum(counts, dtype=np.int64)
                    firsts = ends - counts
                    sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(firsts.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys, pa.int64()),
                            pa.array(start + firsts),
                            pa.array(counts.astype(np.int64)),
                            pa.array(sums, pa.int64()),
                        ],
                        names=[id_col, "start", "n_tokens", "ids_crc32"],
                    )

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/ids")
    return files.select("content").mapInArrow(run, schema)


def written_path(spark: SparkSession) -> str:
    """A fresh folder for files that are read back at once."""
    return shared_path(spark, "token-ids")

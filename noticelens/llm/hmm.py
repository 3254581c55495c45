"""Hidden Markov language model, trained by Baum-Welch over all training texts.

Every word belongs to a class: the most frequent ones are classes of their own, the others
share the class of their ending, and the end of a text is one. Latent states emit classes,
classes emit words:

    P(text) = sum over state paths of  prod  A[z, z'] E[z', class(w)]  x  prod P(w | class(w))

The second product does not depend on the path. P(w | class) is (c + 0.5) over the
class's (tokens + 0.5 (words + 1)) in training; the word counts are those of all training
texts and grow with them, while the matrices A and E keep a fixed size.

1. Each task numbers the words of a chunk of texts, writes the texts as numbers and the
   distinct words with their training counts. The counts are summed over the chunks.
2. Counts and classes go back to the chunks through their distinct words, so no table has
   a row for every token; texts become class numbers, base scores are summed.
3. Expected counts of Baum-Welch are added up in each task by scaled forward and backward
   recursions, then across tasks. The states start from documents grouped by their most
   frequent known word.
4. The scaled forward recursion gives the likelihood of every text.

Words are the runs without the six ASCII white space characters, A-Z lower-cased.
Defined cases: null and empty texts are the end token alone; a null id counts as an empty
text in the split and is scored like any other; repeated rows count and are scored each;
without training texts the model is uniform; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelens.llm.common import stored, strings, utf8

STATES, ROUNDS = 8, 5
# Classes: at most so many words of their own, so many endings, and the end of a text.
OWN, ENDINGS, ENDING = 4_096, 4_096, 4
END = OWN + ENDINGS
CLASSES = END + 1
# Weight of the words' overall distribution in that of a state, in tokens.
PRIOR = 50.0
CHUNK_BYTES, CELLS = 32 << 20, 600_000


class Numbers(dict):
    """word -> number in the order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def numbered(docs: DataFrame, id_col: str, text_col: str, held_out) -> DataFrame:
    """Texts as numbers and words by chunk, told apart by ``kind``.

    texts: (chunk, ids, held, sizes, data); words: (chunk, number, word, n), n the count in
    training texts.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out.alias("held")
    )
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        chunk = TaskContext.get().partitionId() << 32

        def written(keys: list, held: list, texts: list[np.ndarray], numbers: Numbers):
            sizes = [len(t) for t in texts]
            data = np.concatenate(texts) if texts else np.zeros(0, dtype=np.int32)
            training = data[np.repeat(~np.array(held, dtype=bool), sizes)]
            counts = np.bincount(training, minlength=len(numbers))
            one = {
                "kind": pa.array(["texts"]),
                "chunk": pa.array([chunk], pa.int64()),
                "ids": pa.array([pa.concat_arrays(keys).to_pylist()], pa.list_(keys[0].type)),
                "held": pa.array([held], pa.list_(pa.bool_())),
                "sizes": pa.array([sizes], pa.list_(pa.int32())),
                "data": pa.array([squeeze(data.tobytes())], pa.binary()),
            }
            none = pa.nulls(1)
            yield pa.RecordBatch.from_arrays(
                [
                    *one.values(),
                    none.cast(pa.int32()),
                    none.cast(pa.binary()),
                    none.cast(pa.int64()),
                ],
                names=[*one, "number", "word", "n"],
            )
            size, words = len(numbers), list(numbers)
            for a in range(0, size, 50_000):
                b = min(a + 50_000, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(["words"] * (b - a)),
                        pa.array(np.full(b - a, chunk, dtype=np.int64)),
                        *(pa.nulls(b - a, one[c].type) for c in ("ids", "held", "sizes", "data")),
                        pa.array(np.arange(a, b, dtype=np.int32)),
                        pa.array(words[a:b], pa.binary()),
                        pa.array(counts[a:b].astype(np.int64)),
                    ],
                    names=[*one, "number", "word", "n"],
                )

        keys, held, texts, numbers, size = [], [], [], Numbers(), 0
        for batch in batches:
            first = 0
            marks = batch.column(2).to_pylist()
            for n, text in enumerate(strings(batch.column(1)), 1):
                data = utf8(text)
                words = data.lower().split()
                texts.append(
                    np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words))
                )
                size += len(data) + 1
                if size >= CHUNK_BYTES or n == batch.num_rows:
                    keys.append(batch.column(0).slice(first, n - first))
                    held.extend(marks[first:n])
                    first = n
                if size >= CHUNK_BYTES:
                    yield from written(keys, held, texts, numbers)
                    chunk += 1
                    keys, held, texts, numbers, size = [], [], [], Numbers(), 0
        if texts:
            yield from written(keys, held, texts, numbers)

    schema = (
        f"kind string, chunk long, ids array<{id_type}>, held array<boolean>, sizes array<int>, "
        "data binary, number int, word binary, n long"
    )
    return rows.mapInArrow(run, schema)


@dataclass(frozen=True)
class Counts:
    """Totals of the training texts; bounded by the number of classes."""

    tokens: int
    words: int
    ends: int
    own: dict[bytes, tuple[int, int]]
    class_tokens: np.ndarray
    class_words: np.ndarray


def _ending():
    """Class of a word by its last bytes."""
    return (F.crc32(F.substring("word", -ENDING, ENDING)) % ENDINGS + OWN).cast("int")


def count_classes(vocabulary: DataFrame, ends: int) -> Counts:
    """Words that become classes of their own, and totals by class.

    The least count of such a word is read off a histogram on a fine scale, so at most
    ``OWN`` words and ``ENDINGS`` sums reach the driver.
    """
    seen = vocabulary.filter("c > 0")
    level = F.floor(F.log2("c") * 64)
    levels = sorted(seen.groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    least, total = None, 0
    for row in levels:
        total += row.n
        if total > OWN:
            break
        least = row.l
    own_rows = seen.filter(level >= least).collect() if least is not None else []
    ranked = sorted(own_rows, key=lambda r: (-r.c, bytes(r.word)))
    own = {bytes(r.word): (n, r.c) for n, r in enumerate(ranked)}
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for number, c in own.values():
        class_tokens[number], class_words[number] = c, 1
    rest = seen.filter(level < least) if least is not None else seen
    for row in rest.groupBy(_ending().alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        class_tokens[row.k], class_words[row.k] = row.c, row.n
    class_tokens[END], class_words[END] = ends, ends > 0
    return Counts(
        int(class_tokens.sum()), int(class_words.sum()), ends, own, class_tokens, class_words
    )


def coded(texts: DataFrame, words: DataFrame, vocabulary: DataFrame, counts: Counts) -> DataFrame:
    """(id, held, n_tokens, n_known, base_score, inner, classes) of every text.

    ``inner`` is the part of the score that lies inside the classes.
    """
    spark = texts.sparkSession
    own = spark.createDataFrame(
        [(bytearray(w), n, c) for w, (n, c) in counts.own.items()], "word binary, class int, c long"
    )
    common = words.join(F.broadcast(own), "word").select("part", "number", "class", "c")
    rare = (
        words.join(F.broadcast(own.select("word")), "word", "left_anti")
        .join(vocabulary, "word")
        .select("part", "number", _ending().alias("class"), "c")
    )
    id_type = texts.schema["ids"].dataType.elementType.simpleString()
    sent = spark.sparkContext.broadcast(
        (counts.tokens, counts.words, counts.ends, counts.class_tokens, counts.class_words)
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        tokens, distinct, ends, class_tokens, class_words = sent.value
        squeeze = zstandard.ZstdCompressor(level=1).compress
        number = right.column("number").to_numpy()
        klass = np.zeros(len(number), dtype=np.int64)
        count = np.zeros(len(number))
        klass[number] = right.column("class").to_numpy()
        count[number] = right.column("c").to_numpy()
        plain = np.log10(count + 0.5)
        inside = plain - np.log10(class_tokens + 0.5 * (class_words + 1))[klass]
        inside[klass < OWN] = 0
        total = np.log10(tokens + 0.5 * (distinct + 1))
        out = []
        for row in left.select(["ids", "held", "sizes", "data"]).to_pylist():
            data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"]), dtype=np.int32)
            at = 0
            for key, held, size in zip(row["ids"], row["held"], row["sizes"]):
                text = data[at : at + size]
                at += size
                classes = np.append(klass[text], END).astype(np.uint16)
                out.append(
                    (
                        key,
                        held,
                        size + 1,
                        int((count[text] > 0).sum()) + (ends > 0),
                        float(plain[text].sum() + np.log10(ends + 0.5) - (size + 1) * total),
                        float(inside[text].sum()),
                        squeeze(classes.tobytes()),
                    )
                )
        columns = list(zip(*out)) or [()] * len(arrow)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    key_type = pa.schema([("x", _arrow_type(texts))]).field(0).type
    arrow = pa.schema(
        [
            ("id", key_type),
            ("held", pa.bool_()),
            ("n_tokens", pa.int64()),
            ("n_known", pa.int64()),
            ("base_score", pa.float64()),
            ("inner", pa.float64()),
            ("classes", pa.binary()),
        ]
    )
    schema = (
        f"id {id_type}, held boolean, n_tokens long, n_known long, base_score double, inner double, "
        "classes binary"
    )
    return (
        texts.groupBy("chunk")
        .cogroup(common.unionByName(rare).groupBy("part"))
        .applyInArrow(run, schema)
    )


def _arrow_type(texts: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(texts.schema["ids"].dataType.elementType)


@dataclass(frozen=True)
class Model:
    """Start, transition (from, to) and emission (class, state) probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def batches_of(texts: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Numbers of the texts, longest first, cut so that a batch has at most CELLS tokens."""
    order = np.argsort([-len(t) for t in texts], kind="stable")
    part, size = [], 0
    for n in order.tolist():
        part.append(n)
        size += len(texts[n])
        if size >= CELLS:
            yield np.array(part)
            part, size = [], 0
    if part:
        yield np.array(part)


def _by_step(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens ordered by position, then text, and the number of texts at each position.

    The texts come longest first, so those that reach a position are the first ones.
    """
    lengths = np.array([len(t) for t in texts])
    width = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    position = np.concatenate([np.arange(n) for n in lengths])
    which = np.repeat(np.arange(len(texts)), lengths)
    flat = np.concatenate(texts)
    return flat[np.lexsort((which, position))].astype(np.int64), width


def forward(model: Model, texts: list[np.ndarray], keep: bool) -> tuple:
    """Natural log likelihoods by the scaled forward recursion; with ``keep`` also the
    scaled forward probabilities and scales of every token, and the layout."""
    flat, width = _by_step(texts)
    starts = np.concatenate([[0], np.cumsum(width)])
    emitted = model.emit[flat]
    alphas = np.empty_like(emitted) if keep else None
    scales = np.empty(len(flat))
    alpha = np.broadcast_to(model.start, (len(texts), len(model.start)))
    for t, n in enumerate(width.tolist()):
        a, b = starts[t], starts[t + 1]
        alpha = (alpha[:n] @ model.move if t else alpha) * emitted[a:b]
        scale = alpha.sum(1)
        alpha = alpha / scale[:, None]
        scales[a:b] = scale
        if keep:
            alphas[a:b] = alpha
    which = np.arange(len(flat)) - np.repeat(starts[:-1], width)
    likelihood = np.bincount(which, np.log(scales), len(texts))
    return likelihood, flat, width, starts, emitted, alphas, scales


def expected(model: Model, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts of starts, moves and emissions, and the log likelihood."""
    likelihood, flat, width, starts, emitted, alphas, scales = forward(model, texts, True)
    states = len(model.start)
    moves = np.zeros((states, states))
    emitted /= scales[:, None]
    gamma = alphas
    after = None
    for t in range(len(width) - 1, -1, -1):
        n = width[t]
        beta = np.ones((n, states))
        if after is not None:
            beta[: len(after)] = after @ model.move.T
            moves += alphas[starts[t] : starts[t] + len(after)].T @ after
        part = slice(starts[t], starts[t + 1])
        after = emitted[part] * beta
        gamma[part] = alphas[part] * beta
    emissions = np.stack([np.bincount(flat, gamma[:, k], CLASSES) for k in range(states)], axis=1)
    return gamma[: width[0]].sum(0), moves * model.move, emissions, float(likelihood.sum())


def reestimated(starts: np.ndarray, moves: np.ndarray, emissions: np.ndarray, overall: np.ndarray) -> Model:
    """Probabilities from counts; every state leans on the overall distribution."""
    start = (starts + 0.1) / (starts + 0.1).sum()
    move = (moves + 0.1) / (moves + 0.1).sum(1, keepdims=True)
    emit = (emissions + PRIOR * overall[:, None]) / (emissions.sum(0) + PRIOR)
    return Model(start, move, emit)


def _decoded(blob: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint16)


def _summed(rows: DataFrame, states: int) -> dict[str, np.ndarray]:
    """Counts (kind, at, s0 ...) of all tasks added up; their number is that of the classes."""
    names = [f"s{k}" for k in range(states)]
    total = rows.groupBy("kind", "at").agg(*[F.sum(s).alias(s) for s in names]).collect()
    size = {"start": 1, "move": states, "emit": CLASSES, "likelihood": 1}
    out = {kind: np.zeros((n, states)) for kind, n in size.items()}
    for row in total:
        out[row.kind][row.at] = [row[s] for s in names]
    return out


def _count_rows(kinds: dict[str, np.ndarray], states: int) -> pa.RecordBatch:
    kind = [k for k, v in kinds.items() for _ in range(len(v))]
    at = np.concatenate([np.arange(len(v)) for v in kinds.values()]).astype(np.int32)
    values = np.concatenate(list(kinds.values()))
    return pa.RecordBatch.from_arrays(
        [pa.array(kind), pa.array(at), *(pa.array(values[:, k]) for k in range(states))],
        names=["kind", "at", *(f"s{k}" for k in range(states))],
    )


def train(texts: DataFrame, counts: Counts, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over (held, classes) rows; each round is one pass over the training texts."""
    overall = (counts.class_tokens + 0.5) / (counts.tokens + 0.5 * CLASSES)
    training = texts.filter(~F.col("held")).select("classes")
    schema = "kind string, at int, " + ", ".join(f"s{k} double" for k in range(states))

    def favourites(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter()
        for batch in batches:
            found.update(_favourite(_decoded(b.as_py())) for b in batch.column(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], names=["at", "n"]
        )

    ranked = sorted(
        training.mapInArrow(favourites, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect(),
        key=lambda r: (-r.n, r.at),
    )
    seeds = {row["at"]: k for k, row in enumerate(ranked[:states])}

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = np.zeros((CLASSES, states))
        for batch in batches:
            for blob in batch.column(0):
                text = _decoded(blob.as_py())
                favourite = _favourite(text)
                emissions[:, seeds.get(favourite, favourite % states)] += np.bincount(text, minlength=CLASSES)
        yield _count_rows({"emit": emissions}, states)

    found = _summed(training.mapInArrow(first, schema), states)
    # Texts hardly ever change their state at first.
    stay = 0.98 * np.eye(states) + 0.02 / states
    model = reestimated(found["emit"].sum(0), 1e6 * stay, found["emit"], overall)
    for _ in range(rounds):
        sent = texts.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                some = [_decoded(b.as_py()) for b in batch.column(0)]
                for part in batches_of(some):
                    got = expected(sent.value, [some[n] for n in part])
                    total = got if total is None else tuple(a + b for a, b in zip(total, got))
            if total is not None:
                starts, moves, emissions, likelihood = total
                kinds = {"start": starts[None], "move": moves, "emit": emissions}
                kinds["likelihood"] = np.full((1, states), likelihood)
                yield _count_rows(kinds, states)

        found = _summed(training.mapInArrow(run, schema), states)
        model = reestimated(found["start"][0], found["move"], found["emit"], overall)
        sent.unpersist()
    return model


def _favourite(text: np.ndarray) -> int:
    """The most frequent word class of a text that is a word of its own, or the end."""
    own = text[text < OWN]
    return int(np.bincount(own).argmax()) if len(own) else END


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    held_out=None,
    states: int = STATES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text.

    ``held_out`` is the condition of the rows that do not teach, by default none of them.
    """
    held_out = F.lit(False) if held_out is None else held_out
    parts = stored(numbered(docs, id_col, text_col, held_out), "numbered", partition_by="kind")
    texts = parts.filter("kind = 'texts'").select("chunk", "ids", "held", "sizes", "data")
    words = parts.filter("kind = 'words'").select(F.col("chunk").alias("part"), "number", "word", "n")
    vocabulary = stored(words.groupBy("word").agg(F.sum("n").alias("c")), "vocabulary")
    ends = texts.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    counts = count_classes(vocabulary, ends)
    rows = stored(coded(texts, words, vocabulary, counts), "coded")
    model = train(rows, counts, states, rounds)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [_decoded(b.as_py()) for b in batch.column(batch.num_columns - 1)]
            scores = np.zeros(len(some))
            for part in batches_of(some):
                scores[part] = forward(sent.value, [some[n] for n in part], False)[0] / np.log(10)
            inner = batch.column(batch.num_columns - 2).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(scores + inner)],
                names=["id", "held", "n_tokens", "n_known", "base_score", "score"],
            )

    id_type = rows.schema["id"].dataType.simpleString()
    schema = (
        f"id {id_type}, held boolean, n_tokens long, n_known long, base_score double, score double"
    )
    chosen = rows.select("id", "held", "n_tokens", "n_known", "base_score", "inner", "classes")
    return chosen.mapInArrow(run, schema).select(
        F.col("id").alias(id_col),
        F.col("held").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )

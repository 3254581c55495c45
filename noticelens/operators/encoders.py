"""Text to vectors: two built-in channels and a plug-in for a model of the caller."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, PCA, HashingTF, NGram, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelens.functions.text import word_tokens


def encode(
    df: DataFrame,
    text_col: str,
    encoder_factory: Callable[[], Callable[[Sequence[str]], Sequence[Sequence[float]]]],
    out: str = "embedding",
    batch_size: int = 64,
) -> DataFrame:
    """Run a caller's encoder over a text column in Arrow batches; it is built once per task.

    Null texts are not encoded and get a null vector.
    """

    @F.pandas_udf("array<float>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = encoder_factory()
        for part in texts:
            given = part.dropna()
            rows: list = []
            for start in range(0, len(given), batch_size):
                batch = given.iloc[start : start + batch_size].tolist()
                rows.extend([list(map(float, v)) for v in encoder(batch)])
            vectors = pd.Series(rows, index=given.index, dtype=object).reindex(part.index)
            yield vectors.where(vectors.notna(), None)

    return df.withColumn(out, run(F.col(text_col)))


def fit_general(df: DataFrame, text_col: str, dims: int = 512, n: int = 3) -> PipelineModel:
    """General channel: hashed character n-grams, weighted by IDF, at unit length.

    The model holds one weight per hash cell, whatever the vocabulary.
    """
    stages = [
        NGram(n=n, inputCol="_chars", outputCol="_grams"),
        HashingTF(numFeatures=dims, inputCol="_grams", outputCol="_tf"),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="_general"),
    ]
    return Pipeline(stages=stages).fit(with_chars(df, text_col))


def with_chars(df: DataFrame, text_col: str) -> DataFrame:
    return df.withColumn("_chars", F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), ""))


def with_words(df: DataFrame, text_col: str) -> DataFrame:
    return df.withColumn("_words", word_tokens(F.coalesce(F.col(text_col), F.lit(""))))


def fit_domain(df: DataFrame, text_col: str, dims: int = 256, k: int = 32) -> PipelineModel:
    """Domain channel: hashed words weighted by IDF, projected on the corpus's main axes.

    Fitting keeps a dims x dims matrix on the driver, independent of the corpus.
    """
    stages = [
        HashingTF(numFeatures=dims, inputCol="_words", outputCol="_tf"),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="_unit"),
        PCA(k=k, inputCol="_unit", outputCol="_domain"),
    ]
    return Pipeline(stages=stages).fit(with_words(df, text_col))


def encode_channels(
    df: DataFrame, text_col: str, general: PipelineModel, domain: PipelineModel
) -> DataFrame:
    """Adds vec_a (general) and vec_b (domain) as arrays of doubles."""
    kept = df.columns
    first = general.transform(with_chars(df, text_col)).select(
        *kept, vector_to_array("_general").alias("vec_a")
    )
    return domain.transform(with_words(first, text_col)).select(
        *kept, "vec_a", vector_to_array("_domain").alias("vec_b")
    )


def project_2d(df: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Adds x and y: the two main axes of a vector column.

    The sign of each axis is fixed by making its largest loading positive. A row
    without a vector has no place.
    """
    given = F.col(vec_col).cast("array<double>")
    fitted = df.filter(given.isNotNull()).select(array_to_vector(given).alias("_v"))
    model = PCA(k=2, inputCol="_v", outputCol="_p").fit(fitted)
    axes = model.pc.toArray().T
    signs = [1.0 if axis[abs(axis).argmax()] >= 0 else -1.0 for axis in axes]
    blank = F.array_repeat(F.lit(0.0), axes.shape[1])
    vectors = df.withColumn("_v", array_to_vector(F.coalesce(given, blank)))
    cells = vector_to_array("_p")

    def place(n: int):
        return F.when(F.col(vec_col).isNotNull(), F.get(cells, F.lit(n)) * signs[n])

    return model.transform(vectors).withColumns({"x": place(0), "y": place(1)}).drop("_v", "_p")

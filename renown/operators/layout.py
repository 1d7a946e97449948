"""Text vectors and their two-dimensional layout."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.ml.feature import IDF, PCA, CountVectorizerModel, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.functions.texts import words
from renown.session import stage
from renown.sources.tables import hash60

# Vector size and texts per encoder call.
DIMENSIONS, BATCH = 1024, 96

Encoder = Callable[[list[str]], np.ndarray]


def encode_with(df: DataFrame, key: str, text: str, encoder: Encoder, batch: int = BATCH) -> DataFrame:
    """(key, embedding) from an encoder that maps a list of texts to a matrix."""
    key_type = df.schema[key].dataType.simpleString()

    def run(frames: Iterable[pd.DataFrame]):
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                matrix = np.asarray(encoder(part[text].tolist()), dtype=np.float32)
                yield pd.DataFrame({key: part[key], "embedding": list(matrix)})

    return df.select(key, text).mapInPandas(run, f"`{key}` {key_type}, embedding array<float>")


def encode_hashed(df: DataFrame, key: str, text: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """(key, embedding) of hashed, frequency-weighted words with unit length; needs no model.

    A word's place is ``hash60`` modulo the dimensions, which any engine can compute. Texts without
    words, nulls among them, have the zero vector.
    """
    places = F.transform(words(F.coalesce(F.col(text), F.lit(""))), lambda w: F.pmod(hash60(w), F.lit(dimensions)).cast("string"))
    tokens = df.select(key, places.alias("_places"))
    # no vocabulary of words: the places by their number
    counts = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(dimensions)], inputCol="_places", outputCol="_tf"
    ).transform(tokens)
    # written once: the document frequencies and the weighting both read it
    counts = stage(counts.select(key, "_tf"), "hashed")
    weighted = IDF(inputCol="_tf", outputCol="_weighted").fit(counts).transform(counts)
    unit = Normalizer(inputCol="_weighted", outputCol="_unit").transform(weighted)
    return unit.select(key, vector_to_array("_unit", "float32").alias("embedding"))


def layout(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x, y): the two main axes; each axis is turned so that its largest loading is positive."""
    points = df.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    model = PCA(k=2, inputCol="_v", outputCol="_p").fit(points)
    axes = model.pc.toArray()
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), [0, 1]])
    place = vector_to_array("_p")
    return model.transform(points).select(
        key,
        (place[0] * float(signs[0])).cast("float").alias("x"),
        (place[1] * float(signs[1])).cast("float").alias("y"),
    )

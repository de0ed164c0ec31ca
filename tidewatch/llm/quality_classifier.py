"""Compression classifier: a text is scored by how well good and bad dictionaries compress it.

Two zstandard dictionaries are trained on good and on bad labelled texts.  A text's
normalised compressed-size difference, with its compressed sizes and length, goes
through a logistic calibration fitted on labelled texts that no dictionary saw.

Fitting sees a bounded sample: the ``per_class`` labelled texts of each class with the
smallest seeded id hashes, half for the dictionaries and half for the calibration.  A
dictionary takes up to ``max_chars`` characters of a text, in pieces from across it; the
calibration's features are those of whole texts, computed in tasks as for scoring.
Scoring covers every whole text, in one Arrow UDF whose closure is the two dictionaries
and ten weights.

Defined cases: a null text scores as an empty one, an empty text gets the score its
compressed sizes give; ids labelled both ways are not learned from; without usable
labels of either class every score is the smoothed share of good labels; repeated rows
get equal scores; other columns are untouched, and the score column is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.session import checkpointed

PER_CLASS, MAX_CHARS, DICTIONARY_BYTES, LEVEL, SEED = 2000, 8000, 1 << 16, 3, 23
HOLD_OUT = 5
#: Pieces, evenly spread, of which a longer text's dictionary sample is made.
PIECES = 8


@dataclass
class Model:
    """What scoring needs; ``dictionaries`` is empty for a constant score."""
    share: float
    dictionaries: list[tuple[bytes, bool]]                 # bytes, and whether trained (else raw content)
    weights: np.ndarray | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None


def held_out(id: Column) -> Column:
    """Whether a row is kept out of learning: crc32 of its id as text divides by ``HOLD_OUT``."""
    return F.coalesce(F.crc32(id.cast("string")) % HOLD_OUT == 0, F.lit(False))


def _dictionary(texts: list[bytes], size: int) -> tuple[bytes, bool]:
    try:
        return zstandard.train_dictionary(size, texts).as_bytes(), True
    except zstandard.ZstdError:                            # too little text to train on
        return b"\n".join(texts)[:size] or b"\n", False


def _spread(text: Column, chars: int) -> Column:
    """A text of up to ``chars`` characters whole, else ``PIECES`` pieces from its start to its end."""
    n = max(1, chars // PIECES)
    pieces = [F.substr(text, F.floor(F.lit(i) * (F.length(text) - n) / (PIECES - 1)).cast("int") + 1, F.lit(n)) for i in range(PIECES)]
    return F.when(F.length(text) <= chars, text).otherwise(F.concat(*pieces))


def _features(model: Model, texts, level: int = LEVEL) -> np.ndarray:
    """A row of compression features for each text (bytes)."""
    how = dict(level=level, write_content_size=False, write_checksum=False, write_dict_id=False)
    packers = []
    for raw, trained in model.dictionaries:
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        packers.append(zstandard.ZstdCompressor(dict_data=d, **how))
    packers.append(zstandard.ZstdCompressor(**how))
    sizes = np.array([[len(p.compress(t)) for p in packers] + [len(t) + 1] for t in texts], float).reshape(-1, 4)
    bad, good, plain, n = sizes.T
    difference = (bad - good) / np.maximum(bad, good)
    length, in_good, alone = np.log(n), np.log(good / n), np.log(plain / n)
    return np.stack([np.ones_like(n), difference, difference * length, in_good, alone, length,
                     alone ** 2, length ** 2, length * alone, in_good ** 2], 1)


def _text_features(model: Model, texts: pa.Array) -> np.ndarray:
    return _features(model, ((t.as_py() or "").encode("utf-8", "surrogatepass") for t in texts))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Newton's method on the ridge-penalised log likelihood."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) / len(y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
        per_class: int = PER_CLASS, max_chars: int = MAX_CHARS, dictionary_bytes: int = DICTIONARY_BYTES,
        seed: int = SEED) -> Model:
    """A model from the labelled rows that are not held out; bounds are the module's documented ones."""
    usable = (labels.where(F.col(id).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(id)))
              .groupBy(F.col(id).alias("_id")).agg(F.min(label).alias("_y"), F.max(label).alias("_top"))
              .where("_y = _top").drop("_top"))
    counts = {r._y: r["count"] for r in usable.groupBy("_y").count().collect()}
    good, bad = counts.get(1, 0), counts.get(0, 0)
    share = (good + 1) / (good + bad + 2)
    order = [F.xxhash64(F.lit(seed), "_id"), F.col("_id")]
    chosen = usable.where("_y = 0").orderBy(*order).limit(per_class).unionByName(
        usable.where("_y = 1").orderBy(*order).limit(per_class))
    sample = checkpointed(docs.join(F.broadcast(chosen), docs[id] == chosen._id)    # <= 2 * per_class texts
                          .groupBy("_id", "_y").agg(F.min(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("t")))
    # of each class the first half by hash is for the dictionary
    of_class = Window.partitionBy("_y")
    halves = (sample.select("_id", "_y").withColumn("_n", F.row_number().over(of_class.orderBy(*order)))
              .select("_id", (F.col("_n") <= F.floor(F.count("*").over(of_class) / 2)).alias("_first")))
    sample = sample.join(F.broadcast(halves), "_id")
    rows = sample.where("_first").select("_id", "_y", _spread(F.col("t"), max_chars).alias("t")).orderBy(*order).collect()
    texts = {y: [r.t.encode("utf-8", "surrogatepass") for r in rows if r._y == y] for y in (0, 1)}
    if min(len(t) for t in texts.values()) < 1:
        return Model(share, [])
    model = Model(share, [_dictionary(texts[y], dictionary_bytes) for y in (0, 1)])

    def measured(texts: pa.Array) -> pa.Array:
        return pa.array(list(_text_features(model, texts)), pa.list_(pa.float64()))

    seen = (sample.where("not _first").select("_id", "_y", F.arrow_udf(measured, "array<double>")("t").alias("x"))
            .orderBy("_y", *order).collect())
    y, x = np.array([float(r._y) for r in seen]), np.array([r.x for r in seen])
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-9
    model.mean[0], model.scale[0] = 0, 1
    model.weights = _logistic((x - model.mean) / model.scale, y)
    # from the sample's class shares to those of all labels
    model.weights[0] += np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    return model


def scored(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with ``into``: the calibrated probability (0 to 1) of the label 1."""
    if model.weights is None:
        return docs.withColumn(into, F.lit(float(model.share)))

    def run(texts: pa.Array) -> pa.Array:
        x = _text_features(model, texts)
        return pa.array(1 / (1 + np.exp(-np.clip((x - model.mean) / model.scale @ model.weights, -30, 30))), pa.float64())

    return docs.withColumn(into, F.arrow_udf(run, "double")(F.col(text).cast("string")))

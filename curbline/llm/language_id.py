"""Language of a text by a byte convolutional network.

A text's UTF-8 bytes are cut into windows of fixed length; every window goes through filters of several
widths, the largest response of each filter over the window goes through a rectifier and a softmax layer, and
the windows' probabilities are averaged into the text's. The network is trained with numpy on a bounded
sample of labelled texts: at most ``per_language`` texts of each language, the ones with the smallest hash
of the identifier, and at most ``windows_per_text`` windows of each. Every window of every text is classified.

As the input of a filter is one of 256 bytes, its response is a sum of table rows, one for each byte under
it. For prediction the rows of neighbouring bytes are added beforehand, for pairs of the byte classes that
occur in training (all other bytes share one class, in training too).

Defined cases: a null text, or one without any letter, is ``und`` with score 0. Rows with a null language, or
held out, are not learned from; without any labelled row every prediction is ``und``. Null identifiers count
as the empty text for the hold-out rule. Ties go to the first language by name. Empty tables give empty
results; repeated rows get equal predictions; further columns of any name are ignored or carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, WIDTHS, FILTERS, CLASSES = 256, (2, 3, 4), 16, 96
PER_LANGUAGE, WINDOWS_PER_TEXT, EPOCHS, BATCH, SEED = 300, 8, 6, 64, 20250
UNKNOWN = "und"


def held_out(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % 3 == 1


@dataclass
class Network:
    """``classes``: byte to class. ``filters``: by width, an array (width, classes, filters)."""

    languages: list[str]
    classes: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray


def _windows(data: np.ndarray) -> np.ndarray:
    """All windows of one text's bytes, the last one padded with spaces."""
    count = max(1, -(-len(data) // WINDOW))
    out = np.full(count * WINDOW, 32, np.uint8)
    out[: len(data)] = data
    return out.reshape(count, WINDOW)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, languages: np.ndarray, seed: int = SEED) -> Network:
    """Fit by stochastic gradient steps (Adam). ``windows``: (n, WINDOW) bytes; ``languages``: their names."""
    names = sorted(set(languages.tolist()))
    target = np.searchsorted(names, languages)
    counts = np.bincount(windows.ravel(), minlength=256)
    classes = np.zeros(256, np.int64)  # class 0: bytes that are rare in training
    frequent = [b for b in np.argsort(-counts, kind="stable")[: CLASSES - 1] if counts[b]]
    classes[frequent] = 1 + np.arange(len(frequent))
    x_all, n = classes[windows], 1 + len(frequent)

    rng = np.random.default_rng(seed)
    total = FILTERS * len(WIDTHS)
    weights = [rng.normal(0, 0.3, (w, n, FILTERS)).astype(np.float32) for w in WIDTHS]
    weights += [np.zeros(total, np.float32), rng.normal(0, 0.1, (total, len(names))).astype(np.float32)]
    weights += [np.zeros(len(names), np.float32)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    share = np.bincount(target, minlength=len(names))
    importance = (len(target) / (len(names) * share))[target].astype(np.float32)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x_all))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            x, y = x_all[chosen], target[chosen]
            pooled, places = [], []
            for w, f in zip(WIDTHS, weights):
                last = WINDOW - w + 1
                z = f[0][x[:, :last]]
                for t in range(1, w):
                    z += f[t][x[:, t : t + last]]
                place = z.argmax(axis=1)
                places.append(place)
                pooled.append(np.take_along_axis(z, place[:, None, :], axis=1)[:, 0])
            bias, dense, dense_bias = weights[-3:]
            before = np.concatenate(pooled, axis=1) + bias
            hidden = np.maximum(before, 0)
            error = _softmax(hidden @ dense + dense_bias)
            error[np.arange(len(y)), y] -= 1
            error *= importance[chosen][:, None] / len(y)
            back = (error @ dense.T) * (before > 0)
            slopes = []
            for k, w in enumerate(WIDTHS):
                slope = np.zeros_like(weights[k])
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                columns = np.broadcast_to(np.arange(FILTERS), part.shape)
                for t in range(w):
                    np.add.at(slope[t], (np.take_along_axis(x, places[k] + t, axis=1), columns), part)
                slopes.append(slope)
            slopes += [back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for w, slope, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                w -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(names, classes, weights[:-3], *weights[-3:])


class Predictor:
    """The trained network with its tables of byte pairs."""

    def __init__(self, net: Network):
        self.net, self.n = net, net.filters[0].shape[1]
        if not net.languages:
            return
        two, three, four = net.filters
        pairs = lambda f, t: (f[t][:, None, :] + f[t + 1][None, :, :]).reshape(-1, FILTERS)
        self.two, self.three, self.four, self.four_rest = pairs(two, 0), pairs(three, 0), pairs(four, 0), pairs(four, 2)
        self.classes = net.classes.astype(np.int32)

    def windows(self, windows: np.ndarray) -> np.ndarray:
        """Probabilities (n, languages), a bounded number of windows at a time."""
        return np.concatenate([self._part(windows[i : i + 64]) for i in range(0, len(windows), 64)])

    def _part(self, windows: np.ndarray) -> np.ndarray:
        x = self.classes[windows]
        pair = x[:, :-1] * np.int32(self.n) + x[:, 1:]
        a = self.two.take(pair, axis=0).max(axis=1)
        z = self.three.take(pair[:, :-1], axis=0)
        z += self.net.filters[1][2].take(x[:, 2:], axis=0)
        b = z.max(axis=1)
        z = self.four.take(pair[:, :-2], axis=0)
        z += self.four_rest.take(pair[:, 2:], axis=0)
        hidden = np.maximum(np.concatenate([a, b, z.max(axis=1)], axis=1) + self.net.bias, 0)
        return _softmax(hidden @ self.net.dense + self.net.dense_bias)

    def texts(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; a window counts by the bytes it holds."""
        known = [i for i, t in enumerate(texts) if t and self.net.languages and any(map(str.isalpha, t))]
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if known:
            data = [np.frombuffer(texts[i].encode("utf-8", "replace"), np.uint8) for i in known]
            cut = [_windows(d) for d in data]
            odds = self.windows(np.concatenate(cut))
            weight = np.full(len(odds), WINDOW, np.float64)
            ends = np.cumsum([len(c) for c in cut])
            weight[ends - 1] = [len(d) - (len(c) - 1) * WINDOW for d, c in zip(data, cut)]
            mean = np.add.reduceat(odds * weight[:, None], np.r_[0, ends[:-1]], axis=0)
            mean /= mean.sum(axis=1, keepdims=True)
            for i, best, row in zip(known, mean.argmax(axis=1), mean):
                names[i], scores[i] = self.net.languages[best], min(1.0, float(row[best]))
        return names, scores


def training_sample(
    docs: DataFrame, id_column: str, text_column: str, lang_column: str, per_language: int = PER_LANGUAGE
) -> tuple[np.ndarray, np.ndarray]:
    """Windows and languages of a bounded sample of the labelled rows that are not held out."""
    labelled = docs.where(
        F.col(lang_column).isNotNull() & F.col(text_column).rlike(r"\p{L}") & ~held_out(F.col(id_column))
    )
    # in [0, 1), from the identifier and the text's length only, so that reruns choose the same rows
    place = F.pmod(F.xxhash64(F.lit(SEED), F.col(id_column), F.length(text_column)), F.lit(1 << 30)) / float(1 << 30)
    counts = dict(docs.where(F.col(lang_column).isNotNull()).groupBy(lang_column).count().collect())
    if not counts:
        return np.zeros((0, WINDOW), np.uint8), np.array([], dtype=str)
    # the rows with the smallest hashes: a cut-off per language by its count, then the exact bound
    bound = F.lit(0.0)
    for name, count in sorted(counts.items()):
        bound = F.when(F.col(lang_column) == name, F.lit(min(1.0, 2.0 * per_language / count))).otherwise(bound)
    few = labelled.withColumn("_place", place).where(F.col("_place") < bound)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for p, lang, text in rows:
                windows = _windows(np.frombuffer(text.encode("utf-8", "replace"), np.uint8))
                taken = np.unique(np.linspace(0, len(windows) - 1, WINDOWS_PER_TEXT).astype(int))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p]), pa.array([lang]), pa.array([windows[taken].tobytes()])], ["place", "lang", "data"]
                )

    rows = few.select("_place", lang_column, text_column).mapInArrow(cut, "place double, lang string, data binary")
    by_language: dict[str, list] = {}
    for row in rows.collect():  # at most about 2 * per_language small rows for each language
        by_language.setdefault(row.lang, []).append((row.place, bytes(row.data)))
    windows, names = [], []
    for name in sorted(by_language):
        for _, data in sorted(by_language[name])[:per_language]:
            part = np.frombuffer(data, np.uint8).reshape(-1, WINDOW)
            windows.append(part)
            names += [name] * len(part)
    return np.concatenate(windows) if windows else np.zeros((0, WINDOW), np.uint8), np.array(names, dtype=str)


def fit_language_model(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang"
) -> Network:
    windows, names = training_sample(docs, id_column, text_column, lang_column)
    if not len(names):
        empty = np.zeros((0, 0, 0), np.float32)
        return Network([], np.zeros(256, np.int64), [empty] * len(WIDTHS), empty, empty, empty)
    return train(windows, names)


#: Texts classified together.
TOGETHER = 128


def _predicted(batch: pa.RecordBatch, text: int, known: Predictor) -> tuple[list[str], list[float]]:
    """Language and score of each text in this column. Only the text is given to the network."""
    names, scores = [], []
    for at in range(0, batch.num_rows, TOGETHER):
        part = known.texts(batch.column(text).slice(at, TOGETHER).to_pylist())
        names += part[0]
        scores += part[1]
    return names, scores


def identify_languages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    net: Network | None = None,
) -> DataFrame:
    """One row per row of ``docs``: identifier, held_out, lang_pred, score. Without a network, one is fitted."""
    net = net or fit_language_model(docs, id_column, text_column, lang_column)
    rows = docs.select(
        F.col(id_column).alias("id"), held_out(F.col(id_column)).alias("held_out"), F.col(text_column).cast("string").alias("text")
    )

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Predictor(net)
        for batch in batches:
            names, scores = _predicted(batch, 2, known)
            columns = [*batch.columns[:2], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "lang_pred", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(predict, f"id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_column)


def keep_known_languages(
    docs: DataFrame, net: Network, text_column: str = "text", least_score: float = 0.0
) -> DataFrame:
    """The rows of ``docs`` whose language the network can tell, with a score of ``least_score`` or more."""
    text = docs.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Predictor(net)
        for batch in batches:
            names, scores = _predicted(batch, text, known)
            good = [name != UNKNOWN and score >= least_score for name, score in zip(names, scores)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)

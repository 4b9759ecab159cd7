"""Language identification: a byte convolutional network trained in numpy.

Bytes are embedded, filters of several widths slide over them, each filter's maximum over a window
feeds a softmax over the languages met in training. Training reads a bounded sample of labelled rows
(``SAMPLE_ROWS`` in all, spread evenly over the languages, chosen by hash) and draws windows from all
over their texts. Prediction cuts every whole text into windows of ``WINDOW`` bytes, scores them in
batches and averages the windows' probabilities by their length. For speed the first two layers are
folded into tables: what a pair of neighbouring bytes adds to a filter is looked up at once.

A null text and a text without a letter are ``und`` with score 0.0, and so is every text if there was
nothing to learn from. Ties go to the language that sorts first. Rows are predicted from their text
alone, so repeated rows get equal results; further columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import arrow_pass, carrying, slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS, EMBEDDING = 16, 8
SAMPLE_ROWS = 4_000
WINDOWS_PER_ROW = 4
STEPS, BATCH = 400, 96
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """Languages in order, and the weights."""

    languages: tuple[str, ...]
    weights: dict[str, np.ndarray]


# --- training -------------------------------------------------------------------------------


def _forward(w: dict, x: np.ndarray):
    """Features of windows, and where each filter had its maximum."""
    embedded = w["embedding"][x]
    features, places = [], []
    for width in WIDTHS:
        n = x.shape[1] - width + 1
        out = sum(embedded[:, j : j + n] @ w[f"filter{width}"][j] for j in range(width))
        at = out.argmax(1)
        features.append(np.take_along_axis(out, at[:, None], 1)[:, 0] + w[f"bias{width}"])
        places.append(at)
    return np.concatenate(features, 1), places


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _gradients(w: dict, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    raw, places = _forward(w, x)
    active = np.maximum(raw, 0)
    error = _softmax(active @ w["out"] + w["out_bias"])
    error[np.arange(len(y)), y] -= 1
    error /= len(y)
    grads = {"out": active.T @ error, "out_bias": error.sum(0), "embedding": np.zeros_like(w["embedding"])}
    back = (error @ w["out"].T) * (raw > 0)
    rows = np.arange(len(x))[:, None]
    for i, width in enumerate(WIDTHS):
        g = back[:, i * FILTERS : (i + 1) * FILTERS]
        grads[f"bias{width}"] = g.sum(0)
        filters = w[f"filter{width}"]
        grads[f"filter{width}"] = np.zeros_like(filters)
        for j in range(width):
            letters = x[rows, places[i] + j]
            grads[f"filter{width}"][j] = np.einsum("bf,bfd->df", g, w["embedding"][letters])
            spread = g[:, :, None] * filters[j].T[None]
            np.add.at(grads["embedding"], letters.ravel(), spread.reshape(-1, EMBEDDING))
    return grads


def fit(windows: list[bytes], languages: list[str], seed: int = 7) -> Model:
    """A network for windows and their languages. The same input gives the same weights."""
    names = tuple(sorted(set(languages)))
    if not names:
        return Model((), {})
    random = np.random.default_rng(seed)
    x = np.zeros((len(windows), WINDOW), np.uint8)
    for i, data in enumerate(windows):
        x[i, : len(data)] = np.frombuffer(data[:WINDOW], np.uint8)
    y = np.array([names.index(lang) for lang in languages])
    of = [np.flatnonzero(y == k) for k in range(len(names))]

    def normal(*shape: int, scale: float) -> np.ndarray:
        return random.normal(0, scale, shape).astype(np.float32)

    w = {"embedding": normal(256, EMBEDDING, scale=0.5), "out_bias": np.zeros(len(names), np.float32)}
    w["out"] = normal(len(WIDTHS) * FILTERS, len(names), scale=0.2)
    for width in WIDTHS:
        w[f"filter{width}"] = normal(width, EMBEDDING, FILTERS, scale=0.5 / width)
        w[f"bias{width}"] = np.zeros(FILTERS, np.float32)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, STEPS + 1):
        pick = np.array([random.choice(of[k]) for k in random.integers(0, len(names), BATCH)])
        batch = x[pick].copy()
        # half of the windows are shortened, as the ends of texts are
        short = np.where(random.random(BATCH) < 0.5, random.integers(8, WINDOW + 1, BATCH), WINDOW)
        batch[np.arange(WINDOW)[None] >= short[:, None]] = 0
        rate = 0.01 * (1 - step / (STEPS + 1))
        for k, g in _gradients(w, batch, y[pick]).items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            down = np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8
            w[k] = (w[k] - rate * first[k] / (1 - 0.9**step) / down).astype(np.float32)
    return Model(names, w)


def train(docs: DataFrame, usable: Column, id_column: str = "doc_id") -> Model:
    """Fit on a bounded sample of the rows with text and language for which ``usable`` holds."""
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    each = min(900, max(1, SAMPLE_ROWS // max(1, len(counts))))
    data = F.encode("text", "UTF-8")

    def window(i: int) -> Column:
        room = F.greatest(F.length(data) - WINDOW, F.lit(0)) + 1
        start = F.pmod(F.xxhash64(F.lit(i), F.col(id_column)), room) + 1
        return F.substring(data, start.cast("int"), F.lit(WINDOW))

    if not counts:
        return fit([], [])
    # what lies under a bound that some more rows than needed are expected to meet; the driver keeps the first
    place = F.xxhash64(id_column)
    bounds = {name: min(2**63 - 1, int(-(2**63) + 2**64 * (1.3 * each + 60) / n)) for name, n in counts.items()}
    bound = F.element_at(F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair]), F.col("lang"))
    windows = F.array(*[window(i) for i in range(WINDOWS_PER_ROW)])
    # rows that share an id are one
    picked = rows.where(place <= bound).groupBy("lang", F.col(id_column).alias("id")).agg(F.min(windows).alias("windows"))
    by_language: dict[str, list] = {}
    for row in picked.select("lang", "id", F.xxhash64("id").alias("place"), "windows").collect():
        by_language.setdefault(row["lang"], []).append(row)
    found = []
    for own in by_language.values():
        found += sorted(own, key=lambda r: (r["place"], r["id"]))[:each]
    found.sort(key=lambda r: (r["id"], r["lang"]))
    pairs = [(bytes(b), r["lang"]) for r in found for b in r["windows"] if b]
    return fit([p[0] for p in pairs], [p[1] for p in pairs])


# --- prediction -----------------------------------------------------------------------------


class Folded:
    """The network with its first two layers as tables over bytes and pairs of bytes."""

    def __init__(self, model: Model) -> None:
        w = model.weights
        self.out, self.out_bias, self.tables = w["out"], w["out_bias"], []
        for width in WIDTHS:
            single = [w["embedding"] @ w[f"filter{width}"][j] for j in range(width)]
            pairs = []
            for j in range(0, width - 1, 2):
                # little-endian pairs: the first byte is the low one
                both = single[j][None, :, :] + single[j + 1][:, None, :]
                pairs.append((j, both.reshape(65536, FILTERS)))
            if width % 2:
                pairs.append((width - 1, single[-1]))
            self.tables.append((width, pairs, w[f"bias{width}"]))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Softmax of every window (rows of ``WINDOW`` bytes)."""
        wide = x.astype(np.uint16)
        couples = (wide[:, :-1] | wide[:, 1:] << 8).astype(np.intp)
        alone = x.astype(np.intp)
        features = []
        for width, parts, bias in self.tables:
            n = WINDOW - width + 1
            total = None
            for j, lookup in parts:
                index = (couples if len(lookup) > 256 else alone)[:, j : j + n]
                added = lookup.take(index, axis=0)
                total = added if total is None else np.add(total, added, out=total)
            features.append(total.max(1) + bias)
        active = np.maximum(np.concatenate(features, 1), 0)
        return _softmax(active @ self.out + self.out_bias)


def predict_texts(folded: Folded, languages: tuple[str, ...], texts: list[str | None]) -> list[tuple[str, float, float]]:
    """Language, score and certainty (mean of each window's largest probability) of every text."""
    known = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
    out: list[tuple[str, float, float]] = [(UNKNOWN, 0.0, 0.0)] * len(texts)
    if not languages or not known:
        return out
    data = [texts[i].encode() for i in known]
    counts = np.array([-(-len(d) // WINDOW) for d in data])
    flat = np.frombuffer(b"".join(d.ljust(int(n) * WINDOW, b"\0") for d, n in zip(data, counts)), np.uint8)
    windows = flat.reshape(-1, WINDOW)
    scored = np.concatenate([folded.probabilities(windows[i : i + 128]) for i in range(0, len(windows), 128)])
    ends = np.cumsum(counts)
    weight = np.full(len(windows), float(WINDOW))
    weight[ends - 1] = [len(d) - (n - 1) * WINDOW for d, n in zip(data, counts)]
    total = np.add.reduceat(scored * weight[:, None], ends - counts, axis=0)
    mean = total / np.add.reduceat(weight, ends - counts)[:, None]
    sure = np.add.reduceat(scored.max(1) * weight, ends - counts) / np.add.reduceat(weight, ends - counts)
    best = mean.argmax(1)
    for i, k, p, s in zip(known, best.tolist(), mean[np.arange(len(best)), best].tolist(), sure.tolist()):
        out[i] = (languages[k], min(1.0, p), min(1.0, s))
    return out


def with_language(docs: DataFrame, model: Model, carried: list[str]) -> DataFrame:
    """The carried columns with ``lang_pred``, ``score`` and ``certainty``.

    The score is the share of the winning language, the certainty that of each window's own.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    languages = model.languages
    built: list[Folded] = []  # once a task

    def make(batch):
        texts = batch.column(0).to_pylist()
        if languages and not built:
            built.append(Folded(shared.value))
        folded = built[0] if built else None
        found = []
        for a, b in slices(np.array([len(t or "") for t in texts]), 500_000):
            found += predict_texts(folded, languages, texts[a:b])
        yield {
            **{name: batch.column(k + 1) for k, name in enumerate(carried)},
            "lang_pred": pa.array([f[0] for f in found], pa.string()),
            "score": pa.array([f[1] for f in found], pa.float64()),
            "certainty": pa.array([f[2] for f in found], pa.float64()),
        }

    frame = docs.select(F.col("text").alias("_text"), *carried)
    return arrow_pass(frame, make, carrying(docs, carried, "lang_pred string, score double, certainty double"))


def held_out(id_column: str = "doc_id") -> Column:
    """The fold that is never learnt from: CRC-32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(False))


def learnable(id_column: str = "doc_id") -> Column:
    return F.col(id_column).isNotNull() & ~held_out(id_column)

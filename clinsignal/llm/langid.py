"""Language identification with a byte convolutional network in numpy.

Texts are cut into windows of ``LENGTH`` bytes (A-Z folded, padded with zeros).
A window's bytes are embedded, filters of several widths slide over them, each
filter keeps its maximum, and a softmax layer gives the languages.  A document's
probabilities are the mean of its windows', weighted by their bytes -- every
byte of the text is read.

Training uses a bounded, documented sample: about ``PER_LABEL`` documents of
every label, chosen by hash, with ``CROPS`` windows each (shorter crops among
them, so short texts are learned too).  Windows are cut on the executors; the
driver sees PER_LABEL * CROPS * LENGTH bytes per label and trains in seconds.

Defined results: a text that is null or has no letter is ``und`` with score 0,
as is every text when nothing was learned; a null label is not learned from;
repeated rows get the same prediction; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LENGTH = 256
EMBED = 8
FILTERS = {2: 8, 3: 12, 4: 12}  # width -> filters
WIDEST = max(FILTERS)
PER_LABEL = 400
CROPS = 4
EPOCHS = 12
BATCH = 128
SLAB = 4096  # windows held at once when predicting
UNKNOWN = "und"

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


# ------------------------------------------------------------------- windows
def places(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, owner text and size of every window of the texts."""
    counts = -(-(ends - starts) // LENGTH)
    owner = np.repeat(np.arange(len(starts)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = starts[owner] + within * LENGTH
    return first, owner, np.minimum(LENGTH, ends[owner] - first)


def cut(buffer: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The windows as rows of folded bytes, zeros behind the text's end."""
    at = np.minimum(first[:, None] + np.arange(LENGTH), len(buffer) - 1)
    return np.where(np.arange(LENGTH) < size[:, None], FOLD[buffer[at]], 0).astype(np.uint8)


def crops(text: bytes, seed: int) -> list[bytes]:
    """Training windows of one text: whole windows and a shorter one."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(CROPS):
        length = LENGTH if i < CROPS - 1 else int(rng.integers(12, LENGTH))
        at = int(rng.integers(0, max(1, len(text) - length + 1)))
        out.append(text[at : at + length])
    return out


# --------------------------------------------------------------------- model
def new_model(labels: list[str], rng) -> dict:
    masks = np.concatenate(
        [np.repeat((np.arange(WIDEST) < w).astype(np.float32)[:, None], n, axis=1) for w, n in FILTERS.items()], axis=1
    )  # a narrow filter sees only its first bytes
    mask = np.repeat(masks, EMBED, axis=0)
    scale = 1 / np.sqrt(mask.sum(axis=0))
    embed = rng.normal(0, 1, (256, EMBED)).astype(np.float32)
    embed[0] = 0
    return {
        "labels": labels,
        "mask": mask,
        "embed": embed,
        "filters": (rng.normal(0, 1, mask.shape) * mask * scale).astype(np.float32),
        "bias": np.zeros(mask.shape[1], np.float32),
        "out": np.zeros((mask.shape[1], len(labels)), np.float32),
        "out_bias": np.zeros(len(labels), np.float32),
    }


def patches(model: dict, windows: np.ndarray) -> np.ndarray:
    """(n, LENGTH, WIDEST * EMBED): the embedded bytes under the widest filter at every place."""
    padded = np.pad(windows, ((0, 0), (0, WIDEST - 1)))
    embedded = model["embed"][padded].reshape(len(windows), -1)
    view = np.lib.stride_tricks.sliding_window_view(embedded, WIDEST * EMBED, axis=1)[:, ::EMBED]
    return np.ascontiguousarray(view)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def predict(model: dict, windows: np.ndarray, chunk: int = 64) -> np.ndarray:
    """Label probabilities of every window; memory is bounded by ``chunk`` windows."""
    out = np.empty((len(windows), len(model["labels"])), np.float32)
    for i in range(0, len(windows), chunk):
        x = patches(model, windows[i : i + chunk])
        y = (x.reshape(-1, x.shape[2]) @ model["filters"]).reshape(len(x), LENGTH, -1).max(axis=1)
        hidden = np.maximum(y + model["bias"], 0)
        out[i : i + chunk] = softmax(hidden @ model["out"] + model["out_bias"])
    return out


def train_network(windows: np.ndarray, target: np.ndarray, labels: list[str], epochs: int = EPOCHS, seed: int = 7) -> dict:
    """Adam on cross-entropy; gradients flow through each filter's maximum only."""
    rng = np.random.default_rng(seed)
    model = new_model(labels, rng)
    names = ("embed", "filters", "bias", "out", "out_bias")
    state = {k: [np.zeros_like(model[k]), np.zeros_like(model[k])] for k in names}
    step = 0
    for epoch in range(epochs):
        rate = 0.01 if epoch < epochs * 2 // 3 else 0.002
        order = rng.permutation(len(windows))
        for i in range(0, len(order), BATCH):
            take = order[i : i + BATCH]
            x = patches(model, windows[take])
            y = (x.reshape(-1, x.shape[2]) @ model["filters"]).reshape(len(take), LENGTH, -1)
            at = y.argmax(axis=1)
            top = np.take_along_axis(y, at[:, None, :], axis=1)[:, 0] + model["bias"]
            hidden = np.maximum(top, 0)
            delta = softmax(hidden @ model["out"] + model["out_bias"])
            delta[np.arange(len(take)), target[take]] -= 1
            delta /= len(take)
            back = (delta @ model["out"].T) * (top > 0)
            seen = x[np.arange(len(take))[:, None], at]  # (n, filters, WIDEST * EMBED)
            grads = {
                "out": hidden.T @ delta,
                "out_bias": delta.sum(axis=0),
                "bias": back.sum(axis=0),
                "filters": np.einsum("nf,nfe->ef", back, seen) * model["mask"],
            }
            spread = (back[:, :, None] * model["filters"].T[None]).reshape(-1, WIDEST, EMBED)
            padded = np.pad(windows[take], ((0, 0), (0, WIDEST - 1)))
            place = (at[:, :, None] + np.arange(WIDEST)).reshape(len(take), -1)
            byte = np.take_along_axis(padded, place, axis=1).reshape(-1, WIDEST)
            grads["embed"] = np.zeros_like(model["embed"])
            np.add.at(grads["embed"], byte, spread)
            grads["embed"][0] = 0
            step += 1
            for k in names:
                m, v = state[k]
                m += 0.1 * (grads[k] - m)
                v += 0.001 * (grads[k] ** 2 - v)
                model[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


# --------------------------------------------------------------------- Spark
def remainder(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 3


def cropper(batches):
    """mapInArrow kernel: (key, label, text) -> (label, window)."""
    for batch in batches:
        label, window = [], []
        for key, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for piece in crops(text.encode(), zlib.crc32(key.encode())):
                label.append(lang)
                window.append(piece)
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.string()), pa.array(window, pa.binary())], names=["label", "window"])


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    per_label: int = PER_LABEL,
    epochs: int = EPOCHS,
) -> dict | None:
    """Fit on labelled rows outside the held-out third; None without any."""
    labelled = docs.where(
        F.col(label_col).isNotNull() & F.col(text_col).isNotNull() & (remainder(F.col(id_col)) != 1)
    ).select(F.col(id_col).cast("string").alias("key"), F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"))
    sizes = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    # about per_label documents of each label, by a threshold on the id's hash
    draw = F.pmod(F.xxhash64(F.lit("langid"), "key"), F.lit(1 << 30))
    limit = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, int(min(1.0, per_label / n) * (1 << 30)))])
    windows = labelled.where(draw <= limit[F.col("label")]).mapInArrow(cropper, "label string, window binary").collect()
    windows = sorted((r["label"], bytes(r["window"])) for r in windows if r["window"])
    labels = sorted({label for label, _ in windows})
    if not labels:
        return None
    x = np.zeros((len(windows), LENGTH), np.uint8)
    for i, (_, w) in enumerate(windows):
        x[i, : len(w)] = FOLD[np.frombuffer(w, np.uint8)]
    y = np.array([labels.index(label) for label, _ in windows])
    return train_network(x, y, labels, epochs)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def predictor(model_bc, columns: list[str], text_at: int):
    """mapInArrow kernel: the batch's columns plus lang_pred and score."""

    def run(batches):
        model = model_bc.value
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary())
            texts = texts.fill_null(b"") if texts.null_count else texts
            ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            buffer = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
            letter = np.zeros(len(texts), bool)
            names, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if model is not None and len(buffer):
                total = np.zeros((len(texts), len(model["labels"])))
                first, owner, size = places(ends[:-1], ends[1:])
                for i in range(0, len(first), SLAB):
                    part = slice(i, i + SLAB)
                    windows = cut(buffer, first[part], size[part])
                    np.add.at(total, owner[part], predict(model, windows) * size[part, None])
                    np.logical_or.at(letter, owner[part], ((windows >= 97) & (windows <= 122)).any(axis=1))
                for i in np.flatnonzero(~letter & (ends[1:] > ends[:-1])):
                    letter[i] = has_letter(buffer[ends[i] : ends[i + 1]].tobytes().decode("utf-8", "replace"))
                best = total.argmax(axis=1)
                sure = total[np.arange(len(total)), best] / np.maximum(total.sum(axis=1), 1e-9)
                names = np.where(letter, np.array(model["labels"], object)[best], UNKNOWN)
                score = np.where(letter, np.clip(sure, 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(columns))] + [pa.array(names.tolist(), pa.string()), pa.array(score, pa.float64())],
                names=[*columns, "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, model: dict | None, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with all its columns plus the prediction and its probability."""
    fields = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*fields)
    schema = ", ".join(f"{f} {t}" for f, t in plain.dtypes) + ", lang_pred string, score double"
    kernel = predictor(docs.sparkSession.sparkContext.broadcast(model), fields, docs.columns.index(text_col))
    return plain.mapInArrow(kernel, schema).toDF(*docs.columns, pred_col, score_col)


cloudpickle.register_pickle_by_value(sys.modules[__name__])

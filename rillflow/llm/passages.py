"""Quality scores by gated attention over the passages of a document.

A document is a bag of passages of 64 words. An encoder turns each passage into a vector, a gated
attention weighs the passages, and the weighted sum is scored. All weights are learned together
from labels of whole documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.arrow import byte_texts, map_batches
from rillflow.llm.words import Hasher, blocks, grouped, mixed, windows
from rillflow.llm.worker import kept

PASSAGE_WORDS = 64
# The sample of labelled rows that a model is fitted on, and the passages of each that are used.
TRAIN_ROWS = 6000
TRAIN_PASSAGES = 48

# Classes of bytes: letters by case, digits, blanks, line ends, bytes of other scripts, control
# characters, and each ASCII sign for itself.
UPPER, LOWER, DIGIT, BLANK, LINE_END, OTHER, CONTROL = range(7)
BYTE_CLASS = np.full(256, CONTROL, np.int64)
BYTE_CLASS[128:] = OTHER
BYTE_CLASS[ord("A") : ord("Z") + 1] = UPPER
BYTE_CLASS[ord("a") : ord("z") + 1] = LOWER
BYTE_CLASS[ord("0") : ord("9") + 1] = DIGIT
BYTE_CLASS[[9, 32]] = BLANK
BYTE_CLASS[[10, 13]] = LINE_END
for _i, _c in enumerate(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
    BYTE_CLASS[_c] = 7 + _i
N_CLASSES = 7 + 32
# Beside the classes: length, word length, distinct words, capital starts, repeated windows.
N_FEATURES = N_CLASSES + 5


def _block_features(data: bytes, bounds: np.ndarray, hasher: Hasher) -> tuple:
    """Features of the passages of some texts, and how many each text has.

    ``bounds`` are the byte offsets at which texts begin, and the end.
    """
    starts, ends, hashes = hasher.spans(data)
    texts = len(bounds) - 1
    first_word = np.searchsorted(starts, bounds)
    n_words = np.diff(first_word)
    counts = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    first_passage = np.concatenate([[0], np.cumsum(counts)])
    passages = int(first_passage[-1])
    owner = np.repeat(np.arange(texts), counts)
    order = np.arange(passages) - first_passage[owner]
    word_at = first_word[owner] + order * PASSAGE_WORDS
    raw = np.frombuffer(data, np.uint8)
    # A passage reaches from its first word to the next passage's; the first has the text's begin.
    begin = np.where(
        order == 0, bounds[owner], starts[np.minimum(word_at, max(len(starts) - 1, 0))]
        if len(starts) else 0
    )
    size = np.diff(np.concatenate([begin, [len(raw)]]))
    where = np.repeat(np.arange(passages), size)
    table = np.bincount(where * N_CLASSES + BYTE_CLASS[raw[begin[0] :]],
                        minlength=passages * N_CLASSES)
    out = np.zeros((passages, N_FEATURES), np.float32)
    out[:, :N_CLASSES] = table.reshape(passages, N_CLASSES) / np.maximum(size, 1)[:, None]
    if len(starts):
        text_of = np.repeat(np.arange(texts), n_words)
        rank = np.arange(len(starts)) - first_word[text_of]
        mine = first_passage[text_of] + rank // PASSAGE_WORDS
        here = np.bincount(mine, minlength=passages)
        some = np.maximum(here, 1)
        out[:, N_CLASSES] = here / PASSAGE_WORDS
        out[:, N_CLASSES + 1] = np.bincount(mine, ends - starts, passages) / some / 10
        distinct = mixed(hashes ^ mixed(mine.astype(np.uint64)))
        _, at = np.unique(distinct, return_index=True)
        out[:, N_CLASSES + 2] = np.bincount(mine[at], minlength=passages) / some
        capital = BYTE_CLASS[raw[starts]] == UPPER
        out[:, N_CLASSES + 3] = np.bincount(mine, capital, passages) / some
        runs = windows(hashes, 3)
        inside = text_of[: len(runs)] == text_of[2 : 2 + len(runs)]
        runs = mixed(runs[inside] ^ mixed(text_of[: len(inside)][inside].astype(np.uint64)))
        _, back, found = np.unique(runs, return_inverse=True, return_counts=True)
        again = np.bincount(mine[: len(inside)][inside], found[back] > 1, passages)
        out[:, N_CLASSES + 4] = again / some
    return out, counts


def bags(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Passage features of some whole texts at a time, and the passages each has.

    A text without words has one passage.
    """
    hasher = kept(("hasher",), Hasher)
    for group in grouped(texts):
        if len(group) == 1:
            parts = [
                _block_features(b, np.array([0, len(b)]), hasher)[0] for b in blocks(group[0])
            ] or [np.zeros((1, N_FEATURES), np.float32)]
            rows = np.concatenate(parts)
            yield rows, np.array([len(rows)])
        else:
            bounds = np.cumsum([0] + [len(x) + 1 for x in group])
            data = b"\n".join(group) + b"\n"
            yield _block_features(data, bounds, hasher)


@dataclass
class Attention:
    """Weights of encoder, gate and output, with the scale of the features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    @staticmethod
    def fit(
        rows: np.ndarray, counts: np.ndarray, labels: np.ndarray, hidden: int = 24, gate: int = 12,
        epochs: int = 40, batch: int = 128, rate: float = 0.01, decay: float = 1e-4, seed: int = 5,
    ) -> Attention:
        """Learn by Adam from bags: ``counts[i]`` rows belong to ``labels[i]``."""
        random = np.random.default_rng(seed)
        mean, scale = rows.mean(0), rows.std(0) + 1e-3
        shapes = {
            "W": (rows.shape[1], hidden), "b": (hidden,), "V": (hidden, gate), "U": (hidden, gate),
            "w": (gate,), "c": (hidden,), "d": (),
        }
        weights = {
            k: random.normal(0, 1 / np.sqrt(s[0]) if s else 0, s) if k != "b" else np.zeros(s)
            for k, s in shapes.items()
        }
        model = Attention(mean, scale, weights)
        first = np.concatenate([[0], np.cumsum(counts)])
        moment = {k: np.zeros(s) for k, s in shapes.items()}
        square = {k: np.zeros(s) for k, s in shapes.items()}
        step = 0
        for _ in range(epochs):
            order = random.permutation(len(labels))
            for at in range(0, len(order), batch):
                chosen = order[at : at + batch]
                picked = np.concatenate([np.arange(first[i], first[i + 1]) for i in chosen])
                slopes = model._slopes(rows[picked], counts[chosen], labels[chosen])
                step += 1
                for k, slope in slopes.items():
                    slope = slope + decay * weights[k]
                    moment[k] = 0.9 * moment[k] + 0.1 * slope
                    square[k] = 0.999 * square[k] + 0.001 * slope**2
                    size = np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8
                    weights[k] = weights[k] - rate * moment[k] / (1 - 0.9**step) / size
        return model

    def _forward(self, rows: np.ndarray, counts: np.ndarray) -> tuple:
        p = self.weights
        x = (rows - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        bag = np.repeat(np.arange(len(counts)), counts)
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first)
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -40, 40)))
        return x, h, t, s, a, z, score, first, bag

    def scores(self, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The score of each bag."""
        return self._forward(rows, counts)[6]

    def _slopes(self, rows: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> dict:
        """The slope of the mean log loss in each weight."""
        p = self.weights
        x, h, t, s, a, z, score, first, bag = self._forward(rows, counts)
        out = (score - labels) / len(labels)
        into_bag = out[:, None] * p["c"]
        pull = (into_bag[bag] * h).sum(1)
        energy = a * (pull - np.add.reduceat(a * pull, first)[bag])
        gated = energy[:, None] * p["w"]
        by_t, by_s = gated * s * (1 - t**2), gated * t * s * (1 - s)
        into_h = a[:, None] * into_bag[bag] + by_t @ p["V"].T + by_s @ p["U"].T
        by_x = into_h * (1 - h**2)
        return {
            "W": x.T @ by_x, "b": by_x.sum(0), "V": h.T @ by_t, "U": h.T @ by_s,
            "w": (t * s).T @ energy, "c": z.T @ out, "d": out.sum(),
        }


def held_out(doc_id: Column) -> Column:
    """True for rows whose label is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Attention | None:
    """A model from at most ``rows`` labelled documents, chosen by a hash of their ids.

    Labels of held-out rows and null labels are left out; of two labels of a document the higher
    one counts. None when no label is left.
    """
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = usable.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("quality").alias("quality")
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # The sample has at most ``rows`` rows of two numbers.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        at, marks = 0, batch.column("quality").to_pylist()
        for table, counts in bags(byte_texts(batch.column("text"))):
            ends = np.cumsum(counts)
            out = []
            for a, b in zip(ends - counts, ends):
                picked = np.unique(np.linspace(a, b - 1, min(b - a, TRAIN_PASSAGES)).astype(int))
                out.append(table[picked].astype("<f4").tobytes())
            yield {"quality": marks[at : at + len(counts)], "rows": out}
            at += len(counts)

    found = map_batches(sample, work, "quality int, rows binary").collect()
    if not found:
        return None
    found = sorted(found, key=lambda r: (r["quality"], bytes(r["rows"])))
    tables = [np.frombuffer(r["rows"], "<f4").reshape(-1, N_FEATURES) for r in found]
    counts = np.array([len(x) for x in tables])
    quality = np.array([r["quality"] for r in found], float)
    return Attention.fit(np.concatenate(tables).astype(float), counts, quality)


SCORED = "doc_id bigint, held_out boolean, score double, predicted int"


def score(docs: DataFrame, model: Attention | None) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its score and prediction.

    A null or empty text is a bag of one empty passage. Without a model every score is 0.5. A
    null doc_id is not held out. Repeated rows stay. An empty table gives an empty one.
    """
    plain = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        held_out(F.col("doc_id")).alias("held_out"),
    )

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        scores = _batch_scores(batch, model)
        yield {
            "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
            "score": scores, "predicted": (scores >= 0.5).astype(np.int32),
        }

    return map_batches(plain, work, SCORED)


def accepted(docs: DataFrame, model: Attention | None) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, source, n_chars) that are predicted good.

    Rows are scored and filtered where they are read; nothing is joined.
    """
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    plain = docs.select(*columns)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        scores = _batch_scores(batch, model)
        kept_rows = batch.filter(pa.array(scores >= 0.5))
        yield {c: kept_rows.column(c) for c in columns}

    return map_batches(plain, work, schema)


def _batch_scores(batch: pa.RecordBatch, model: Attention | None) -> np.ndarray:
    return np.concatenate([
        model.scores(table, counts) if model else np.full(len(counts), 0.5)
        for table, counts in bags(byte_texts(batch.column("text")))
    ])

"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of the lines
before and after it, with weights for the transitions between labels. Features
are shares of character classes, lengths, word shapes and repetition, worked out
for all lines of a batch at once on the texts' bytes. The marginals of the
forward-backward pass, weighted by the lines' lengths, are the document's share
of good text, and logistic regression turns that into the score.

Labels exist for documents only. Training starts with every line labelled as
its document, fits the field, relabels the lines of bad documents that it finds
clearly good, and fits again; lines of good documents stay good.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, samples, words

#: Labelled texts that are learned from, by class.
PER_CLASS = {1: 3000, 0: 3000}
THRESHOLD = 0.5
_CLASSES: list[np.ndarray] = []
NAMES = (
    "length", "letters", "upper", "digits", "stops", "symbols", "bars", "shouts", "spaces", "wide", "word_length", "word_spread", "caps",
    "symbol_ends", "distinct", "same_next", "starts_lower", "ends_stop", "few_words", "seen_before",
)


def _classes() -> list[np.ndarray]:
    if not _CLASSES:
        for chars in ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:'\"?-()", "#$%&*+/<=>@[\\]^_`{}~", "|", "!", " \t\r\f\v"):
            mask = np.zeros(256, dtype=np.uint8)
            mask[[ord(c) for c in chars]] = 1
            _CLASSES.append(mask)
        wide = np.zeros(256, dtype=np.uint8)
        wide[0xC0:] = 1
        _CLASSES.append(wide)
    return _CLASSES


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, length in bytes, features) of all lines that aren't blank, in order."""
    data, offsets = words.text_buffer(column)
    breaks = np.flatnonzero(data == 10)
    begin = np.concatenate([offsets[:-1], breaks + 1])
    end = np.concatenate([breaks, offsets[1:]])
    row = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, side="right") - 1])
    order = np.lexsort((begin, row))
    begin, row = begin[order], row[order]
    end = np.sort(end, kind="stable")
    starts, ends = words.spans(data, offsets)
    owner = np.searchsorted(begin, starts, side="right") - 1
    many = np.bincount(owner, minlength=len(begin)).astype(np.int64)
    use = np.flatnonzero(many > 0)
    number = np.full(len(begin), -1)
    number[use] = np.arange(len(use))
    owner = number[owner]
    begin, end, row, many = begin[use], end[use], row[use], many[use]
    size = (end - begin).astype(np.float64)
    n = len(use)
    if not n:
        return row, size, np.zeros((0, len(NAMES)))

    def inside(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(mask[data], out=sums[1:])
        return (sums[end] - sums[begin]).astype(np.float64)

    letters, upper, digits, stops, symbols, bars, shouts, spaces, wide = (inside(m) for m in _classes())
    body = np.maximum(1, size)
    per = lambda x: np.bincount(owner, weights=x, minlength=n) / many
    length = (ends - starts).astype(np.float64)
    mean = per(length)
    first, last = data[starts], data[ends - 1]
    kinds = _classes()
    is_upper, is_symbol = kinds[1][first].astype(np.float64), (kinds[4][last] | kinds[5][last] | kinds[6][last]).astype(np.float64)
    token = words.hashes(data, starts, ends)
    by = np.lexsort((token, owner))
    fresh = np.ones(len(by))
    fresh[1:] = (token[by][1:] != token[by][:-1]) | (owner[by][1:] != owner[by][:-1])
    distinct = np.bincount(owner[by], weights=fresh, minlength=n) / many
    repeats = np.zeros(len(token))
    repeats[1:] = (token[1:] == token[:-1]) & (owner[1:] == owner[:-1])
    head = np.searchsorted(owner, np.arange(n))
    tail = np.append(head[1:], len(owner)) - 1
    whole = words.hashes(data, begin, np.maximum(end, begin + 1))
    again = np.lexsort((np.arange(n), whole, row))
    seen = np.zeros(n)
    seen[again[1:]] = (whole[again][1:] == whole[again][:-1]) & (row[again][1:] == row[again][:-1])
    lower = (first[head] >= 97) & (first[head] <= 122)
    stop = np.isin(last[tail], np.frombuffer(b".?!:", np.uint8))
    x = np.column_stack([
        np.log1p(size) / 5, letters / body, 2 * upper / np.maximum(1, letters), digits / body * 4, stops / body * 8, np.minimum(1, symbols / body * 6), np.minimum(1, bars / body * 12),
        np.minimum(1, shouts / body * 12), spaces / body * 4, wide / body * 4, mean / 10, np.sqrt(np.maximum(0, per(length * length) - mean * mean)) / 5, per(is_upper),
        per(is_symbol), distinct, per(repeats) * 2, lower, stop, np.minimum(1, 4 / many), seen,
    ])
    return row, size, x


def framed(row: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A line's features with those of its neighbours in the text, and a constant."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    if len(x):
        same = (row[1:] == row[:-1])[:, None]
        before[1:], after[:-1] = x[:-1] * same, x[1:] * same
    return np.column_stack([x, before, after, np.ones(len(x))])


class Field:
    """Weights of the features for good against bad, and of transitions (from, to)."""

    def __init__(self, size: int):
        self.weights, self.moves = np.zeros(size), np.zeros((2, 2))
        self.text = np.array([1.0, 0.0])
        self.center, self.scale = np.zeros(size), np.ones(size)

    def marginals(self, row: np.ndarray, x: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
        """(probability of good, expected moves, sum of the texts' log partition functions) by forward-backward; ``weight``, the same for all lines of a text, weighs its moves.

        Lines are taken by their number in the text: all first lines, all second ones and so on.
        """
        n = len(x)
        energy = np.zeros((n, 2))
        energy[:, 1] = ((x - self.center) / self.scale) @ self.weights if n else 0
        if not n:
            return np.zeros(0), np.zeros((2, 2)), 0.0
        head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        count = np.diff(np.append(head, n))
        order = np.argsort(-count, kind="stable")
        head, count = head[order], count[order]
        alive = [int(np.searchsorted(-count, -k, side="left")) for k in range(int(count[0]))]  # texts with more than k lines
        moves = self.moves
        forward, back = np.zeros((n, 2)), np.zeros((n, 2))
        forward[head] = energy[head]
        for k in range(1, int(count[0])):
            at = head[: alive[k]] + k
            forward[at] = energy[at] + np.logaddexp(forward[at - 1, :1] + moves[0], forward[at - 1, 1:] + moves[1])
        for k in range(int(count[0]) - 1, 0, -1):
            at = head[: alive[k]] + k
            to = energy[at] + back[at]
            back[at - 1] = np.logaddexp(moves[:, 0] + to[:, :1], moves[:, 1] + to[:, 1:])
        total = np.logaddexp(*forward[head + count - 1].T)
        of = np.empty(n)
        of[np.concatenate([np.arange(h, h + c) for h, c in zip(head, count, strict=True)])] = np.repeat(total, count)
        good = np.exp(np.clip(forward[:, 1] + back[:, 1] - of, -700, 0))
        inner = np.flatnonzero(np.concatenate([[False], row[1:] == row[:-1]]))
        expected, mass = np.zeros((2, 2)), np.ones(len(inner)) if weight is None else weight[inner]
        for a in range(2):
            for b in range(2):
                expected[a, b] = np.exp(np.clip(forward[inner - 1, a] + moves[a, b] + energy[inner, b] + back[inner, b] - of[inner], -700, 0)) @ mass
        return good, expected, float(total.sum())

    def fit(self, row: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 120, ridge: float = 1e-3) -> None:
        """Maximum likelihood of line labels by Adam, each text's log-likelihood, lines and moves, times its ``weight``."""
        self.center, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        self.center[-1], self.scale[-1] = 0, 1
        z = (x - self.center) / self.scale
        inner = np.flatnonzero(np.concatenate([[False], row[1:] == row[:-1]]))
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[inner - 1], y[inner]), weight[inner])
        n = len(x)
        state = [np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)]
        for k in range(1, rounds + 1):
            good, expected, _ = self.marginals(row, x, weight)
            pull = np.r_[z.T @ ((y - good) * weight) / n - ridge * self.weights, ((seen - expected) / n - ridge * self.moves).ravel()]
            state = [0.9 * state[0] + 0.1 * pull, 0.99 * state[1] + 0.01 * pull * pull]
            step = 0.1 * (state[0] / (1 - 0.9**k)) / (np.sqrt(state[1] / (1 - 0.99**k)) + 1e-8) * min(1.0, 2 * (1 - k / (rounds + 1)))
            self.weights += step[:-4]
            self.moves += step[-4:].reshape(2, 2)

    def share(self, row: np.ndarray, size: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        """The length-weighted share of good text, as log odds; 0 for texts without words."""
        good, _, _ = self.marginals(row, x)
        total = np.bincount(row, weights=size, minlength=n)
        mean = np.bincount(row, weights=size * good, minlength=n) / np.maximum(total, 1)
        mean = np.clip(np.where(total > 0, mean, 0.5), 1e-4, 1 - 1e-4)
        return np.log(mean / (1 - mean))

    def probability(self, share: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(share * self.text[0] + self.text[1], -30, 30)))


def learn(texts: list[str], labels: np.ndarray) -> Field | None:
    """A field from labelled texts; None if either class is missing."""
    if not len(texts) or labels.min() == labels.max():
        return None
    row, size, x = features(pa.array(texts, pa.large_string()))
    if not len(row):
        return None
    x = framed(row, x)
    y = (labels[row] > 0).astype(np.int64)
    lines = np.bincount(row, minlength=len(texts))
    weight = (1 / np.maximum(1, lines))[row]  # every text weighs the same, and both classes do
    for k in (0, 1):
        weight[y == k] *= 0.5 * len(x) / max(1e-9, weight[y == k].sum())
    field = Field(x.shape[1])
    field.fit(row, x, y, weight)
    good, _, _ = field.marginals(row, x)
    field.fit(row, x, np.where((y == 0) & (good > 0.8), 1, y), weight)
    share = field.share(row, size, x, len(texts))
    field.text = samples.logistic(share[:, None], (labels > 0).astype(float), ridge=1e-3)
    return field


def score(docs: DataFrame, field: Field | None, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every row, repeated ones alike; texts that are null, empty or blank score as half good, and 0.5 without a field. An empty table gives no rows."""

    def run(batches):
        for batch in common.pieces(batches, 1):
            n = batch.num_rows
            if field is None:
                p = np.full(n, 0.5)
            else:
                row, size, x = features(batch.column(1))
                p = field.probability(field.share(row, size, framed(row, x), n))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return common.arrow(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), run, "doc_id long, score double, predicted int")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    held = common.remainder("doc_id", 3) == 1
    field = learn(*samples.labelled(docs, labels, "quality", ~held, PER_CLASS))
    return score(docs, field).select("doc_id", held.alias("held_out"), "score", "predicted")

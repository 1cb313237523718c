"""Toxicity with a subsequence string kernel, Nystroem landmarks and a linear SVM on labelled sentences.

The kernel of two words sums over all common subsequences of three characters,
each weighted by a decay to the power of the lengths that it spans in both, so
an insult with inserted characters or gaps stays close to the insult. A word's
features are its normalised kernels with a few landmark words, whitened by the
landmarks' own kernel matrix. Letters that stand alone in a row (``i d i o t``)
are joined to one word; a word longer than a window goes through in overlapping
windows, in training and in scoring.

A sentence is as toxic as its most toxic word: its margin is the largest of its
words' margins. Labels are the texts': every sentence of a clean text is clean,
and of a toxic text the sentence with the largest margin is toxic. So training
goes in rounds: find the word that decides each labelled sentence, fit a linear
SVM to these, with a sentence of a clean text against one of a toxic text, and
decide anew. It begins with words that cover most toxic texts and next to no
others, and with these in disguise, a character put into each gap. A text's
score comes from its largest word margins by logistic regression.

All texts are scored whole; equal words are scored once per batch.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, samples, words

ORDER, DECAY, WINDOW = 3, 0.6, 20
#: Labelled texts that are learned from, by class; words whose margins a worker keeps.
PER_CLASS, KEPT = {1: 2500, 0: 4500}, 1_000_000
#: What the fit is bounded by: landmarks among words that tell toxic texts and among frequent words, rounds, sentences of clean texts in a round (the largest margins), of toxic texts (all, one each).
INSULTS, CLEAN, ROUNDS, CLEAN_SENTENCES = 40, 24, 4, 6000
THRESHOLD = 0.3
#: Bytes of text that are scored at once.
PIECE = 1 << 21


def codes(items: list[str], width: int = WINDOW) -> np.ndarray:
    """Words as rows of code points, 0 beyond their ends."""
    out = np.zeros((len(items), width), dtype=np.uint32)
    for i, w in enumerate(items):
        row = np.frombuffer(w[:width].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        out[i, : len(row)] = row
    return out


def kernel(a: np.ndarray, b: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """The gap-weighted subsequence kernel between all rows of a and all rows of b.

    ``prefix[l]`` at (i, j) sums the pairs of subsequences of length l within
    the first i and j characters, decayed up to there; the recursion runs over
    i and j for all pairs of words at once.
    """
    na, la, nb, lb = len(a), int((a > 0).sum(axis=1).max(initial=0)), len(b), int((b > 0).sum(axis=1).max(initial=0))
    total = np.zeros((na, nb), dtype=np.float32)
    decay, square = np.float32(decay), np.float32(decay * decay)
    before = np.zeros((order, lb + 1, na, nb), dtype=np.float32)
    before[0] = 1
    for i in range(la):
        now = np.zeros_like(before)
        now[0] = 1
        run = np.zeros((order, na, nb), dtype=np.float32)
        for j in range(lb):
            same = (a[:, i, None] == b[None, :, j]) & (a[:, i, None] > 0)
            if not same.any():
                for k in range(1, order):
                    run[k] *= decay
                    now[k, j + 1] = decay * before[k, j + 1] + run[k]
                continue
            for k in range(1, order):
                run[k] = decay * run[k] + np.where(same, square * before[k - 1, j], 0)
                now[k, j + 1] = decay * before[k, j + 1] + run[k]
            total += np.where(same, square * before[order - 1, j], 0)
        before = now
    return total


def own(a: np.ndarray) -> np.ndarray:
    """Each row's kernel with itself."""
    n, width = a.shape
    out = np.zeros(n, dtype=np.float32)
    decay, square = np.float32(DECAY), np.float32(DECAY * DECAY)
    before = np.zeros((ORDER, width + 1, n), dtype=np.float32)
    before[0] = 1
    for i in range(width):
        now, run = np.zeros_like(before), np.zeros((ORDER, n), dtype=np.float32)
        now[0] = 1
        for j in range(width):
            same = (a[:, i] == a[:, j]) & (a[:, i] > 0)
            for k in range(1, ORDER):
                run[k] = decay * run[k] + np.where(same, square * before[k - 1, j], 0)
                now[k, j + 1] = decay * before[k, j + 1] + run[k]
            out += np.where(same, square * before[ORDER - 1, j], 0)
        before = now
    return out


def triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j, k) of all subsequences of three characters of a word, and the decay that each spans."""
    if length not in _TRIPLES:
        at = np.array(list(combinations(range(length), ORDER)), dtype=np.int64).reshape(-1, ORDER)
        _TRIPLES[length] = (at, (DECAY ** (at[:, -1] - at[:, 0] + 1)).astype(np.float32))
    return _TRIPLES[length]


_TRIPLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def marked(items: list[str]) -> list[str]:
    """Words with a mark at their start, so that how a word begins counts."""
    return [f"^{w}" for w in items]


def windows(items: list[str]) -> tuple[list[str], np.ndarray]:
    """The marked windows that words are taken by, and the word of each; none for words under three characters."""
    rows, owner = [], []
    for i, w in enumerate(items):
        for form in (w,) if w.isalnum() else (w, "".join(c for c in w if c.isalnum())):
            if len(form) >= ORDER:
                form = f"^{form}"
                for at in range(0, max(1, len(form) - WINDOW // 2), WINDOW // 2):
                    rows.append(form[at : at + WINDOW])
                    owner.append(i)
    return rows, np.array(owner, dtype=np.int64)


class Model:
    """Landmarks, what whitens their kernels, the SVM's weights and the text's logistic weights.

    The kernel's feature space is spelled out for the subsequences that occur
    in landmarks, as no others count: a word's kernels with all landmarks are
    its decayed counts of those times the landmarks', and the SVM's margin is a
    sum of one weight for each of its subsequences, over the word's own norm.
    """

    def __init__(self, landmarks: list[str]):
        self.landmarks = codes(landmarks)
        self.alphabet = np.unique(self.landmarks[self.landmarks > 0])
        self.base = len(self.alphabet) + 1
        scale = np.sqrt(np.maximum(own(self.landmarks), 1e-12))
        known: dict[int, np.ndarray] = {}
        for m, row in enumerate(self.landmarks):
            gram, decay = self.grams(row[None, : max(1, int((row > 0).sum()))])
            for g, d in zip(gram[0].tolist(), decay, strict=True):
                known.setdefault(g, np.zeros(len(self.landmarks), np.float32))[m] += d / scale[m]
        self.grams_known = np.array(sorted(known), dtype=np.int64)
        self.parts = np.stack([known[g] for g in self.grams_known]) if known else np.zeros((0, len(self.landmarks)), np.float32)
        gram = self.raw(self.landmarks)
        value, vector = np.linalg.eigh(gram.astype(np.float64))
        use = value > 1e-3
        self.whiten = (vector[:, use] / np.sqrt(value[use])).astype(np.float32)
        self.text = np.array([1.0, 0.0, 0.0, 0.0])
        self.weigh(np.zeros(use.sum() + 1))

    def weigh(self, weights: np.ndarray) -> None:
        self.weights = weights
        self.table = np.zeros(self.base**ORDER, dtype=np.float32)
        self.table[self.grams_known] = self.parts @ (self.whiten @ weights[:-1]).astype(np.float32)

    def grams(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all subsequences of words of one length, and their decays; characters of no landmark are 0."""
        at, decay = triples(rows.shape[1])
        place = np.minimum(np.searchsorted(self.alphabet, rows), max(0, len(self.alphabet) - 1))
        number = np.where(self.alphabet[place] == rows, place + 1, 0) if len(self.alphabet) else np.zeros_like(place)
        out = np.zeros((len(rows), len(at)), dtype=np.int64)
        for k in range(ORDER):
            out = out * self.base + number[:, at[:, k]]
        return out, decay

    def by_length(self, rows: np.ndarray, limit: int = 1 << 20):
        """(indexes, words of one length) in parts of bounded size."""
        length = (rows > 0).sum(axis=1)
        for n in np.unique(length):
            which = np.flatnonzero(length == n)
            step = max(1, limit // max(1, len(triples(int(n))[0])))
            for at in range(0, len(which), step):
                yield which[at : at + step], rows[which[at : at + step], : max(1, int(n))]

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """Normalised kernels with all landmarks."""
        out = np.zeros((len(rows), len(self.landmarks)), dtype=np.float32)
        place = np.full(self.base**ORDER, len(self.grams_known))
        place[self.grams_known] = np.arange(len(self.grams_known))
        width = len(self.grams_known) + 1
        for which, some in self.by_length(rows, 1 << 18):
            gram, decay = self.grams(some)
            for at in range(0, len(some), 512):
                part = place[gram[at : at + 512]]
                cell = part + np.arange(len(part))[:, None] * width
                counts = np.bincount(cell.ravel(), weights=np.broadcast_to(decay, part.shape).ravel(), minlength=len(part) * width).reshape(-1, width)
                out[which[at : at + 512]] = counts[:, :-1].astype(np.float32) @ self.parts
            out[which] /= np.sqrt(np.maximum(own(some), 1e-12))[:, None]
        return out

    def features(self, rows: np.ndarray) -> np.ndarray:
        return self.raw(rows) @ self.whiten

    def margins(self, items: list[str]) -> np.ndarray:
        """The margin of every word, between -8 and 8; -8 for words under three characters.

        A long word's margin is the largest of its windows; a word with
        punctuation inside is taken without it as well.
        """
        out = np.full(len(items), -8.0)
        rows, owner = windows(items)
        for at in range(0, len(rows), 32768):
            part = codes(rows[at : at + 32768])
            value = np.empty(len(part))
            for which, some in self.by_length(part):
                gram, decay = self.grams(some)
                value[which] = (self.table[gram] * decay).sum(axis=1) / np.sqrt(np.maximum(own(some), 1e-12)) + self.weights[-1]
            np.maximum.at(out, owner[at : at + 32768], np.clip(value, -8, 8))
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.text[:-1] + self.text[-1], -30, 30)))


def svm(x: np.ndarray, y: np.ndarray, each: np.ndarray, c: float = 1.0, rounds: int = 50) -> np.ndarray:
    """A linear SVM with squared hinge loss, both classes weighing the same and rows in them by ``each``, by Newton steps; the constant is last."""
    x = np.column_stack([x.astype(np.float64), np.ones(len(x))])
    sign = np.where(y > 0, 1.0, -1.0)
    weight = np.where(y > 0, 0.5 / max(1e-9, each[y > 0].sum()), 0.5 / max(1e-9, each[y <= 0].sum())) * each * c * len(y)
    w = np.zeros(x.shape[1])
    ridge = np.ones(len(w)) * 0.05
    ridge[-1] = 1e-6
    for _ in range(rounds):
        active = sign * (x @ w) < 1
        xa = x[active]
        new = np.linalg.solve((xa * weight[active, None]).T @ xa + np.diag(ridge), xa.T @ (weight[active] * sign[active]))
        if np.abs(new - w).max() < 1e-7:
            break
        w = 0.5 * (w + new)
    return w


def units(column: pa.Array):
    """(hashes, text of each, function from positions to words): all words, and rows of single letters joined at the end."""
    data, offsets = words.text_buffer(column)
    starts, ends = words.spans(data, offsets)
    # punctuation at a word's edges does not belong to it
    edge = np.zeros(256, dtype=bool)
    edge[[i for i in range(33, 127) if not chr(i).isalnum()]] = True
    for _ in range(6):
        starts = starts + (edge[data[np.minimum(starts, len(data) - 1)]] & (ends - starts > 1)) if len(starts) else starts
        ends = ends - (edge[data[ends - 1]] & (ends - starts > 1)) if len(ends) else ends
    text = np.searchsorted(offsets, starts, side="right") - 1
    hashes = words.hashes(data, starts, ends)
    raw = data.tobytes()
    joined: list[bytes] = []
    joined_text: list[int] = []
    single = (ends - starts) == 1
    if len(single) > 2:
        runs = np.flatnonzero(single[:-2] & single[1:-1] & single[2:] & (text[:-2] == text[2:]))
        at = 0
        while at < len(runs):
            i = int(runs[at])
            j = i
            while j < len(single) and single[j] and text[j] == text[i]:
                j += 1
            joined.append(b"".join(raw[s : s + 1] for s in starts[i:j]))
            joined_text.append(int(text[i]))
            at = int(np.searchsorted(runs, j))
    if joined:
        packed = b"".join(joined)
        ends_j = np.cumsum([len(j) for j in joined])
        more = words.hashes(np.frombuffer(packed, np.uint8), ends_j - [len(j) for j in joined], ends_j)
        hashes, text = np.concatenate([hashes, more]), np.concatenate([text, np.array(joined_text)])
    n = len(starts)
    word = lambda i: (raw[starts[i] : ends[i]] if i < n else joined[i - n]).decode("utf-8", "replace").lower()
    return hashes, text, word


def summary(text: np.ndarray, margin: np.ndarray, n: int) -> np.ndarray:
    """For each text: its largest margin, the second largest, and how much lies above 0."""
    out = np.full((n, 3), -8.0)
    out[:, 2] = 0
    if len(text):
        margin = margin[np.lexsort((-margin, text))]
        text = np.sort(text)
        first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        out[text[first], 0] = margin[first]
        second = first[np.diff(np.append(first, len(text))) > 1] + 1
        out[text[second], 1] = margin[second]
        out[:, 2] = np.log1p(np.bincount(text, weights=np.maximum(margin, 0), minlength=n))
    return out


def disguised(insults: list[str], rng: np.random.Generator) -> list[str]:
    """Insults with one more character in each of their gaps, which a learner should know from the start."""
    letters = sorted(set("".join(insults)))
    return [w[:i] + letters[rng.integers(len(letters))] + w[i:] for w in insults if len(w) > ORDER for i in range(1, len(w))]


def sentences(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, object]:
    """(hash, text, sentence of each word, function from positions to words): sentences end at ``.``, ``!``, ``?`` and line ends; joined letters belong to none but their text."""
    hashes, text, word = units(column)
    data, offsets = words.text_buffer(column)
    starts, _ = words.spans(data, offsets)
    ends = np.zeros(256, dtype=bool)
    ends[list(b".!?\n")] = True
    sentence = np.searchsorted(np.flatnonzero(ends[data]), starts) + np.searchsorted(offsets, starts, side="right")
    own = int(sentence.max(initial=0)) + 1 + text[len(starts) :]  # a sentence of its own for what is joined in a text
    return hashes, text, np.concatenate([sentence, own]), word


def deciding(key: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """The places of the largest margin of every key."""
    order = np.lexsort((-margin, key))
    return order[np.concatenate([np.ones(min(1, len(order)), bool), key[order][1:] != key[order][:-1]])]


def learn(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model | None:
    """A model from labelled texts; None if either class is missing. Equal texts count once, the last label holds."""
    if not (labels > 0).any() or not (labels <= 0).any():
        return None
    once = list({t: int(y) for t, y in zip(texts, labels, strict=True)}.items())
    texts, labels = [t for t, _ in once], np.array([y for _, y in once])
    hashes, text, sentence, word = sentences(pa.array(texts, pa.large_string()))
    distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
    names = [word(i) for i in at]
    del hashes
    seen = np.unique(which << 32 | text)  # a word counts once in a text
    seen = seen >> 32, seen & 0xFFFFFFFF
    toxic = labels[seen[1]] > 0
    pos, neg = np.bincount(seen[0][toxic], minlength=len(distinct)), np.bincount(seen[0][~toxic], minlength=len(distinct))
    positives, negatives = int((labels > 0).sum()), int((labels <= 0).sum())
    # greedy cover of the toxic texts by words that are rare in others
    able = np.flatnonzero((pos >= 2) & (neg <= 0.002 * negatives * (pos / positives)))
    able = able[[len(names[i]) >= ORDER for i in able]] if len(able) else able
    index = np.full(len(distinct), -1)
    index[able] = np.arange(len(able))
    mine = (index[seen[0]] >= 0) & toxic
    pairs_word, pairs_text = index[seen[0][mine]], seen[1][mine]
    open_ = np.ones(len(texts), dtype=bool)
    insults: list[int] = []
    while len(insults) < INSULTS and len(able):
        gain = np.bincount(pairs_word[open_[pairs_text]], minlength=len(able))
        best = int(gain.argmax())
        if gain[best] < max(2, 0.002 * positives):
            break
        insults.append(int(able[best]))
        open_[pairs_text[pairs_word == best]] = False
    if len(insults) < INSULTS and len(able):  # more of those that come back most often in texts covered already
        often = able[np.argsort(-pos[able], kind="stable")]
        insults += [int(i) for i in often if i not in set(insults) and pos[i] >= 0.02 * positives][: INSULTS - len(insults)]
    if not insults:
        return None
    bad = [names[i] for i in insults]
    frequent = [names[i] for i in np.argsort(-neg, kind="stable") if neg[i] > 0 and len(names[i]) >= ORDER][:CLEAN]
    model = Model(marked(list(dict.fromkeys(bad + frequent))))
    masked = disguised(bad, np.random.default_rng(seed))
    x_bad = model.features(codes(marked(bad + masked)))
    each = np.r_[np.ones(len(bad)), np.full(len(masked), 0.25 * len(bad) / max(1, len(masked)))]
    del seen, toxic, mine, pairs_word, pairs_text
    margin = -neg.astype(np.float64)  # at first a clean sentence is decided by its rarest word, a toxic one by a word of the cover
    margin[insults] = 1 + pos[insults]
    clean = labels[text] <= 0
    for round_ in range(ROUNDS):
        good = np.flatnonzero(clean)
        good = good[deciding(sentence[good], margin[which[good]])]
        good, n_good = np.unique(which[good], return_counts=True)
        top = np.argsort(-margin[good], kind="stable")[:CLEAN_SENTENCES]
        good, n_good = good[top], n_good[top]
        sure = np.flatnonzero(~clean)
        sure = sure[deciding(text[sure], margin[which[sure]])]  # the sentence, and in it the word, with the largest margin of each toxic text
        sure = sure[(margin[which[sure]] > 0) & (neg[which[sure]] <= 0.01 * negatives)] if round_ else sure[:0]
        hit, n_hit = np.unique(which[sure], return_counts=True)
        rows, owner = windows([names[i] for i in np.concatenate([good, hit])])
        x = model.features(codes(rows))
        y = owner >= len(good)
        if y.any():  # of a long word's windows the one with the largest margin decides
            decided = x @ model.weights[:-1]
            keep = deciding(owner, decided)
            keep = np.concatenate([np.flatnonzero(~y), keep[y[keep]]])
            x, owner, y = x[keep], owner[keep], y[keep]
        many = np.sqrt(np.concatenate([n_good, n_hit])[owner])
        weight = np.r_[each * max(1.0, many[y].sum() / max(1e-9, each.sum()) if y.any() else 1.0), many]
        model.weigh(svm(np.concatenate([x_bad, x]), np.r_[np.ones(len(x_bad)), y], weight))
        margin = model.margins(names)
    model.text = samples.logistic(summary(text, margin[which], len(texts)), (labels > 0).astype(float), ridge=1.0)
    return model


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every row, repeated ones alike; texts that are null, empty or without words score what no margin scores, 0 without a model. An empty table gives no rows."""

    def run(batches):
        known, value = np.zeros(0, np.uint64), np.zeros(0)
        for batch in common.pieces(batches, 1, PIECE):
            n = batch.num_rows
            if model is None:
                p = np.zeros(n)
            else:
                hashes, of, word = units(batch.column(1))
                distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
                place = np.minimum(np.searchsorted(known, distinct), max(0, len(known) - 1))
                hit = known[place] == distinct if len(known) else np.zeros(len(distinct), bool)
                margin = np.empty(len(distinct))
                margin[hit] = value[place[hit]]
                margin[~hit] = model.margins([word(i) for i in at[~hit]])
                if len(known) > KEPT:
                    known, value = distinct, margin
                else:
                    every = np.concatenate([known, distinct[~hit]])
                    order = np.argsort(every, kind="stable")
                    known, value = every[order], np.concatenate([value, margin[~hit]])[order]
                p = model.probability(summary(of, margin[which], n))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return common.arrow(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), run, "doc_id long, score double, predicted int")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    held = common.remainder("doc_id", 4) == 2
    model = learn(*samples.labelled(docs, labels, "toxic", ~held, PER_CLASS))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")

"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of a trigram binds
those of its letters: the first one's permuted twice, the second one's once,
the third one's as it is, multiplied element by element; everything that is no
letter counts as one and the same separator. A document's vector bundles the
vectors of its trigrams, that is, adds them up, and so does a language's
prototype those of its documents, each at unit length. A document's language is
the prototype with the largest cosine.

In a batch, the trigrams' counts are one matrix and the distinct trigrams'
vectors another, so bundling is a matrix product, summed over a bounded number
of trigrams at a time; a long text adds up piece by piece, each with the two
letters before it, so no trigram is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, words

DIMENSIONS, SEED = 1024, 20
#: Prototypes are made from about so many documents of a language at most, chosen by a hash of their ids.
DOCS_PER_LANGUAGE = 6000
UND = "und"
#: Rows and characters that are bundled together, trigrams of a matrix product, letters whose vectors a worker keeps.
_ROWS, _PIECE, _GRAMS, _KEPT = 64, 1 << 19, 8192, 4000
_LETTERS: dict[int, np.ndarray] = {}
common.CACHES[__name__] = _LETTERS
_KIND: list[np.ndarray] = []


def letter(code: int) -> np.ndarray:
    """The vector of a code point, 0 being the separator: made from its own seed, the same everywhere."""
    found = _LETTERS.get(code)
    if found is None:
        if len(_LETTERS) >= _KEPT:
            _LETTERS.clear()
        bits = words.mix(np.arange(DIMENSIONS, dtype=np.uint64) + np.uint64((code * 0x9E3779B97F4A7C15 + SEED) & (2**64 - 1))) >> np.uint64(63)
        found = _LETTERS[code] = bits.astype(np.float32) * 2 - 1
    return found


def letters(text: str) -> np.ndarray:
    """Lower-cased code points of the letters, all else 0, with a separator at each end."""
    if not _KIND:
        kind = np.zeros(0x110000, dtype=bool)
        kind[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        _KIND.append(kind)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.zeros(len(codes) + 2, dtype=np.uint32)
    out[1:-1] = np.where(_KIND[0][codes], codes, 0)
    return out


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bundled vector of every text, and how many letters it has; runs of separators count once."""
    rows = [letters(t) for t in texts]
    has = np.array([np.count_nonzero(r) for r in rows])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint32)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    stay = np.ones(len(flat), dtype=bool)
    stay[1:] = (flat[1:] != 0) | (flat[:-1] != 0) | (owner[1:] != owner[:-1])
    flat, owner = flat[stay], owner[stay]
    out = np.zeros((len(rows), DIMENSIONS), dtype=np.float32)
    for at in range(0, len(flat) - 2, _PIECE):
        _bundle(flat[at : at + _PIECE + 2], owner[at : at + _PIECE + 2], out)
    return out, has


def _bundle(flat: np.ndarray, owner: np.ndarray, out: np.ndarray) -> None:
    """Adds the vectors of all trigrams to the rows that own them."""
    alphabet, code = _compact(flat)
    size = len(alphabet)
    whole = owner[:-2] == owner[2:]
    gram, owner = ((code[:-2] * size + code[1:-1]) * size + code[2:])[whole], owner[:-2][whole]
    if size**3 <= 1 << 22:
        grams = np.flatnonzero(np.bincount(gram, minlength=size**3)) if len(gram) else gram
        number = np.zeros(size**3, dtype=np.int64)
        number[grams] = np.arange(len(grams))
        gram = number[gram]
    else:
        grams, gram = np.unique(gram, return_inverse=True)
    many = len(grams) > _GRAMS
    order = np.argsort(gram, kind="stable") if many else slice(None)
    gram, owner = gram[order], owner[order]
    for at in range(0, len(grams), _GRAMS):
        some = grams[at : at + _GRAMS]
        use = slice(*np.searchsorted(gram, (at, at + len(some)))) if many else slice(None)
        counts = np.bincount(owner[use] * len(some) + gram[use] - at, minlength=len(out) * len(some)).reshape(len(out), -1).astype(np.float32)
        which = np.concatenate([some // (size * size), some // size % size, some % size])
        own, which = (np.arange(size), which) if size <= 256 else np.unique(which, return_inverse=True)
        table = np.stack([letter(int(alphabet[k])) for k in own])
        first, second, third = which.reshape(3, -1)
        bound = np.roll(table, 2, axis=1)[first]
        bound *= np.roll(table, 1, axis=1)[second]
        bound *= table[third]
        out += counts @ bound


def _compact(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = int(flat.max(initial=0)) + 1
    seen = np.zeros(top, dtype=bool)
    seen[flat] = True
    alphabet = np.flatnonzero(seen)
    number = np.zeros(top, dtype=np.int64)
    number[alphabet] = np.arange(len(alphabet))
    return alphabet, number[flat]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _slices(texts: list[str]):
    """Few rows and not many characters at a time, which bounds the matrices."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and to - at < _ROWS and (to == at or size + len(texts[to]) <= _PIECE):
            size += len(texts[to])
            to += 1
        yield at, to
        at = to


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", per_language: int = DOCS_PER_LANGUAGE) -> dict[str, np.ndarray]:
    """A prototype for each language of the labelled rows; null languages and texts teach nothing.

    About ``per_language`` documents of each language are used: a hash of the id
    decides, with a share worked out from the language's count. Only the
    prototypes, a vector for each language, come to the driver. A null id is
    an id like any; a repeated row counts each time.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy(F.col(lang).alias("lang")).count().collect()}  # a row for each language
    if not counts:
        return {}
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, per_language / n)))])
    chance = F.pmod(F.xxhash64(F.lit(SEED), F.coalesce(F.col(doc_id).cast("string"), F.col(text))), F.lit(1 << 20)) / float(1 << 20)
    rows = rows.where(chance < share[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in common.pieces(batches, 1):
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in _slices(texts):
                found, _ = vectors(texts[a:b])
                for name, v in zip(langs[a:b], _unit(found).astype(np.float64), strict=True):
                    sums[name] = sums.get(name, 0) + v
        for name, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(np.round(v * 2**20).astype(np.int64))], ["lang", "at", "v"])

    parts = common.arrow(rows, run, "lang string, at int, v long").groupBy("lang", "at").agg(F.sum("v").alias("v"))
    out: dict[str, np.ndarray] = {}
    for r in parts.collect():  # dimensions times languages
        out.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["at"]] = r["v"]
    return {k: _unit(v) for k, v in sorted(out.items())}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: tuple[str, ...] = ("doc_id",), text: str = "text", names_out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns ``keep``, lang_pred and score (or what ``names_out`` says), the cosine, 0 at least.

    A text that is null or has no letter, or any text if there are no
    prototypes, gets ``und`` and 0. Equal cosines go to the first language by
    code point. Repeated rows are judged alike, an empty table gives no rows.
    """
    names = list(prototypes)
    matrix = np.stack([prototypes[n] for n in names]).astype(np.float32) if names else np.zeros((0, DIMENSIONS), np.float32)
    rows = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches):
        for batch in common.pieces(batches, len(keep)):
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            langs, scores = [], []
            for a, b in _slices(texts):
                found, has = vectors(texts[a:b])
                cosine = _unit(found) @ matrix.T if names else np.zeros((b - a, 1))
                best = cosine.argmax(axis=1)
                sure = (has > 0) & bool(names)
                langs += [names[k] if ok else UND for k, ok in zip(best, sure, strict=True)]
                scores += np.where(sure, np.clip(cosine[np.arange(b - a), best], 0, 1), 0.0).astype(float).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*keep, *names_out])

    return common.arrow(rows, run, f"{schema}, `{names_out[0]}` string, `{names_out[1]}` double")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    held = common.remainder("doc_id", 4) == 2
    out = identify(docs, learn(docs.where(~held)))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")

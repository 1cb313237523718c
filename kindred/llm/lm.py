"""N-gram language model: interpolated modified Kneser-Ney, trigrams unless asked for bigrams.

Plan. A first pass adds up how often the words of each of 65536 ranges of the
word hash occur. Ranges are packed into shards of about equal counts, by the
context's last word; a range that alone holds more than a shard's part, as that
of a very frequent word, is split over several shards by the hash of the word
before. So all n-grams of a context meet in one shard, and no shard gets more
than its part.

Counting. A task counts the n-grams of its texts in sorted arrays and sends
each shard its part with a dictionary of the words in it. A shard merges its
parts and writes sorted hash arrays to the shared folder: trigrams with their
counts, their contexts with totals and how many words follow them once, twice
and more often, and the same for bigrams; those of a split range are summed
over its shards first. What a shard knows of single words adds up by ranges of
the hash to the files of words. The driver sees a few sums and the names of the
files, never the counts.

Storage. A sorted hash array cuts a key into a range, of which there are about
a quarter as many as keys, and 28 more bits; next to these lies a value of 4
bits, and values that don't fit lie apart. So an n-gram takes five bytes, and
one that was never counted is taken for another with a chance of about 2**-25.

Scoring. Workers map the arrays into memory and look words up in sorted order,
batch by batch, so pages are read one after another and shared by all workers
of a machine. Files in a store without a local path are read into memory.

Probabilities of a word w after u v, with counts c and discounts D by count:
``P(w|uv) = (c(uvw) - D(c(uvw))) / c(uv.) + g(uv) P(w|v)``, where g(uv) is the
mass that the discounts leave. P(w|v) is made the same way from the number of
different words before v w, and P(w) from that before w, backing off to
1 / (V + 1) for any word. Nothing stands before a text's begin, so its first
word starts at P(w|begin), which takes real counts, and a context that was
never seen leaves all to the shorter one. With order 2, P(w|v) takes real
counts for all.
"""

from __future__ import annotations

import mmap
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, words

_U = np.uint64
#: Hashes of what stands before the first word and after the last, and of what stands before the begin.
BEGIN, END, NOTHING = _U(0x0123456789ABCDEF), _U(0xFEDCBA9876543210), _U(0)
#: Tokens that a task counts before it sends its counts on; words of context and the word itself; ranges of the word hash; shards at least, and tokens of a shard, about.
COUNTED, ORDER, CELLS, SHARDS, SHARD_TOKENS = 4_000_000, 3, 1 << 16, 64, 2_000_000


def sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, token, bounds): every text's words and one end, each with what stands before it."""
    word, bounds = words.tokens(column)
    n = np.diff(bounds)
    at = bounds + np.arange(len(bounds))
    token = np.empty(at[-1], dtype=np.uint64)
    inner = np.ones(at[-1], dtype=bool)
    inner[at[1:] - 1] = False
    token[inner], token[~inner] = word, END
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[at[:-1]] = BEGIN
    return before, token, at if len(n) else np.zeros(1, np.int64)


def earlier(before: np.ndarray) -> np.ndarray:
    """What stands before each token's context; NOTHING before a begin."""
    out = np.empty_like(before)
    out[1:] = before[:-1]
    out[before == BEGIN] = NOTHING
    return out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, a place of each, and each row's number among them."""
    order = np.argsort(keys)
    fresh = np.zeros(len(order), dtype=bool)
    at = _runs(keys[order])
    fresh[at] = True
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(fresh) - 1
    return keys[order[at]], order[at], number


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys in order, and the sums of each one's values."""
    order = np.argsort(keys)
    keys = keys[order]
    at = _runs(keys)
    return keys[at], *(np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    fresh = np.zeros(len(columns[0]), dtype=bool)
    fresh[:1] = True
    for c in columns:
        fresh[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(fresh)


def _together(*ids: np.ndarray) -> np.ndarray:
    """Rows of small numbers as one number each that keeps their order, where their bits fit; else as places among the distinct rows."""
    bits = [max(1, int(x.max(initial=0)).bit_length()) for x in ids]
    if sum(bits) > 64:
        order = np.lexsort(ids[::-1])
        place = np.zeros(len(order), dtype=np.uint64)
        fresh = np.zeros(len(order), dtype=bool)
        fresh[_runs(*(x[order] for x in ids))] = True
        place[order] = np.cumsum(fresh)
        return place
    out = np.zeros(len(ids[0]), dtype=np.uint64)
    for x, n in zip(ids, bits, strict=True):
        out = (out << _U(n)) | x.astype(np.uint64)
    return out


# Blobs: arrays of whole numbers, byte by byte, compressed.


def _blob(x: np.ndarray) -> bytes:
    x = x.astype(np.min_scalar_type(int(x.max(initial=0))))
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T
    return bytes([x.itemsize]) + len(x).to_bytes(5, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unblob(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:6], "little")
    planes = np.frombuffer(pa.decompress(data[6:], width * n, codec="zstd"), dtype=np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel()


def _sorted_blob(x: np.ndarray) -> bytes:
    """Of distinct numbers in order, by their differences."""
    return _blob(np.diff(x, prepend=x.dtype.type(0)))


def _unsorted_blob(data: bytes) -> np.ndarray:
    return np.cumsum(_unblob(data).astype(np.uint64), dtype=np.uint64)


# Files: arrays one after another, found by a layout that goes along with the name.


def _store(path: str) -> tuple:
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _write(folder: str, arrays: dict[str, np.ndarray | bytes]) -> str:
    """Writes arrays one after another under a name of its own, so that an attempt that fails leaves nothing that is used."""
    store, inner = _store(folder)
    store.create_dir(inner, recursive=True)
    name = uuid.uuid4().hex
    layout, at = [], 0
    with store.open_output_stream(f"{inner}/{name}") as out:
        for key, a in arrays.items():
            data = np.frombuffer(a, np.uint8) if isinstance(a, bytes) else np.ascontiguousarray(a)
            pad = -at % 8
            out.write(b"\0" * pad + data.tobytes())
            layout.append(f"{key}:{data.dtype.str}:{at + pad}:{len(data)}")
            at += pad + data.nbytes
    return f"{name}|{','.join(layout)}"


def _layout(written: str) -> tuple[str, dict[str, tuple[str, int, int]]]:
    name, _, layout = written.partition("|")
    return name, {k: (kind, int(at), int(n)) for k, kind, at, n in (x.split(":") for x in layout.split(",") if x)}


def _part(folder: str, written: str, key: str) -> bytes:
    """One array of a file, as bytes."""
    name, layout = _layout(written)
    kind, at, n = layout[key]
    store, inner = _store(folder)
    with store.open_input_file(f"{inner}/{name}") as source:
        return source.read_at(n * np.dtype(kind).itemsize, at)


_MAPPED: dict = {}
common.CACHES[__name__] = _MAPPED


def _mapped(folder: str, written: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory once per worker."""
    name, layout = _layout(written)
    if (folder, name) not in _MAPPED:
        store, inner = _store(folder)
        if store.type_name == "local":
            with open(f"{inner}/{name}", "rb") as handle:
                data = mmap.mmap(handle.fileno(), 0, access=mmap.ACCESS_READ) if any(n for _, _, n in layout.values()) else b""
        else:
            with store.open_input_stream(f"{inner}/{name}") as source:
                data = source.read()
        _MAPPED[folder, name] = {k: np.frombuffer(data, dtype=kind, count=n, offset=at) if n else np.zeros(0, kind) for k, (kind, at, n) in layout.items()}
    return _MAPPED[folder, name]


# Sorted hash arrays.


def _hashed(name: str, key: np.ndarray, value: np.ndarray) -> dict[str, np.ndarray]:
    """A sorted hash array of values from 1 on; ``look`` reads it."""
    order = np.argsort(key)
    key, value = key[order], value[order].astype(np.int64)
    bits = max(1, (len(key) // 4).bit_length())
    top = np.searchsorted(key >> _U(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.uint32)
    rest = ((key << _U(bits)) >> _U(36)).astype(np.uint32)
    large = np.flatnonzero(value >= 15)
    return {f"{name}top": top, f"{name}low": rest << np.uint32(4) | np.minimum(value, 15).astype(np.uint32), f"{name}x_at": large.astype(np.uint32), f"{name}x": value[large]}


def look(arrays: dict[str, np.ndarray], name: str, asked: np.ndarray) -> np.ndarray:
    """Each key's value, 0 where it is not there."""
    top, rows = arrays[f"{name}top"], arrays[f"{name}low"]
    out = np.zeros(len(asked), dtype=np.int64)
    if not len(rows):
        return out
    bits = (len(top) - 1).bit_length() - 1
    cell = (asked >> _U(64 - bits)).astype(np.int64)
    rest = ((asked << _U(bits)) >> _U(36)).astype(np.uint32)
    low, high = top[cell].astype(np.int64), top[cell + 1].astype(np.int64)
    end = high.copy()
    for _ in range(int((high - low).max(initial=0)).bit_length()):
        mid = np.minimum((low + high) >> 1, len(rows) - 1)
        less = ((rows[mid] >> np.uint32(4)) < rest) & (low < high)
        low, high = np.where(less, mid + 1, low), np.where(less, high, mid)
    at = np.minimum(low, len(rows) - 1)
    found = rows[at]
    hit = np.flatnonzero((low < end) & (found >> np.uint32(4) == rest))
    out[hit] = found[hit] & np.uint32(15)
    large = hit[out[hit] == 15]
    out[large] = arrays[f"{name}x"][np.searchsorted(arrays[f"{name}x_at"], at[large])]
    return out


def _rows(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of numbers, the most frequent first, and each row's place among them."""
    key = np.zeros(len(columns[0]), dtype=np.uint64)
    for c in columns:
        key = words.mix(key * _U(0x9E3779B97F4A7C15) + c.astype(np.uint64) + _U(1))
    _, first, number = _distinct(key)
    order = np.argsort(-np.bincount(number, minlength=len(first)), kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return np.stack([c[first[order]] for c in columns], axis=1), place[number]


def _followers(c: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Of runs of n-grams of one context: total, and how many were counted once, twice and more often."""
    add = lambda x: np.add.reduceat(x.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    return [add(c), add(c == 1), add(c == 2), add(c >= 3)]


def _pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return words.mix(words.mix(v) * _U(0x9E3779B97F4A7C15) + w)


class Plan:
    """Where n-grams go: the first shard of each range of a context's last word, and the number of its shards."""

    def __init__(self, counts: np.ndarray, shards: int):
        part = max(1, int(counts.sum()) // shards)
        self.first, self.many = np.zeros(CELLS, dtype=np.int32), np.ones(CELLS, dtype=np.int32)
        shard, room = 0, part
        for cell, n in enumerate(counts.tolist()):
            if n > part:
                shard += room < part  # a split range has its shards to itself
                self.first[cell], self.many[cell] = shard, -(-n // part)
                shard, room = shard + int(self.many[cell]), part
                continue
            if n > room:
                shard, room = shard + 1, part
            self.first[cell] = shard
            room -= n
        self.shards = int((self.first + self.many).max())
        self.groups = {int(f): int(m) for f, m in zip(self.first, self.many, strict=True) if m > 1}
        self.words = max(16, self.shards // 8)  # files of words

    def shard(self, v: np.ndarray, other: np.ndarray) -> np.ndarray:
        cell = (v >> _U(48)).astype(np.int64)
        many = self.many[cell]
        return np.where(many > 1, self.first[cell] + (words.mix(other) % many.astype(np.uint64)).astype(np.int32), self.first[cell])

    def word_shard(self, w: np.ndarray) -> np.ndarray:
        return ((w >> _U(40)) * _U(self.words) >> _U(24)).astype(np.int64)


class Model:
    """The files of a model and its few numbers; picklable, opens its files where it is used."""

    def __init__(self, folder: str, plan: Plan, triples: list[str], pairs: list[str], vocabulary: list[str], discounts: tuple, tokens: int, distinct: int, pair_kinds: int, order: int):
        self.folder, self.plan, self.triples, self.pairs, self.vocabulary = folder, plan, triples, pairs, vocabulary
        self.d3, self.d2, self.d1, self.tokens, self.distinct, self.pair_kinds, self.order = *discounts, tokens, distinct, pair_kinds, order

    def _by_file(self, files: list[str], shard: np.ndarray):
        """(arrays, which rows) of every file that is asked."""
        order = np.argsort(shard.astype(np.uint16) if len(files) < 1 << 16 else shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(len(files) + 1))
        for s, name in enumerate(files):
            if cut[s] < cut[s + 1] and name:
                yield _mapped(self.folder, name), order[cut[s] : cut[s + 1]]

    def words_of(self, asked: np.ndarray) -> np.ndarray:
        """Rows of count, kinds, and followers' total and numbers; of words that were never seen, zeros. ``asked``: in order."""
        out = np.zeros((len(asked), 6), dtype=np.int64)
        for arrays, which in self._by_file(self.vocabulary, self.plan.word_shard(asked)):
            have = arrays["word"]
            at = np.minimum(np.searchsorted(have, asked[which]), len(have) - 1)
            hit = have[at] == asked[which]
            out[which[hit]] = arrays["rows"].reshape(-1, 6)[arrays["row"][at[hit]]]
        return out

    def _counts(self, files: list[str], name: str, key: np.ndarray, shard: np.ndarray) -> np.ndarray:
        out = np.zeros(len(key), dtype=np.int64)
        for arrays, which in self._by_file(files, shard):
            out[which] = look(arrays, name, key[which])
        return out

    def _followers_of(self, key: np.ndarray, shard: np.ndarray) -> np.ndarray:
        out = np.zeros((len(key), 4), dtype=np.int64)
        for arrays, which in self._by_file(self.triples, shard):
            place = look(arrays, "context", key[which])
            out[which[place > 0]] = arrays["rows"].reshape(-1, 4)[place[place > 0] - 1]
        return out

    @staticmethod
    def _refined(c: np.ndarray, followers: np.ndarray, d: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """The probability of one order more: what its counts say, and ``lower`` for the mass that their discounts leave."""
        total, n1, n2, n3 = followers.T
        whole = np.where(total > 0, total, 1)
        return np.where(total > 0, np.maximum(c - d[np.minimum(c, 3)], 0) / whole + (d[1] * n1 + d[2] * n2 + d[3] * n3) / whole * lower, lower)

    def score(self, before: np.ndarray, token: np.ndarray, earlier: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probability, count of the token in training) for every token; ``earlier`` is what stands before its context."""
        known, _, at = _distinct(np.concatenate([token, before]))
        of, (w, v) = self.words_of(known), (at[: len(token)], at[len(token) :])
        d, floor = self.d1, 1.0 / (self.distinct + 1)
        if self.pair_kinds:
            base = np.maximum(of[:, 1] - d[np.minimum(of[:, 1], 3)], 0) / self.pair_kinds + d[4] / self.pair_kinds * floor
        else:
            base = np.full(len(known), floor)
        # equal pairs and triples are looked up once
        pair, first, which = _distinct(_pair_key(before, token))
        c = self._counts(self.pairs, "pair", pair, self.plan.shard(before[first], token[first]))
        probability = self._refined(c, of[v[first], 2:], self.d2, base[w[first]])[which]
        if self.order > 2 and earlier is not None:
            some = np.flatnonzero(earlier != NOTHING)
            context = _pair_key(before[some], earlier[some])
            contexts, first, which = _distinct(context)
            followers = self._followers_of(contexts, self.plan.shard(before[some[first]], earlier[some[first]]))[which]
            ask = some[followers[:, 0] > 0]  # a context that was never seen leaves all to the shorter one
            triple, first, which = _distinct(_pair_key(context[followers[:, 0] > 0], token[ask]))
            c = self._counts(self.triples, "triple", triple, self.plan.shard(before[ask[first]], earlier[ask[first]]))[which]
            probability[ask] = self._refined(c, followers[followers[:, 0] > 0], self.d3, probability[ask])
        return np.log10(probability), of[w, 0]


def discounts(counts: list[int]) -> np.ndarray:
    """D(0..3) of modified Kneser-Ney from how many things occur 1, 2, 3 and 4 times; half a count where that can't be told."""
    n1, n2, n3, n4 = (float(x) for x in counts)
    if min(n1, n2, n3) <= 0:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    out = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n4 else 1.0]
    return np.array([0.0] + [min(max(x, 0.1), k - 0.05) for k, x in enumerate(out[1:], 1)])


def _census(x: np.ndarray) -> list[int]:
    return [int((x == k).sum()) for k in (1, 2, 3, 4)] + [int((x >= 3).sum()), len(x)]


def _word_blobs(plan: Plan, word: np.ndarray, stats: list[np.ndarray]) -> dict[str, bytes]:
    """What is known of single words, by the files of words that it adds up to."""
    word, *stats = _sums(word, *stats)
    cut = np.searchsorted(plan.word_shard(word), np.arange(plan.words + 1))
    out = {}
    for s in range(plan.words):
        a, b = cut[s], cut[s + 1]
        if a < b:
            out[f"w{s}"] = _joined([_sorted_blob(word[a:b]), *(_blob(x[a:b]) for x in stats)])
    return out


def _joined(blobs: list[bytes]) -> bytes:
    return b"".join(len(b).to_bytes(5, "little") + b for b in blobs)


def _apart(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 5], "little")
        out.append(data[at + 5 : at + 5 + n])
        at += 5 + n
    return out


def _pairs_written(v: np.ndarray, w: np.ndarray, c: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, list[np.ndarray]]:
    """Of distinct pairs in the order of v: their sorted hash array, and what they add to single words: the words, and count, kinds and followers."""
    first = _runs(v)
    none = np.zeros(len(w), np.int64)
    zero = np.zeros(len(first), np.int64)
    followers = _followers(c, first)
    stats = [np.concatenate([none, zero]), np.concatenate([none + 1, zero]), *(np.concatenate([none, x]) for x in followers)]
    return _hashed("pair", _pair_key(v, w), c), np.concatenate([w, v[first]]), stats


def fit(docs: DataFrame, text: str = "text", shards: int | None = None, order: int = ORDER) -> Model:
    """A model of all texts, of order 2 or 3; a null text is an empty one, which is an end alone, and a repeated row counts each time. Without rows every token is as likely as any other."""
    if order not in (2, 3):
        raise ValueError(f"order is 2 or 3, not {order}")
    spark = docs.sparkSession
    rows = docs.select(F.col(text).alias("text"))
    folder = common.folder(spark, "lm")

    def weigh(batches):
        total = np.zeros(CELLS, dtype=np.uint64)
        for batch in common.pieces(batches, 0):
            before, _, _ = sequences(batch.column(0))
            total += np.bincount((before >> _U(48)).astype(np.int64), minlength=CELLS).astype(np.uint64)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(common.CHUNKS), pa.int32()), pa.array(common.packed(total), pa.binary())], ["chunk", "blob"])

    counts = common.combined(common.arrow(rows, weigh, "chunk int, blob binary"), np.uint64, CELLS).astype(np.int64)
    plan = Plan(counts, shards or max(SHARDS, int(counts.sum()) // SHARD_TOKENS))

    def count(batches):
        held, size = [], 0

        def flush():
            before, token = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            begins = before == BEGIN
            known, _, ids = _distinct(np.concatenate([np.array([BEGIN, NOTHING], np.uint64), token]))
            begin, nothing, w = ids[0], ids[1], ids[2:]
            del before, token, ids
            v = np.concatenate([w[:1], w[:-1]])
            v[begins] = begin
            u = np.full(len(w), nothing)
            if order > 2:
                u[1:] = v[:-1]
                u[begins] = nothing
            del begins
            bits = max(1, (len(known) - 1).bit_length())
            if 3 * bits <= 64:
                key = (v.astype(np.uint64) << _U(2 * bits)) | (u.astype(np.uint64) << _U(bits)) | w.astype(np.uint64)
                del v, u, w
                key.sort()
                at = _runs(key)
                c, key = np.diff(np.append(at, len(key))), key[at]
                v, u, w = ((key >> _U(k * bits)).astype(np.int64) & ((1 << bits) - 1) for k in (2, 1, 0))
            else:
                by = np.lexsort((w, u, v))
                at = _runs(v[by], u[by], w[by])
                c, (v, u, w) = np.diff(np.append(at, len(by))), (x[by[at]] for x in (v, u, w))
            shard = plan.shard(known[v], known[u if order > 2 else w])
            by = np.argsort(shard.astype(np.uint16) if plan.shards < 1 << 16 else shard, kind="stable")
            cut = np.searchsorted(shard[by], np.arange(plan.shards + 1))
            for s in range(plan.shards):
                mine = by[cut[s] : cut[s + 1]]
                if len(mine):
                    used = np.zeros(len(known), dtype=bool)
                    used[v[mine]] = used[u[mine]] = used[w[mine]] = True
                    number = np.cumsum(used) - 1
                    yield s, _joined([_sorted_blob(known[used]), _blob(np.diff(number[v[mine]], prepend=0)), _blob(number[u[mine]]), _blob(number[w[mine]]), _blob(c[mine])])

        for batch in common.pieces(batches, 0):
            before, token, _ = sequences(batch.column(0))
            held.append((before, token))
            size += len(token)
            if size >= COUNTED:
                yield from _batches(flush())
                size = 0
        if size:
            yield from _batches(flush())

    def _batches(found):
        some = list(found)
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in some], pa.int32()), pa.array([b for _, b in some], pa.binary())], ["shard", "blob"])

    def merge(table: pa.Table) -> pa.Table:
        here = table["shard"][0].as_py()
        parts = [_apart(b.as_py()) for b in table["blob"]]
        dictionaries = [_unsorted_blob(p[0]) for p in parts]
        known = np.sort(np.concatenate(dictionaries))
        known = known[_runs(known)]
        columns = []
        for p, own in zip(parts, dictionaries, strict=True):
            to = np.searchsorted(known, own).astype(np.uint32)
            columns.append((to[np.cumsum(_unblob(p[1]).astype(np.int64))], to[_unblob(p[2])], to[_unblob(p[3])], _unblob(p[4]).astype(np.uint32)))
        del parts, dictionaries
        v, u, w, c = (np.concatenate(x) for x in zip(*columns, strict=True))
        del columns
        key = _together(v, u, w)
        by = np.argsort(key)
        at = _runs(key[by])
        del key
        c = np.add.reduceat(c[by].astype(np.int64), at)
        by = by[at]
        v, u, w = v[by], u[by], w[by]
        del by, at
        arrays, top = {}, np.zeros(0, np.int64)
        some = np.flatnonzero(known[u] != NOTHING)
        if order > 2:
            top = c[some]
            context = _pair_key(known[v[some]], known[u[some]])
            first = _runs(v[some], u[some])
            rows_, place = _rows(_followers(top, first))
            arrays = _hashed("triple", _pair_key(context, known[w[some]]), top) | _hashed("context", context[first], place + 1) | {"rows": rows_.ravel().astype(np.min_scalar_type(int(rows_.max(initial=0))))}
            del context, first, place
        # a pair counts as often as different words stand before it, and really where none can
        real = c if order == 2 else np.where(known[u] == NOTHING, c, 1)
        pair, times, c = _sums(_together(v, w), c, real)
        v, w = _pairs_of(pair, v, w, known)
        of, stats = w, [times, *[np.zeros(len(w), np.int64)] * 5]
        found, pairs, census = {}, "", [0] * 6
        many = next((m for f, m in plan.groups.items() if f <= here < f + m), 1)
        if many > 1:  # the range's shards add up their pairs
            to = (words.mix(w) % _U(many)).astype(np.int64)
            found = {f"p{k}": _joined([_blob(v[to == k]), _blob(w[to == k]), _blob(c[to == k])]) for k in range(many)}
        else:
            written, more, added = _pairs_written(v, w, c)
            pairs, census = _write(folder, written), _census(c)
            of, stats = np.concatenate([of, more]), [np.concatenate(x) for x in zip(stats, added, strict=True)]
        sent = _write(folder, _word_blobs(plan, of, stats) | found)
        return pa.table({"shard": pa.array([here], pa.int32()), "triples": [_write(folder, arrays)], "pairs": [pairs], "sent": [sent], "census": pa.array([[*census, *_census(top)]], pa.list_(pa.int64()))})

    def _pairs_of(pair, v, w, known):
        bits = max(1, int(w.max(initial=0)).bit_length())
        return known[(pair >> _U(bits)).astype(np.int64)], known[(pair & ((_U(1) << _U(bits)) - _U(1))).astype(np.int64)]

    counted = common.arrow(rows, count, "shard int, blob binary")
    shape = "shard int, triples string, pairs string, sent string, census array<long>"
    merged = common.kept(counted.groupBy("shard").applyInArrow(common.of_group(merge), shape), "lm-shards").collect()  # a row for each shard
    files = {r["shard"]: r for r in merged}

    def add_up(batches):
        """Pairs of split ranges: each of a range's shards takes its part from all of them."""
        for batch in batches:
            for here, first, sent in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = [[_unblob(x) for x in _apart(_part(folder, s, f"p{here - first}"))] for s in sent]
                v, w, c = (np.concatenate(x).astype(np.uint64) for x in zip(*parts, strict=True))
                known, _, ids = _distinct(np.concatenate([v, w]))
                v, w = ids.astype(np.uint32).reshape(2, -1)
                pair, c = _sums(_together(v, w), c.astype(np.int64))
                v, w = _pairs_of(pair, v, w, known)
                written, of, stats = _pairs_written(v, w, c)
                yield pa.RecordBatch.from_arrays([pa.array([here], pa.int32()), pa.nulls(1, pa.string()), pa.array([_write(folder, written)]), pa.array([_write(folder, _word_blobs(plan, of, stats))]), pa.array([[*_census(c), *[0] * 6]], pa.list_(pa.int64()))], ["shard", "triples", "pairs", "sent", "census"])

    tasks = [(f + k, f, [files[f + j]["sent"] for j in range(m) if f + j in files]) for f, m in plan.groups.items() for k in range(m)]
    tasks = [x for x in tasks if x[2]]
    again = []
    if tasks:
        asked = spark.createDataFrame(tasks, "shard int, first int, sent array<string>").repartition(len(tasks))
        again = common.kept(common.arrow(asked, add_up, shape), "lm-pairs").collect()  # a row for each shard of a split range

    def settle(batches):
        for batch in batches:
            for here, sent in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = [_apart(_part(folder, s, f"w{here}")) for s in sent]
                word = np.concatenate([_unsorted_blob(p[0]) for p in parts])
                word, *stats = _sums(word, *(np.concatenate([_unblob(p[k]).astype(np.int64) for p in parts]) for k in range(1, 7)))
                rows_, place = _rows(stats)
                # what only stands before others, as the begin, is no token
                written = _write(folder, {"word": word, "row": place.astype(np.uint32), "rows": rows_.ravel().astype(np.min_scalar_type(int(rows_.max(initial=0))))})
                yield pa.RecordBatch.from_arrays([pa.array([here], pa.int32()), pa.array([written]), pa.array([[*_census(stats[1]), int(stats[0].sum()), int((stats[0] > 0).sum())]], pa.list_(pa.int64()))], ["shard", "file", "census"])

    sent = [r["sent"] for r in (*merged, *again)]
    tasks = [(s, [x for x in sent if f"w{s}" in _layout(x)[1]]) for s in range(plan.words)]
    tasks = [x for x in tasks if x[1]]
    settled = []
    if tasks:
        asked = spark.createDataFrame(tasks, "shard int, sent array<string>").repartition(len(tasks))
        settled = common.kept(common.arrow(asked, settle, "shard int, file string, census array<long>"), "lm-words").collect()  # a row for each file of words
    store, inner = _store(folder)
    for x in sent:  # they are summed
        store.delete_file(f"{inner}/{_layout(x)[0]}")
    add = lambda found, width: np.sum([r["census"] for r in found], axis=0) if found else np.zeros(width, np.int64)
    pairs, vocabulary = add([*merged, *again], 12), add(settled, 8)
    named = {r["shard"]: r["pairs"] for r in (*merged, *again) if r["pairs"]}
    d1 = discounts(list(vocabulary[:4]))
    mass = d1[1] * vocabulary[0] + d1[2] * vocabulary[1] + d1[3] * vocabulary[4]
    triples = [files[s]["triples"] if s in files else "" for s in range(plan.shards)] if order > 2 else []
    vocabulary_files = {r["shard"]: r["file"] for r in settled}
    return Model(
        folder, plan, triples, [named.get(s, "") for s in range(plan.shards)], [vocabulary_files.get(s, "") for s in range(plan.words)],
        (discounts(list(pairs[6:10])), discounts(list(pairs[:4])), np.append(d1, mass)), int(vocabulary[6]), int(vocabulary[7]), int(pairs[5]), order,
    )


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score and perplexity of every row, repeated ones each; a null text is empty, an empty table gives no rows."""

    def run(batches):
        for batch in common.pieces(batches, 1):
            before, token, at = sequences(batch.column(1))
            log, count = model.score(before, token, earlier(before))
            base = np.log10((count + 1) / (model.tokens + model.distinct + 1))
            add = lambda x: np.add.reduceat(x, at[:-1])
            n, total = np.diff(at), add(log)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(add((count > 0).astype(np.int64))), pa.array(np.full(len(n), model.tokens, np.int64)), pa.array(add(base)), pa.array(total), pa.array(10 ** (-total / n))],
                ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return common.arrow(rows, run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    held = common.remainder("doc_id", 7) == 2
    out = score(docs, fit(docs.where(~held)))
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

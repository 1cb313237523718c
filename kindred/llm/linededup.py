"""Line dedup by an exact set-similarity join.

A line's set is its distinct words. Tokens are ordered by rarity: a sketch of
token counts, of fixed size, gives every token its place, the hash breaks ties,
so that all lines agree on one order. Two sets with a Jaccard similarity of t
or more share a token in their prefixes, the first ``m - ceil(t m) + 1`` tokens;
so each set is posted under the tokens of its prefix. A token that occurs more
often than ``2**(HOT / 2)`` times would have a long list: lines are posted under
it together with each later token of a prefix that is one longer, as two sets
that share it first share another such token as well. Sets too small to have a
similar set that isn't equal are not posted. Pairs under a token must pass the
length filter, the positional filter (for the first token that they share) and
a filter on parity bitmaps before their whole sets are compared.

A line goes if an earlier line (smaller document id, then smaller line number)
has an equal or similar set. Equal lines are one from the start. A line's
candidates are gone through from the earliest, so the members of a large group
of near copies find their match with its first ones and no pairs within the
group are written out. The lists in which a line was cut short are kept, and a
line whose first candidates all fail goes through them again to the end. Lists
are cut by size, so that a line meets those of its own class and of the two
beside it, and long ones are compared in blocks.

Token sets are cut out of the texts again for the lines of candidate pairs
alone, which workers know by a bitmap; so no text is shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, words

SIMILARITY = 0.8
#: Bits of the sketch that orders tokens (a byte for each cell is broadcast); candidates that a line keeps under one token in the first round; postings of a bucket, and of a line, about.
SKETCH_BITS, FIRST, BUCKET_ROWS, POSTS_OF_A_LINE = 22, 2, 200_000, 10
#: Rarity, twice the logarithm of the count, from which a token is posted with a second one; entries from which a list is long; rows and columns of a block of comparisons.
HOT, LONG, ROWS, COLUMNS = 24, 1024, 256, 4096
_U = np.uint64
COLUMNS_OF_A_POSTING = (("token", "<u8"), ("a", "<u8"), ("b", "<u8"), ("doc", "<i8"), ("line", "<u4"), ("m", "<u4"), ("at", "<u4"), ("ask", "u1"))


#: Lines that are packed together: their number takes at most 22 bits, which leaves 36 for the hash.
RUN = (1 << 22) - 1


def line_words(column: pa.Array):
    """(row, line, owner, token): all lines of all texts in order, and each word's line and hash."""
    data, offsets = words.text_buffer(column)
    breaks = np.flatnonzero(data == 10)
    begin = np.concatenate([offsets[:-1], breaks + 1])
    row = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, side="right") - 1])
    order = np.lexsort((begin, row))
    row, begin = row[order], begin[order]
    line = np.arange(len(row)) - np.searchsorted(row, np.arange(len(offsets) - 1))[row]
    starts, ends = words.spans(data, offsets)
    # a line that is empty begins where the next one does: the last one at a place owns the word there
    return row, line, np.searchsorted(begin, starts, side="right") - 1, words.hashes(data, starts, ends)


def line_keys(owner: np.ndarray, token: np.ndarray, lines: int) -> tuple[np.ndarray, np.ndarray]:
    """A key for each line's words with repeats but without order, and their number."""
    bounds = np.searchsorted(owner, np.arange(lines + 1))
    sums = np.zeros(len(token) + 1, dtype=np.uint64)
    np.cumsum(words.mix(token ^ _U(0x2545F4914F6CDD1D)), out=sums[1:])
    count = np.diff(bounds)
    return words.mix(sums[bounds[1:]] - sums[bounds[:-1]] + count.astype(np.uint64)), count


def line_order(owner: np.ndarray, token: np.ndarray, lines: int, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens of every line from rare to frequent: (bounds, token numbers, m, parity bitmaps). Only lines with words are numbered, in runs of ``RUN``."""
    fresh = np.ones(len(owner), dtype=bool)
    fresh[1:] = owner[1:] != owner[:-1]
    filled, own = owner[fresh], np.cumsum(fresh) - 1
    m, marks, numbers = np.zeros(lines, dtype=np.int64), np.zeros((lines, 2), dtype=np.uint64), []
    for first in range(0, len(filled), RUN):
        here = filled[first : first + RUN]
        lo, hi = np.searchsorted(own, (first, first + len(here)))
        number, m[here], marks[here] = _run_order(own[lo:hi] - first, token[lo:hi], len(here), rarity)
        numbers.append(number)
    return np.concatenate([[0], np.cumsum(m)]), np.concatenate(numbers) if numbers else np.zeros(0, np.uint64), m, marks


def _run_order(owner: np.ndarray, token: np.ndarray, lines: int, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token numbers, m, parity bitmaps) of at most ``RUN`` lines.

    Line, rarity and hash are packed into one number, so that a plain sort
    gives the order; a token's number is its rarity and 36 bits of its hash,
    which may add candidates but loses none.
    """
    bits = max(1, int(lines).bit_length())
    rest = _U(64 - bits - 6)
    rare = rarity[(token >> _U(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    packed = (owner.astype(np.uint64) << _U(64 - bits)) | (rare << rest) | (token >> (_U(64) - rest))
    packed.sort()
    packed = packed[np.concatenate([[True], packed[1:] != packed[:-1]])] if len(packed) else packed
    own = (packed >> _U(64 - bits)).astype(np.int64)
    bounds = np.searchsorted(own, np.arange(lines + 1))
    number = (packed & ((_U(1) << _U(64 - bits)) - _U(1))) >> (rest - _U(36))
    place = words.mix(number)
    marks = np.zeros((len(packed) + 1, 2), dtype=np.uint64)
    for half in range(2):
        mine = ((place >> _U(6)) & _U(1)) == _U(half)
        np.bitwise_xor.accumulate(mine.astype(np.uint64) << (place & _U(63)), out=marks[1:, half])
    return number, np.diff(bounds), marks[bounds[1:]] ^ marks[bounds[:-1]]


def prefixes(bounds: np.ndarray, number: np.ndarray, m: np.ndarray, use: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, token, position) of all that the lines ``use`` are posted under."""
    hot = _U(HOT) << _U(36)
    size = m[use] - np.ceil(t * m[use] - 1e-9).astype(np.int64) + 1
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    line = np.repeat(use, size)
    token = number[bounds[line] + at]
    twice = np.flatnonzero(token >= _U(3) << _U(36))  # a token that occurs once pairs nothing
    line, token, at = line[twice], token[twice], at[twice]
    if t < 2 / 3:  # sets that share one token alone may be similar
        return line, token, at
    many = np.flatnonzero(token >= hot)
    last = np.minimum(m[line[many]] - 1, np.repeat(size, size)[twice][many])  # the last position of the longer prefix
    more = last - at[many]
    first = np.repeat(many, more)
    second = at[first] + 1 + np.arange(len(first)) - np.repeat(np.cumsum(more) - more, more)
    both = words.mix(token[first] * _U(0x9E3779B97F4A7C15) + number[bounds[line[first]] + second])
    few = np.flatnonzero(token < hot)
    return np.concatenate([line[few], line[first]]), np.concatenate([token[few], both]), np.concatenate([at[few], at[first]])


def pack(posts: dict[str, np.ndarray]) -> bytes:
    """Postings column by column, compressed; those of a token lie together."""
    return pa.compress(b"".join(np.ascontiguousarray(posts[k], dtype=kind).tobytes() for k, kind in COLUMNS_OF_A_POSTING), codec="zstd", asbytes=True)


def unpack(blob, count: int) -> dict[str, np.ndarray]:
    data = pa.decompress(blob, count * sum(np.dtype(k).itemsize for _, k in COLUMNS_OF_A_POSTING), codec="zstd")
    out, at = {}, 0
    for k, kind in COLUMNS_OF_A_POSTING:
        out[k] = np.frombuffer(data, dtype=kind, count=count, offset=at)
        at += out[k].nbytes
    return out


def _fits(mx, ax, my, ay, t: float):
    """The length filter, and the positional one for two sets whose first common token is at ``ax`` and ``ay``."""
    return (np.minimum(mx, my) >= t * np.maximum(mx, my) - 1e-9) & (1 + np.minimum(mx - 1 - ax, my - 1 - ay) >= _need(mx, my, t))


def _need(mx, my, t: float):
    return np.ceil(t / (1 + t) * (mx + my) - 1e-9)


def candidates(posts: dict[str, np.ndarray], t: float, first: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of postings: indexes of (later, earlier) that pass all filters, and of the later ones that may have more than ``first``."""
    cell = (words.mix(posts["token"]) >> _U(42)).astype(np.int64)
    some = np.flatnonzero(np.bincount(cell, minlength=1 << 22)[cell] > 1)  # a token posted once pairs nothing
    some = some[_in_time(posts["doc"][some], posts["line"][some])]  # from the earliest on
    m, at = posts["m"][some].astype(np.int64), posts["at"][some].astype(np.int64)
    by = np.argsort(posts["token"][some])
    group = np.empty(len(some), dtype=np.int64)
    edge = np.zeros(len(some), dtype=np.int64)
    edge[_edges(posts["token"][some][by])] = 1
    group[by] = np.cumsum(edge)
    # an entry stays if its list has another one of a size that its position leaves possible
    by = np.argsort(group << 32 | m)  # asked in order, which is faster
    g, n, left = group[by] << 32, m[by], (m - at)[by]
    most = np.floor(left * (1 + t) / t - n + 1e-6).astype(np.int64)
    low, high = np.searchsorted(g | n, g | np.ceil(t * n - 1e-9).astype(np.int64), "left"), np.searchsorted(g | n, g | np.clip(most, 0, 2**32 - 1), "right")
    stay = np.sort(by[high - low > (most >= n)])
    some, group, m = some[stay], group[stay], m[stay]
    # classes of sizes: two sets that may be similar are of one class or of two beside each other, so each is a guest in the next class
    size = np.minimum(254, np.log(m) / np.log(1.0001 / min(t, 0.999))).astype(np.int64)
    width = max(1, len(some)).bit_length()
    every = np.concatenate([((group << 8 | size + k) << width | np.arange(len(some))) << 1 | k for k in (0, 1)])
    every.sort()  # by token, class and place in time
    key, guest, order = every >> width + 1, every & 1 > 0, some[(every >> 1) & ((1 << width) - 1)]
    head = _edges(key)
    length = np.diff(np.append(head, len(key)))
    use = np.repeat((length > 1) & (np.add.reduceat((~guest).astype(np.int64), head) > 0), length) if len(key) else guest
    key, guest, order = key[use], guest[use], order[use]
    doc, line, m, at, a, b, ask = (posts[k][order] for k in ("doc", "line", "m", "at", "a", "b", "ask"))
    m, at = m.astype(np.int64), at.astype(np.int64)
    differ = np.floor((1 - t) / t * m + 1e-6).astype(np.int64)  # elements that are in one of two similar sets alone
    head = _edges(key)
    length = np.diff(np.append(head, len(order)))
    start = np.repeat(head, length)
    place = np.arange(len(order)) - start
    out, more = [], []
    found = np.zeros(len(order), dtype=np.int64)

    def test(x, y):
        fit = _fits(m[x], at[x], m[y], at[y], t) & ~(guest[x] & guest[y]) & ((doc[x] != doc[y]) | (line[x] != line[y]))
        return fit & (np.bitwise_count(a[x] ^ a[y]).astype(np.int64) + np.bitwise_count(b[x] ^ b[y]) <= m[x] + m[y] - 2 * _need(m[x], m[y], t))

    later = np.flatnonzero((place > 0) & (ask == 1) & (np.repeat(length, length) <= LONG))
    step = 0
    while len(later):  # all short lists at once: their first entries, their second ones and so on
        other = start[later] + step
        near = np.flatnonzero(np.bitwise_count(a[other] ^ a[later]) <= differ[later])
        x, y = other[near], later[near]
        hit = test(x, y)
        x, y = x[hit], y[hit]
        out.append((order[y], order[x]))
        found[y] += 1
        step += 1
        stay = place[later] > step
        if first is not None:
            full = found[later] >= first
            more.append(order[later[stay & full]])
            stay &= ~full
        later = later[stay]
    for g in np.flatnonzero(length > LONG):
        mine = head[g] + np.arange(length[g])
        asking = mine[ask[mine] == 1]
        for i in range(0, len(asking), ROWS):
            y = asking[i : i + ROWS]
            count = np.zeros(len(y), dtype=np.int64)
            for j in range(head[g], y[-1], COLUMNS):
                x = np.arange(j, min(j + COLUMNS, y[-1]))
                row, column = np.nonzero(np.bitwise_count(a[y, None] ^ a[None, x]) <= differ[y].max())
                fit = test(x[column], y[row]) & (x[column] < y[row])
                row, column = row[fit], column[fit]
                if first is not None:  # rows are in order: the place of a hit in its row
                    fit = np.arange(len(row)) - np.searchsorted(row, row) + count[row] < first
                    row, column = row[fit], column[fit]
                out.append((order[y[row]], order[x[column]]))
                count += np.bincount(row, minlength=len(y))
                if first is not None:
                    more.append(order[y[count >= first]])
                    y, count = y[count < first], count[count < first]
                if not len(y):
                    break
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join([y for y, _ in out]), join([x for _, x in out]), join(more)


def _in_time(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The order by document and line; by one number where both fit."""
    if len(doc) and int(doc.max()) - int(doc.min()) < 1 << 36 and int(line.max()) < 1 << 26:
        return np.argsort((doc - doc.min()) << 26 | line.astype(np.int64))
    return np.lexsort((line, doc))


def _edges(key: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))


def _scan(docs: DataFrame) -> DataFrame:
    """One pass: a row for each line that has words (kind 0), the task's sketch in chunks (1), a row for each document (2)."""

    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in common.pieces(batches, 1):
            row, line, owner, token = line_words(batch.column(1))
            sketch += np.bincount((token >> _U(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS).astype(np.uint32)
            doc = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            key, count = line_keys(owner, token, len(row))
            has = count > 0
            n = int(has.sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), pa.array(doc[row[has]]), pa.array(line[has].astype(np.int32)), pa.array(key[has].view(np.int64)), pa.nulls(n, pa.binary())], NAMES)
            lines = np.bincount(row, minlength=len(doc)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), 2, np.int32)), pa.array(doc), pa.array(lines), pa.nulls(len(doc), pa.int64()), pa.nulls(len(doc), pa.binary())], NAMES)
        if sketch.any():
            n = common.CHUNKS
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), pa.nulls(n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), pa.nulls(n, pa.int64()), pa.array(common.packed(sketch.astype(np.uint64)), pa.binary())], NAMES)

    NAMES = ["kind", "doc", "line", "key", "blob"]
    return common.arrow(docs, run, "kind int, doc long, line int, key long, blob binary")


def _rarity(scanned: DataFrame) -> np.ndarray:
    """Every cell's count as twice its logarithm, in 6 bits."""
    total = common.combined(scanned.where("kind = 1").select(F.col("line").alias("chunk"), "blob"), np.uint64, 1 << SKETCH_BITS)
    return np.minimum(63, 2 * np.log2(1 + total.astype(np.float64))).astype(np.uint8)


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", t: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(doc, n_lines) of all rows, and (doc, line) of the lines that go, numbered from 0; rows may repeat.

    Lines are parted by newlines and compared as sets of lower-cased words;
    lines without words never go, and a null text is one empty line. A null id
    comes before all others. Rows with equal ids share their line numbers:
    lines of one number are never earlier than each other. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("doc"), F.col(text).alias("text"))
    scanned = common.kept(_scan(docs), "lines")
    lines, totals = scanned.where("kind = 0").select("doc", "line", "key"), scanned.where("kind = 2").selectExpr("doc", "line AS n_lines")
    rarity = spark.sparkContext.broadcast(_rarity(scanned))
    buckets = max(1, math.ceil(lines.count() * POSTS_OF_A_LINE / BUCKET_ROWS))

    def posted(batches):
        for batch in common.pieces(batches, 1):
            row, line, owner, token = line_words(batch.column(1))
            key, count = line_keys(owner, token, len(row))
            doc = batch.column(0).to_numpy()[row]
            order = np.lexsort((line, doc, key))
            alone = np.zeros(len(order), dtype=bool)  # of equal lines of the batch the first is enough
            alone[order] = np.concatenate([[True], key[order][1:] != key[order][:-1]]) if len(order) else alone
            bounds, number, m, marks = line_order(owner, token, len(row), rarity.value)
            # a set that is similar but not equal has t / (1 - t) tokens at least
            by, rare, at = prefixes(bounds, number, m, np.flatnonzero(alone & (count > 0) & (m * (1 - t) >= t - 1e-9)), t)
            place = words.mix(rare)
            to = (place % _U(buckets)).astype(np.int64)
            order = np.argsort(to << 40 | (place >> _U(24)).astype(np.int64))  # those of a token together
            by, rare, at, to = by[order], rare[order], at[order], to[order]
            posts = {"token": rare, "a": marks[by, 0], "b": marks[by, 1], "doc": doc[by], "line": line[by], "m": m[by], "at": at, "ask": np.ones(len(by), np.uint8)}
            cut = np.searchsorted(to, np.arange(buckets + 1))
            full = [b for b in range(buckets) if cut[b] < cut[b + 1]]
            blobs = [pack({k: v[cut[b] : cut[b + 1]] for k, v in posts.items()}) for b in full]
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([int(cut[b + 1] - cut[b]) for b in full], pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "n", "posts"])

    def rows_of(posts, y, x, more, blob: bytes | None = None, n: int = 0) -> pa.Table:
        """Pairs, each once, then the lines that were cut short, then the lists in which they were."""
        both = np.empty((len(y), 4), dtype=np.int64)
        for k, (name, index) in enumerate((("doc", y), ("line", y), ("doc", x), ("line", x))):
            both[:, k] = posts[name][index]
        if len(both):
            both = both[np.lexsort(both.T)]
            both = both[np.concatenate([[True], (np.diff(both, axis=0) != 0).any(axis=1)])]
        if len(more):
            more = more[np.lexsort((posts["line"][more], posts["doc"][more]))]
            more = more[np.concatenate([[True], (np.diff(posts["doc"][more]) != 0) | (np.diff(posts["line"][more].astype(np.int64)) != 0)])]
        cut, last = len(more), int(blob is not None)
        number = lambda x: pa.array(x.astype(np.int32))
        return pa.table(
            {
                "doc": pa.concat_arrays([pa.array(both[:, 0].copy()), pa.array(posts["doc"][more]), pa.nulls(last, pa.int64())]), "line": pa.concat_arrays([number(both[:, 1]), number(posts["line"][more]), pa.nulls(last, pa.int32())]),
                "doc2": pa.concat_arrays([pa.array(both[:, 2].copy()), pa.nulls(cut + last, pa.int64())]), "line2": pa.concat_arrays([number(both[:, 3]), pa.nulls(cut + last, pa.int32())]),
                "n": pa.array([0] * (len(both) + cut) + [n] * last, pa.int32()), "posts": pa.array([None] * (len(both) + cut) + [blob] * last, pa.binary()),
            }
        )

    def paired(table: pa.Table) -> pa.Table:
        parts = [unpack(b.as_buffer(), n.as_py()) for b, n in zip(table["posts"], table["n"], strict=True)]
        posts = {k: np.concatenate([p[k] for p in parts]) for k, _ in COLUMNS_OF_A_POSTING}
        del parts
        y, x, more = candidates(posts, t, FIRST)
        if not len(more):
            return rows_of(posts, y, x, more)
        again = np.isin(posts["token"], np.unique(posts["token"][more]))
        return rows_of(posts, y, x, more, pack({k: v[again] for k, v in posts.items()}), int(again.sum()))

    kinds = "doc long, line int, doc2 long, line2 int, n int, posts binary"
    blobs = common.arrow(docs, posted, "bucket int, n int, posts binary")
    paired_rows = common.kept(blobs.groupBy("bucket").applyInArrow(common.of_group(paired), kinds), "line-pairs")

    def token_sets(pairs: DataFrame) -> DataFrame:
        """(doc, line, tokens) of the lines of pairs, and of a few others that share their marks."""
        wanted = pairs.select("doc", "line").union(pairs.select("doc2", "line2"))
        count = 2 * pairs.count()
        bitmap, bits = common.marked(wanted, ["doc", "line"], count)
        of_docs, bits_of_docs = common.marked(wanted, ["doc"], count)
        sent, sent_docs = spark.sparkContext.broadcast(bitmap), spark.sparkContext.broadcast(of_docs)

        def run(batches):
            mine = (b.filter(pa.array(common.is_marked(sent_docs.value, common.cells([b.column(0).to_numpy()], bits_of_docs)))) for b in batches if b.num_rows)
            for batch in common.pieces(mine, 1):
                row, line, owner, token = line_words(batch.column(1))
                doc = batch.column(0).to_numpy()[row]
                use = common.is_marked(sent.value, common.cells([doc, line], bits))
                number = np.cumsum(use) - 1
                mine = use[owner]
                own, flat = number[owner[mine]], token[mine]
                order = np.lexsort((flat, own))
                own, flat = own[order], flat[order]
                fresh = np.ones(len(flat), dtype=bool)
                fresh[1:] = (flat[1:] != flat[:-1]) | (own[1:] != own[:-1])
                cuts = np.searchsorted(own[fresh], np.arange(int(use.sum()) + 1))
                sets = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat[fresh].view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(doc[use]), pa.array(line[use].astype(np.int32)), sets], ["doc", "line", "tokens"])

        return common.kept(common.arrow(docs, run, "doc long, line int, tokens array<long>"), "line-tokens")

    def matched(pairs: DataFrame) -> DataFrame:
        """(doc, line) of the later lines of pairs whose whole sets are similar."""
        pairs = pairs.where("doc2 IS NOT NULL").select("doc", "line", "doc2", "line2").distinct().join(copies, ["doc", "line"], "left_anti")
        pairs = common.kept(pairs, "line-candidates")
        sets = token_sets(pairs)
        full = pairs.join(sets.withColumnRenamed("tokens", "y"), ["doc", "line"]).join(sets.selectExpr("doc AS doc2", "line AS line2", "tokens AS x"), ["doc2", "line2"])
        full = full.withColumn("n", F.size(F.array_intersect("x", "y")))
        return full.where(F.col("n") >= F.lit(t) * (F.size("x") + F.size("y") - F.col("n")) - 1e-9).select("doc", "line").distinct()

    firsts = lines.groupBy("key").agg(F.min(F.struct("doc", "line")).alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "first")
    firsts = common.kept(firsts, "line-firsts")  # so that Spark can split the join where one line is very frequent
    # lines that equal an earlier one go, and need no other that is similar
    copies = common.kept(lines.join(firsts, "key").where(F.struct("doc", "line") != F.col("first")).select("doc", "line"), "line-copies")
    gone = common.kept(matched(paired_rows), "line-matches")
    again = paired_rows.where("doc IS NOT NULL AND doc2 IS NULL").select("doc", "line").distinct().join(gone.union(copies), ["doc", "line"], "left_anti")
    again = common.kept(again, "lines-again")
    open_ = again.count()
    if open_:
        bitmap, bits = common.marked(again, ["doc", "line"], open_)
        asking = spark.sparkContext.broadcast(bitmap)

        def whole(batches):
            for batch in batches:
                for n, blob in zip(batch.column(0), batch.column(1), strict=True):
                    posts = unpack(blob.as_buffer(), n.as_py())
                    posts["ask"] = common.is_marked(asking.value, common.cells([posts["doc"], posts["line"]], bits)).astype(np.uint8)
                    yield from rows_of(posts, *candidates(posts, t, None)).to_batches()

        lists = paired_rows.where("posts IS NOT NULL").select("n", "posts")
        gone = gone.union(matched(common.arrow(lists, whole, kinds)))
    return totals, copies.union(gone)


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", t: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, removed (numbers of the lines that go, in order).

    Nulls, repeated rows and empty tables are as in ``removed_lines``; ties
    can't be, as no two lines have one place.
    """
    totals, gone = removed_lines(docs, doc_id, text, t)
    gone = gone.groupBy("doc").agg(F.array_sort(F.collect_set("line")).alias("removed"))
    out = totals.join(gone, "doc", "left").withColumn("removed", F.filter(F.coalesce("removed", F.array().cast("array<int>")), lambda x: x < F.col("n_lines")))
    return out.select(F.when(F.col("doc") != -(2**63), F.col("doc")).alias("doc_id"), "n_lines", F.size("removed").alias("n_removed"), "removed")


def without_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", t: float = SIMILARITY) -> DataFrame:
    """The documents without the lines that go, all columns kept, whatever their names; a document that loses all its lines goes too."""
    _, gone = removed_lines(docs, doc_id, text, t)
    gone = gone.groupBy(F.col("doc").alias("__kindred_doc")).agg(F.collect_set("line").alias("__kindred_gone"))
    rows = docs.withColumn("__kindred_doc", F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63)))).join(gone, "__kindred_doc", "left")

    def cut(batches):
        for batch in batches:
            texts, numbers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for one, of in zip(texts, numbers, strict=True):
                drop = set(of)
                left = "\n".join(x for k, x in enumerate((one or "").split("\n")) if k not in drop)
                out.append(left if left.strip() else None)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), *batch.columns[2:]], [text, *names])

    names = [c for c in docs.columns if c != text]
    whole = rows.where("__kindred_gone IS NULL").select(*docs.columns)
    shorter = rows.where("__kindred_gone IS NOT NULL").select(text, "__kindred_gone", *names)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (text, *names))
    return whole.unionByName(common.arrow(shorter, cut, schema).where(F.col(text).isNotNull()))


def op3_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"))

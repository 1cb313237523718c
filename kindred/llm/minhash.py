"""Near-duplicate documents: SuperMinHash signatures, banding, verification, grouping.

A document's set is its distinct shingles of five words. In SuperMinHash every
element goes through the positions of the signature in a random order of its
own and gives the position at rank j the value j + r with r in [0, 1); each
position keeps the least. Ranks of one element are correlated over the
positions, each taken once, which lowers the variance. Elements stop early: once
every position has a value below j + 1, ranks above j change nothing. All
elements of a batch go through rank 0 together, and only documents with open
positions go on.

Signatures are cut into bands, and documents with an equal band may be linked.
Equal sets are one node from the start. In each bucket every node is first
compared with one leader, which joins groups of any size by as many pairs as
they have members. What a leader leaves apart is settled exactly: nodes of
buckets that still hold several components are posted under their rarest
shingles, of which two similar sets share one, and pairs of different components
that pass the length filter and the positional filter are compared. Two sets
that are made from one text by edits of their own, or that share a passage, have
rarest shingles of their own, so next to none of them meet. Comparisons take the
full sets, so no link is a guess; sets are cut out of the texts again for the
nodes of buckets alone, which workers know by a bitmap, and no text is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, components, words

POSITIONS, BANDS, WORDS, PERCENT = 128, 32, 5, 75
#: Bits of the sketch that orders shingles by rarity; postings of a bucket, about; entries from which a list is long; rows and columns of a block of comparisons.
SKETCH_BITS, BUCKET_ROWS, LONG, ROWS, COLUMNS = 22, 400_000, 64, 256, 4096
#: What stands for a null id.
NO_ID = 2**63 - 1
_U = np.uint64
_BITS = 25
#: Elements whose positions are dealt together beyond rank 0; each takes POSITIONS bytes.
_CHUNK = 100_000


def shingles(column: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within it, and the texts' bounds."""
    word, bounds = words.tokens(column)
    count = np.diff(bounds)
    total = len(word)
    owner = np.repeat(np.arange(len(count)), count)
    size = np.minimum(count, n)[owner]
    begins = (np.arange(total) - bounds[:-1][owner] + size <= count[owner]) if total else np.zeros(0, bool)
    out = np.zeros(total, dtype=np.uint64)
    for k in range(n):
        has = size > k
        shifted = np.zeros(total, dtype=np.uint64)
        shifted[: total - k] = word[k:]
        out = np.where(has, words.mix(out * _U(0x9E3779B97F4A7C15) + shifted + _U(k + 1)), out)
    out, owner = out[begins], owner[begins]
    at = np.searchsorted(owner, np.arange(len(count) + 1))
    for a, b in zip(at[:-1], at[1:], strict=True):
        out[a:b].sort()
    fresh = np.ones(len(out), dtype=bool)
    fresh[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[fresh], np.searchsorted(owner[fresh], np.arange(len(count) + 1))


def signatures(elements: np.ndarray, bounds: np.ndarray, m: int = POSITIONS) -> np.ndarray:
    """A row of m values (rank << 25 | 25 random bits) for every set; sets without elements keep the largest value."""
    sets = len(bounds) - 1
    out = np.full((sets, m), np.iinfo(np.uint32).max, dtype=np.uint32)
    flat, low = out.reshape(-1), _U((1 << _BITS) - 1)
    owner = np.repeat(np.arange(sets), np.diff(bounds))
    draw = lambda x, j: words.mix(x + _U((j * 0xA0761D6478BD642F + 0x8EBC6AF09C88C6E3) & (2**64 - 1)))
    place = lambda u, width: ((u >> _U(32)) * _U(width)) >> _U(32)
    first = draw(elements, 0)
    np.minimum.at(flat, owner * m + place(first, m).astype(np.int64), (first & low).astype(np.uint32))
    open_ = np.flatnonzero((out.max(axis=1) >= 1 << _BITS) & (np.diff(bounds) > 0))
    at = 0
    while at < len(open_):
        size = np.cumsum(bounds[open_[at:] + 1] - bounds[open_[at:]])
        to = at + max(1, int(np.searchsorted(size, _CHUNK, side="right")))
        which = open_[at:to]
        index = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in which])
        x, mine = elements[index], owner[index]
        order = np.tile(np.arange(m, dtype=np.uint8), (len(x), 1))
        rows = np.arange(len(x))
        k = place(first[index], m).astype(np.int64)
        order[rows, k] = order[:, 0]
        for j in range(1, m):
            u = draw(x, j)
            k = j + place(u, m - j).astype(np.int64)
            position = order[rows, k].astype(np.int64)
            order[rows, k] = order[rows, j]
            np.minimum.at(flat, mine * m + position, (_U(j << _BITS) | (u & low)).astype(np.uint32))
            done = out[which].max(axis=1) < (j + 1) << _BITS
            if done.all():
                break
            if done.any():
                stay = ~np.isin(mine, which[done])
                which, x, mine, order = which[~done], x[stay], mine[stay], order[stay]
                rows = np.arange(len(x))
        at = to
    return out


def bands(signature: np.ndarray, count: int = BANDS) -> np.ndarray:
    """A 64-bit key for each band of each signature; keys of different bands differ."""
    rows = signature.reshape(len(signature), count, -1).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for k in range(rows.shape[2]):
        out = words.mix(out * _U(0x9E3779B97F4A7C15) + rows[:, :, k])
    return out


def set_keys(elements: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit key of each whole set, the same for equal sets."""
    sums = np.zeros(len(elements) + 1, dtype=np.uint64)
    np.cumsum(words.mix(elements ^ _U(0x5851F42D4C957F2D)), out=sums[1:])
    return words.mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _lists(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), _longs(flat))


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text); a null id is the largest number."""
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(text).alias("text"))


def signed(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, node, bands) of every row of (doc_id, text)."""

    def run(batches):
        for batch in common.pieces(batches, 1):
            elements, at = shingles(batch.column(1), n)
            keys = bands(signatures(elements, at))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at), pa.int64()), _longs(set_keys(elements, at)), _lists(keys.reshape(-1), np.arange(len(keys) + 1) * BANDS)], ["doc_id", "n_shingles", "node", "bands"])

    return common.arrow(docs, run, "doc_id long, n_shingles long, node long, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(node, shingles) of the nodes wanted, a table of (node, rep) without repeats, cut out of the texts of (doc_id, text)."""
    bitmap, bits = common.marked(wanted, ["rep"], wanted.count())
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        for batch in common.pieces(batches, 1):
            use = common.is_marked(sent.value, common.cells([batch.column(0).to_numpy()], bits))
            if use.any():
                batch = batch.filter(pa.array(use))
                elements, at = shingles(batch.column(1), n)
                yield pa.RecordBatch.from_arrays([batch.column(0), _longs(set_keys(elements, at)), _lists(elements, at)], ["doc_id", "node", "shingles"])

    found = common.arrow(docs, run, "doc_id long, node long, shingles array<long>")
    return found.hint("merge").join(wanted, "node").where("doc_id = rep").select("node", "shingles").dropDuplicates(["node"])


def need(mx, my, percent: int):
    """How many elements two sets of these sizes must share."""
    return -(-percent * (mx + my) // (100 + percent))


def crossing(token: np.ndarray, node: np.ndarray, component: np.ndarray, m: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of nodes of different components that share a token as their first and pass the filters; (a, b) with a < b.

    An entry stays only if its list has another one of a size that its position
    leaves possible; then a list's entries are compared with those outside of
    its largest component.
    """
    order = np.lexsort((m, token))
    token, node, component, m, at = (x[order] for x in (token, node, component, m, at))
    rank = np.cumsum(np.concatenate([np.zeros(min(1, len(token)), np.int64), token[1:] != token[:-1]])) << 32
    most = (m - at) * (100 + percent) // percent - m  # of more elements a partner would have to share more than are left
    low, high = (np.searchsorted(rank | m, rank | np.clip(x, 0, 2**32 - 1), side) for x, side in ((-(-percent * m // 100), "left"), (most, "right")))
    stay = high - low > (most >= m)
    token, node, component, m, at = (x[stay] for x in (token, node, component, m, at))
    order = np.lexsort((component, token))
    token, node, component, m, at = (x[order] for x in (token, node, component, m, at))
    head = np.flatnonzero(np.concatenate([np.ones(min(1, len(token)), bool), token[1:] != token[:-1]]))
    length = np.diff(np.append(head, len(token)))
    mixed = component[head] != component[head + length - 1] if len(head) else np.zeros(0, bool)
    start, size = np.repeat(head, length), np.repeat(length, length)
    place = np.arange(len(token)) - start
    out = [np.zeros((0, 2), np.int64)]

    def add(x, y):
        fit = (component[x] != component[y]) & (100 * np.minimum(m[x], m[y]) >= percent * np.maximum(m[x], m[y]))
        fit &= np.minimum(m[x] - at[x], m[y] - at[y]) >= need(m[x], m[y], percent)
        x, y = np.broadcast_arrays(x, y)
        out.append(np.sort(np.stack([node[x[fit]], node[y[fit]]], axis=1), axis=1))
        if sum(map(len, out)) > 1 << 20:
            out[:] = [np.unique(np.concatenate(out), axis=0)]

    later = np.flatnonzero((place > 0) & (size <= LONG) & np.repeat(mixed, length))
    step = 0
    while len(later):
        add(start[later] + step, later)
        step += 1
        later = later[place[later] > step]
    for g in np.flatnonzero(mixed & (length > LONG)):
        own = np.arange(head[g], head[g] + length[g])
        edge = np.flatnonzero(np.concatenate([[True], component[own][1:] != component[own][:-1]]))
        largest = int(np.argmax(np.diff(np.append(edge, len(own)))))
        few = own[component[own] != component[own[edge[largest]]]]  # all but the largest component, against every entry
        for i in range(0, len(few), ROWS):
            for j in range(0, len(own), COLUMNS):
                add(few[i : i + ROWS, None], own[None, j : j + COLUMNS])
    return np.unique(np.concatenate(out), axis=0)


def _across(sets: DataFrame, open_: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of open nodes (node, component) of different components whose sets may be similar."""
    spark = sets.sparkSession

    def count(batches):
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint64)
        for batch in common.list_pieces(batches, 0):
            flat = batch.column(0).flatten().to_numpy().view(np.uint64)
            np.add.at(sketch, (flat >> _U(64 - SKETCH_BITS)).astype(np.int64), _U(1))
        if sketch.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(common.CHUNKS), pa.int32()), pa.array(common.packed(sketch), pa.binary())], ["chunk", "blob"])

    total = common.combined(common.arrow(sets.select("shingles"), count, "chunk int, blob binary"), np.uint64, 1 << SKETCH_BITS)
    rarity = spark.sparkContext.broadcast(np.minimum(255, 8 * np.log2(1 + total.astype(np.float64))).astype(np.uint8))
    rows = open_.join(sets.hint("merge"), "node").select("node", "component", "shingles")
    size = open_.join(sets.select("node", F.size("shingles").alias("n")), "node").agg(F.sum("n")).first()[0] or 0
    buckets = max(1, int(size * (100 - percent) / 100 // BUCKET_ROWS) + 1)

    def post(batches):
        for batch in common.list_pieces(batches, 2):
            bounds = batch.column(2).offsets.to_numpy().astype(np.int64)
            bounds, flat = bounds - bounds[0], batch.column(2).flatten().to_numpy().view(np.uint64)
            m = np.diff(bounds)
            own = np.repeat(np.arange(len(m)), m)
            order = np.lexsort((flat, rarity.value[(flat >> _U(64 - SKETCH_BITS)).astype(np.int64)], own))
            at = np.arange(len(flat)) - bounds[:-1][own]
            use = at < (m + (-percent * m) // 100 + 1)[own]
            token, own, at = flat[order][use], own[use], at[use]
            to = (words.mix(token) % _U(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cut = np.searchsorted(to[order], np.arange(buckets + 1))
            node, component = (batch.column(k).to_numpy() for k in (0, 1))
            full = [b for b in range(buckets) if cut[b] < cut[b + 1]]
            posts = np.stack([token.view(np.int64), node[own], component[own], m[own], at])[:, order]
            blobs = [pa.compress(posts[:, cut[b] : cut[b + 1]].tobytes(), codec="zstd", asbytes=True) for b in full]
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([int(cut[b + 1] - cut[b]) for b in full], pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "n", "posts"])

    def pair(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(pa.decompress(b.as_buffer(), 40 * n.as_py(), codec="zstd"), dtype=np.int64).reshape(5, -1) for b, n in zip(table["posts"], table["n"], strict=True)]
        found = crossing(*np.concatenate(parts, axis=1), percent)
        return pa.table({"a": pa.array(found[:, 0].copy()), "b": pa.array(found[:, 1].copy())})

    return common.arrow(rows, post, "bucket int, n int, posts binary").groupBy("bucket").applyInArrow(common.of_group(pair), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Texts without words, null ones too, have an empty set and are linked with
    nothing. Equal sets are linked always. Rows with equal ids are documents
    of their own, each linked by its text. A null id comes after all others:
    its rows are linked like any, a group of them alone has a null
    ``component_id``, and its rows are all kept. An empty table gives no rows.
    """
    docs = _named(docs, doc_id, text)
    rows = common.kept(signed(docs, n), "minhash-signatures")
    reps = common.kept(rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("rep")), "minhash-nodes")
    banded = rows.where("n_shingles > 0").select("node", "n_shingles", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("members")).where("members > 1").select("band")
    inside = common.kept(banded.join(shared.hint("merge"), "band").distinct(), "minhash-buckets")
    # a text that others were made from meets more of them than they meet each other: the leader is the member with most company
    buckets = inside.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    inside = inside.join(buckets, "band")
    company = inside.groupBy("node").agg(F.sum("members").alias("company"))
    inside = common.kept(inside.drop("members").join(company, "node"), "minhash-company")
    sets = common.kept(_sets(docs, reps.join(inside.select("node").distinct(), "node", "left_semi"), n), "minhash-sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        left, right = sets.selectExpr("node AS a", "shingles AS x"), sets.selectExpr("node AS b", "shingles AS y")
        both = pairs.join(right, "b").join(left, "a").withColumn("common", F.size(F.array_intersect("x", "y")))
        return both.where(f"100 * common >= {percent} * (size(x) + size(y) - common)").select("a", "b")

    leaders = inside.groupBy("band").agg(F.max(F.struct("company", "node", "n_shingles")).alias("lead"))
    led = inside.join(leaders, "band").where(f"node <> lead.node AND 100 * least(n_shingles, lead.n_shingles) >= {percent} * greatest(n_shingles, lead.n_shingles)")
    led = led.selectExpr("least(node, lead.node) AS a", "greatest(node, lead.node) AS b").distinct()
    links = common.kept(confirmed(led.hint("merge")), "minhash-links")
    placed = inside.select("band", "node").join(components.components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = common.kept(placed, "minhash-placed")
    mixed = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("band")
    open_ = common.kept(placed.join(mixed, "band", "left_semi").select("node", "component").distinct(), "minhash-open")
    across = common.kept(_across(sets, open_, percent), "minhash-across")
    found = components.components(links.unionByName(confirmed(across)))
    named = reps.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = common.kept(named, "minhash-components")
    named = named.join(named.groupBy("component").agg(F.min("rep").alias("component_id")), "component").select("node", "component_id")
    out = rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node")).join(named, "node", "left")
    out = out.select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_shingles", F.nullif(F.coalesce("component_id", "doc_id"), F.lit(NO_ID)).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"))


SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS sh
  FROM d
), e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s WHERE len(sh) > 0),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), l AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
r AS (SELECT doc_id AS x, doc_id AS y FROM s UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, m.c AS component_id, s.doc_id = m.c AS kept
FROM s JOIN (SELECT x, min(y) AS c FROM r GROUP BY x) m ON m.x = s.doc_id
"""

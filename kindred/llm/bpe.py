"""Byte-level BPE encoding and decoding with a lazily determinised transducer.

A sequence of tokens is the one that the merges give exactly if every token is
its own encoding and every two neighbours are the encoding of their
concatenation. So the encoder is a nondeterministic transducer over bytes: a
path is a place in a trie of the tokens and the token before it; at the end of
a token it may go on in the trie or start the next token, if the two agree.
``Transducer`` determinises it lazily: a state is the set of trie places that
are open, from the longest to the shortest, and a step gives the next state and
the tokens that may end there; both are kept by (state, byte). The token before
each open path is a register: for every prefix of the input one token is its
last, the one that agrees with the last token of the prefix that it leaves.
What all open paths have in common is certain and is given out: ``stream`` keeps
registers for the bytes behind the last token given out alone, so what it holds
is a window of a few tokens, however long the input. A match that is shorter
than a window is encoded at once: its bytes are the lookahead.

``StreamDecoder`` turns ids into text as they come. It is a state machine over
bytes whose state is the unfinished character; it is determinised over tokens
as they are met, so a token that was met in a state is one look-up.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Pairs of tokens that a worker keeps, beyond which their table starts anew; bytes of words, each with OVERHEAD more, in either of its two generations. States are no more than trie places.
MAX_PAIRS, MAX_BYTES, OVERHEAD = 300_000, 24 << 20, 200
#: Bytes of text that are split at once; bytes of a match from which it is streamed, and after which a stream looks for what is certain.
PIECE, WINDOW, EVERY = 1 << 20, 256, 64


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.single = {t[0]: i for t, i in ranks.items() if len(t) == 1}
        if len(self.single) < 256:
            raise ValueError("the ranks must have all single bytes")
        self.children: list[dict[int, int]] = [{}]  # the trie of tokens that are their own encoding
        self.ends: list[int] = [-1]
        self.agreed: list[dict[int, bool]] = [{} for _ in range(max(ranks.values()) + 1)]  # by the first token
        self.pairs = 0
        self.halves: dict[int, tuple[int, int]] = {}  # the two tokens whose merge makes a token
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                parts = self.merged(token, rank)
                if len(parts) == 2:
                    self.halves[rank] = (parts[0], parts[1])
            if len(token) == 1 or rank in self.halves:
                at = 0
                for byte in token:
                    nxt = self.children[at].get(byte)
                    if nxt is None:
                        nxt = self.children[at][byte] = len(self.children)
                        self.children.append({})
                        self.ends.append(-1)
                    at = nxt
                self.ends[at] = rank
        # A state: the open trie places as (place, length), the longest first. A step: the next state and (length, token) of what may end there.
        self.states: list[tuple] = [()]
        self.number: dict[tuple, int] = {(): 0}
        self.steps: list[dict[int, tuple[int, tuple[tuple[int, int], ...]]]] = [{}]

    def merged(self, piece: bytes, below: int = 1 << 60) -> list[int]:
        """The rule itself, by ranks under ``below`` and lowest first: what the transducer is built from."""
        parts = [bytes([b]) for b in piece]
        while len(parts) > 1:
            best = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if best[0] >= below:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return [self.ranks[p] for p in parts]

    def agree(self, before: int, token: int) -> bool:
        """Whether two tokens may stand side by side."""
        known = self.agreed[before].get(token)
        if known is None:
            self.pairs += 1
            if self.pairs > MAX_PAIRS:
                self.pairs = 1
                for row in self.agreed:
                    row.clear()
            known = self.agreed[before][token] = not self.crossed(before, token)
        return known

    def crossed(self, a: int, b: int) -> bool:
        """Whether a merge takes bytes of both tokens.

        Merges are undone from the last: the tokens that touch at the border
        are split, the later merged one first, and at every stage a merge
        across the border wins if its rank comes before those undone.
        """
        token, ranks, halves = self.token, self.ranks, self.halves
        left, right = a, b
        bound = 1 << 60  # a merge across the border counts if it comes before this
        while True:
            across = ranks.get(token[left] + token[right])
            if across is not None and across < bound:
                return True
            if left > right and left in halves:
                bound, left = left, halves[left][1]
            elif right in halves and (right >= left or left not in halves):
                # at one rank the leftmost merge is first, so a merge across the border comes before this one
                bound, right = right + 1, halves[right][0]
            elif left in halves:
                bound, left = left, halves[left][1]
            else:
                return False

    def step(self, state: int, byte: int) -> tuple[int, tuple[tuple[int, int], ...]]:
        """Works out what a byte does to a state, once for both."""
        open_, ends = [], []
        for place, length in (*self.states[state], (0, 0)):
            nxt = self.children[place].get(byte)
            if nxt is not None:
                if self.children[nxt]:
                    open_.append((nxt, length + 1))
                if self.ends[nxt] >= 0:
                    ends.append((length + 1, self.ends[nxt]))
        key = tuple(open_)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        found = self.steps[state][byte] = (to, tuple(ends))
        return found

    def read(self, byte: int, state: int, last: list[int]) -> int:
        """Reads one byte: appends the last token of the longer prefix and gives the next state."""
        state, ends = self.steps[state].get(byte) or self.step(state, byte)
        for length, token in ends:
            before = last[-length]
            if before < 0:
                break
            if self.agree(before, token):
                break
        else:
            raise AssertionError("no token ends here")
        last.append(token)
        return state

    def back(self, last: list[int], at: int, to: int = 0) -> list[int]:
        """The tokens of the prefix of length ``at`` from the bound ``to`` on."""
        out = []
        while at > to:
            out.append(last[at])
            at -= len(self.token[last[at]])
        return out[::-1] if at == to else []

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece of text."""
        return next(self.encode_sorted([piece]))

    def encode_sorted(self, pieces: Iterable[bytes]) -> Iterator[list[int]]:
        """The ids of each piece, read byte by byte; what a piece shares with the one before it isn't read again."""
        last, states, steps, agreed, before_it = [-1], [0], self.steps, self.agreed, b""
        for piece in pieces:
            at = 0
            for x, y in zip(piece, before_it, strict=False):
                if x != y:
                    break
                at += 1
            del last[at + 1 :], states[at + 1 :]
            state, before_it = states[at], piece
            for byte in piece[at:]:  # as read() does it, without a call for each byte
                state, ends = steps[state].get(byte) or self.step(state, byte)
                for length, token in ends:
                    before = last[-length]
                    if before < 0:
                        break
                    known = agreed[before].get(token)
                    if known or known is None and self.agree(before, token):
                        break
                last.append(token)
                states.append(state)
            yield self.back(last, len(piece))

    def stream(self, data: Iterable[bytes]) -> Iterator[int]:
        """The ids of one piece that comes in parts, each given out once all open paths share it.

        ``last`` has the registers of the window alone: its first entry is the
        last token given out, with which the next one must agree. Every ``EVERY`` bytes the
        window's certain tokens are given out and their registers dropped. The
        longest open path began no earlier than the window, so none looks back
        beyond it.
        """
        last, state, due = [-1], 0, EVERY
        for part in data:
            for byte in part:
                state = self.read(byte, state, last)
                due -= 1
                if due:
                    continue
                due, at, given = EVERY, len(last) - 1, 0
                paths = [self.back(last, at - length) for _, length in (*self.states[state], (0, 0))]
                for ids in zip(*paths, strict=False):
                    if len(set(ids)) > 1:
                        break
                    given += len(self.token[ids[0]])
                    yield ids[0]
                del last[:given]
        yield from self.back(last, len(last) - 1)


def _follow(byte: int) -> tuple[int, int, int]:
    """Of a first byte: how many bytes follow, and the bounds of the next one; -1 where no character starts."""
    if byte < 0x80:
        return 0, 0, 0
    if 0xC2 <= byte < 0xE0:
        return 1, 0x80, 0xBF
    if 0xE0 <= byte < 0xF0:
        return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
    if 0xF0 <= byte < 0xF5:
        return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
    return -1, 0, 0


def utf8_step(state: bytes, byte: int) -> tuple[bytes, str]:
    """The machine over bytes: from the bytes of an unfinished character and the next byte, the new state and what is certain.

    Bytes that can't be UTF-8 become U+FFFD, the longest beginning of a
    character once.
    """
    if state:
        more, low, high = _follow(state[0])
        if len(state) > 1:
            low, high = 0x80, 0xBF
        if low <= byte <= high:
            whole = state + bytes([byte])
            return (b"", whole.decode()) if len(whole) > more else (whole, "")
        after, text = utf8_step(b"", byte)
        return after, "\ufffd" + text
    more = _follow(byte)[0]
    if more < 0:
        return b"", "\ufffd"
    return (bytes([byte]), "") if more else (b"", chr(byte))


class Decoder:
    """The machine over tokens: steps by state and token, made from ``utf8_step`` when they are met."""

    def __init__(self, token: dict[int, bytes]):
        self.token, self.steps = token, {b"": {}}

    def step(self, state: bytes, token: int) -> tuple[bytes, str]:
        after, out = state, []
        for byte in self.token[token]:
            after, text = utf8_step(after, byte)
            out.append(text)
        self.steps.setdefault(after, {})
        found = self.steps[state][token] = (after, "".join(out))
        return found


class StreamDecoder:
    """Gives text as ids come; an unfinished character waits for its other bytes in ``state``."""

    def __init__(self, machine: Decoder):
        self.machine, self.state = machine, b""

    def push(self, ids: Iterable[int]) -> str:
        steps, state, out = self.machine.steps, self.state, []
        row = steps[state]
        for token in ids:
            after, text = row.get(token) or self.machine.step(state, token)
            out.append(text)
            if after != state:
                state, row = after, steps[after]
        self.state = state
        return "".join(out)

    def close(self) -> str:
        state, self.state = self.state, b""
        return "\ufffd" if state else ""


#: For texts of these characters alone, PLAIN splits as the public pattern does: the two classes of letters agree on them.
COMMON = re.compile("[^\\t\\n\\r -~\\xa1-\\xb1\\xb4-\\xb8\\xba\\xbb\\xbf-\u02af\u2010-\u2027\u20ac]")
PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


class Tokenizer:
    """Splits texts by a pattern and encodes each match; keeps what the transducer gave for the matches that it met lately.

    Matches are kept in two generations of ``MAX_BYTES``: when the young one is
    full it becomes the old one, and what is met again in the old one moves on.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import public_tokenizers
        import regex

        self.machine = Transducer(ranks)
        self.full = regex.compile(pattern).findall
        self.public = pattern == public_tokenizers.PATTERN
        self.token = self.machine.token
        self.decoder = Decoder(self.token)
        self.known: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}
        self.held = 0

    def split(self, text: str) -> list[str]:
        return PLAIN.findall(text) if self.public and not COMMON.search(text) else self.full(text)

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text; matches that are new to the table are encoded in one go, sorted."""
        matches = [self.split(t) for t in texts]
        if self.held > MAX_BYTES:
            self.known, self.old, self.held = {}, self.known, 0
        known = self.known
        missing = set().union(*matches).difference(known)
        pieces, long_ = [], {}
        for word in missing:
            ids = self.old.get(word)
            if ids is None:
                data = word.encode("utf-8", "surrogatepass")
                if len(data) > WINDOW:  # as many ids as it has, none kept
                    long_[word] = data
                else:
                    pieces.append(data)
            else:
                known[word] = ids
                self.held += len(word) + OVERHEAD
        pieces.sort()
        for piece, ids in zip(pieces, self.machine.encode_sorted(pieces), strict=True):
            known[piece.decode("utf-8", "surrogatepass")] = ids
            self.held += len(piece) + OVERHEAD
        for word, data in long_.items():
            long_[word] = list(self.machine.stream([data]))
        for one in matches:
            if long_:
                yield list(chain.from_iterable(long_[w] if w in long_ else known[w] for w in one))
            else:
                yield list(chain.from_iterable(map(known.__getitem__, one)))

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_BUILT: dict = {}
common.CACHES[__name__] = _BUILT


def tokenizer(ranks, pattern: str) -> Tokenizer:
    """A worker builds it once for each broadcast of ranks."""
    key = (id(ranks), pattern)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = (ranks, Tokenizer(ranks, pattern))
    return _BUILT[key][1]


def _pieces(text: list, size: int = 1 << 12) -> Iterator[slice]:
    return (slice(i, i + size) for i in range(0, len(text), size))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ids array<int>, n_tokens, decoded (the text given back by the stream decoder).

    A null text is taken as empty and has no ids; repeated rows are encoded
    each, an empty table gives no rows. The ranks, a vocabulary of fixed size,
    are broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    rows = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches):
        use = tokenizer(sent.value, pattern)
        for batch in common.pieces(batches, len(keep), PIECE):
            ids = list(use.encode_all([t or "" for t in batch.column(len(keep)).to_pylist()]))
            decoded = []
            for one in ids:
                stream = StreamDecoder(use.decoder)
                decoded.append("".join([stream.push(one[s]) for s in _pieces(one)] + [stream.close()]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64()), pa.array(decoded, pa.string())],
                [*keep, "ids", "n_tokens", "decoded"],
            )

    return common.arrow(rows, run, f"{schema}, ids array<int>, n_tokens long, decoded string")


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the same encoding, of which only digests leave the worker.

    Null texts, repeated rows and empty tables are as in ``encode``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        use = tokenizer(sent.value, pattern)
        digits = {i: str(i) for i in use.token}
        for batch in common.pieces(batches, 1, PIECE):
            n, a, b = [], [], []
            for ids in use.encode_all([t or "" for t in batch.column(1).to_pylist()]):
                n.append(len(ids))
                a.append(hashlib.sha256(",".join(map(digits.__getitem__, ids)).encode()).hexdigest())
                stream, total = StreamDecoder(use.decoder), hashlib.sha256()
                for s in _pieces(ids):
                    total.update(stream.push(ids[s]).encode())
                total.update(stream.close().encode())
                b.append(total.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return common.arrow(docs.select("doc_id", F.col(text).alias("text")), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def vocabulary() -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    return read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.table(spark, sf_dir, "documents"), *vocabulary())

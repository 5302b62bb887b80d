"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece there is exactly one token that can end its encoding: a suffix that is a token and that
fits the last token of the prefix before it, where two tokens fit if merging their joined bytes gives back just those
two. Storing that token for every prefix gives the encoding by walking back from the end, makes an append exact
without looking back further than the longest token, and lets an edit stop as soon as the table agrees with the old.
"""

from __future__ import annotations

import base64
import math
import uuid
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: How many pieces, and how many pairs of tokens, a worker remembers (beginnings: a sixth). Pieces and pairs are held in two
#: halves: when the newer is full it becomes the older, from which what is met again is taken over; beginnings start anew.
PIECES = 600_000
#: Lengths of the beginnings whose tables are kept for the next piece that begins so.
KEPT = (12, 9, 6)
#: Bytes of text whose encoding goes into one output batch, at least one document.
BATCH_BYTES = 1 << 20


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Ranks from a file of `base64 rank` lines; the file is the bound of what is sent to the workers."""
    if "://" in path:
        lines = [r.value for r in spark.read.text(path).collect()]
    else:
        with open(path, encoding="ascii") as f:
            lines = f.read().splitlines()
    return {base64.b64decode(a): int(b) for a, b in map(str.split, filter(str.strip, lines))}


class Bpe:
    """Encoder and decoder for one vocabulary, whose every token must be what its own bytes merge to."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, pieces: int = PIECES):
        self.pieces = pieces
        # \s of the rank files' library is the Unicode property; this one's would add \x1c to \x1f
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.ranks, self.tokens = ranks, {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        ending: dict[bytes, set[int]] = {}
        for t in ranks:
            for n in range(1, min(3, len(t)) + 1):
                ending.setdefault(t[-n:], set()).add(len(t))
        #: By its last three bytes (fewer at the start), how long a token there can be, longest first.
        self.lengths = {e: sorted(set().union(n, *({k for k in ending.get(e[i:], ()) if k == len(e) - i} for i in range(1, len(e)))), reverse=True) for e, n in ending.items()}
        self.spines: dict[tuple[int, bool], list[tuple[bytes, float]]] = {}
        self.pairs: dict[int, bool] = {}  # by the left token's id above the right one's
        self.older: dict[int, bool] = {}
        self.heads: dict[bytes, tuple[int, ...]] = {}
        self.memo = _Memo(self)

    def merge(self, data: bytes) -> list[int]:
        """The defining procedure: join the lowest-ranked neighbours until none can be; quadratic, for short data."""
        cuts = list(range(len(data) + 1))
        get = self.ranks.get
        far = len(self.ranks) + len(self.tokens) + 1
        while len(cuts) > 2:
            low, at = min((get(data[a:b], far), k) for k, (a, b) in enumerate(zip(cuts, cuts[2:])))
            if low == far:
                break
            del cuts[at + 1]
        return [self.ranks[data[a:b]] for a, b in zip(cuts, cuts[1:])]

    def fit(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is None:
            known = self.older.get(pair)
            if known is None:
                known = self._apart(left, right)
            if len(self.pairs) >= self.pieces // 2:
                self.older = self.pairs.copy()
                self.pairs.clear()  # extend() holds the table itself
            self.pairs[pair] = known
        return known

    def _spine(self, token: int, right: bool) -> list[tuple[bytes, float]]:
        """The parts at one edge of a token, from its byte to itself, each with the rank at which it is merged further."""
        known = self.spines.get((token, right))
        if known is None:
            known, whole, until = [], self.tokens[token], math.inf
            while True:
                known.append((whole, until))
                if len(whole) == 1:
                    break
                until = self.ranks[whole]
                a, b = self._halves(whole)
                whole = b if right else a
            known.reverse()
            self.spines[token, right] = known
        return known

    def _halves(self, whole: bytes) -> tuple[bytes, bytes]:
        """What a token's last merge joins: the same procedure, kept from making the token itself."""
        own = self.ranks.pop(whole)
        try:
            a, b = self.merge(whole)
        finally:
            self.ranks[whole] = own
        return self.tokens[a], self.tokens[b]

    def _apart(self, left: int, right: int) -> bool:
        """Do two tokens stay as they are when joined? At any time one part of each meets at the border; the tokens
        stay apart unless these two parts merge before either is merged into its own token's next larger part."""
        x, y = self._spine(left, True), self._spine(right, False)
        i = j = 0
        get = self.ranks.get
        while True:
            (a, up), (b, down) = x[i], y[j]
            across = get(a + b)
            if across is not None and across < up and across <= down:  # of equal ranks, the merge further left comes first
                return False
            if up == down == math.inf:
                return True
            if up <= down:
                i += 1
            else:
                j += 1

    def extend(self, data: bytes, last: list[int], end: int | None = None) -> list[int]:
        """Fill `last` (last[k] ends the encoding of data[:k+1]) up to `end`."""
        get, lengths, pairs, fit = self.ranks.get, self.lengths, self.pairs, self.fit
        for k in range(len(last) + 1, (len(data) if end is None else end) + 1):
            for n in lengths.get(data[max(0, k - 3) : k]) or lengths.get(data[k - 2 : k]) or (1,):
                s = k - n
                if s < 0:
                    continue
                t = get(data[s:k])
                if t is None:
                    continue
                if s == 0 or pairs.get(p := last[s - 1] << 32 | t) or p not in pairs and fit(last[s - 1], t):
                    last.append(t)
                    break
            else:
                raise ValueError(f"no token ends the first {k} bytes; the vocabulary lacks a byte")
        return last

    def back(self, last: list[int]) -> list[int]:
        out, k = [], len(last)
        while k:
            out.append(last[k - 1])
            k -= len(self.tokens[last[k - 1]])
        return out[::-1]

    def piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        last: list[int] = []
        for n in KEPT:
            if n < len(data) and (known := self.heads.get(data[:n])):
                last = list(known)
                break
        begun = len(last)
        self.extend(data, last)
        for n in KEPT:
            if begun < n < len(data):
                if len(self.heads) >= self.pieces // 6:
                    self.heads.clear()
                self.heads[data[:n]] = tuple(last[:n])
        return self.back(last)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join([self.memo[x] for x in self.split(text)]), dtype="<i4")

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Memo(dict):
    """Piece to its ids, packed."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.older = bpe, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = np.array(self.bpe.piece(piece.encode()), dtype="<i4").tobytes()
        if len(piece) <= 256:
            if len(self) >= self.bpe.pieces // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Piece:
    """One piece of text with its table: appends are exact, and edits redo only what they touch."""

    def __init__(self, bpe: Bpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, data, bpe.extend(data, [])

    @property
    def ids(self) -> list[int]:
        return self.bpe.back(self.last)

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.extend(self.data, self.last)

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace data[start:end]; returns how many prefixes were looked at again.

        Once as many consecutive prefixes as the longest token has bytes end as they did before, so do all that follow.
        """
        old, tail = self.last, end - start - len(new)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[:start]
        self.bpe.extend(self.data, self.last, start + len(new))
        agreed = 0
        for k in range(start + len(new), len(self.data)):
            self.bpe.extend(self.data, self.last, k + 1)
            # a token that reaches back into what changed proves nothing
            clear = k + 1 - len(self.bpe.tokens[self.last[k]]) >= start + len(new)
            agreed = agreed + 1 if clear and self.last[k] == old[k + tail] else 0
            if agreed >= self.bpe.longest:
                self.last += old[k + tail + 1 :]
                return k + 1 - start
        return len(self.data) - start


#: A worker's encoder, kept while it serves the same vocabulary.
_AT: dict[str, Bpe] = {}


def _encoder(ranks: Callable[[], dict[bytes, int]], key: str, pattern: str, pieces: int, decode: bool):
    def run(batches):
        bpe = _AT.get(key)
        if bpe is None:
            _AT.clear()
            bpe = _AT[key] = Bpe(ranks(), pattern, pieces)
        for b in batches:
            texts = b.column(1)
            start = 0
            while start < b.num_rows:
                ids, decoded, stop, size = [], [], start, 0
                while stop < b.num_rows and (stop == start or size < BATCH_BYTES):
                    t = texts[stop].as_py() or ""
                    size += len(t)
                    ids.append(bpe.encode(t))
                    if decode:
                        decoded.append(bpe.decode(ids[-1].tolist()))
                    stop += 1
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32, copy=False)))
                columns = {"id": b.column(0).slice(start, stop - start), "ids": lists}
                if decode:
                    columns["decoded"] = pa.array(decoded, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)
                start = stop

    return run


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, id: str = "doc_id", text: str = "text", pieces: int = PIECES, decode: bool = True) -> DataFrame:
    """(id, ids, decoded): each text's token ids, and, unless `decode` is false, the bytes that these ids decode to.

    Whole texts; a null or empty one has no ids and decodes to no bytes. Repeated rows and null ids are kept as they
    are. Other columns are not looked at. A worker remembers up to `pieces` pieces, some 150 bytes each.
    """
    spark = df.sparkSession
    common.small_batches(spark)
    sent, key = spark.sparkContext.broadcast(ranks), uuid.uuid4().hex
    run = _encoder(lambda: sent.value, key, pattern, pieces, decode)
    return df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(common.frugal(run), "id long, ids array<int>" + ", decoded binary" * decode)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = encode(docs, read_ranks(spark, P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    return done.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

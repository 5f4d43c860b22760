"""Language-model scoring by prediction by partial matching (PPM), and a unigram base.

Model. A trie of byte contexts of up to ORDER bytes with the symbols that follow them in the training texts, each text
padded before its start and ended by an end symbol. A symbol is coded in the longest context that has been seen: with
probability count / (total + distinct), or after an escape of probability distinct / (total + distinct) (escape method
C) in the context shorter by one byte, without the symbols of the contexts that were escaped from (symbol
exclusion), down to all unseen symbols alike. The score of a text is the sum of log10 probabilities of its bytes (A-Z
lower-cased) and its end. Every count is of all training texts.

Exclusion in closed form. All contexts of a position are updated, so the symbols seen after a context are among
those seen after each shorter one: what is excluded in the shorter context are exactly the longer one's symbols, and
their counts there sum to a number of the longer context. So the code length of (context, symbol) follows from counts,
totals and that sum, all taken by sorting, with no walk through the trie.

Base. log10((c + 1) / (N + V + 1)) summed over words and one end per text; c, N, V are counts over all training texts.

Scale. The trie isn't broadcast and has no bound: it is a table. A partition's texts are cut into pieces of about PIECE_BYTES; each
piece's distinct (ORDER + 1)-byte strings and words, with their training counts, are packed by family (a hash of a context's
last three bytes, or the first bits of a word's hash) as compressed differences of sorted keys, and dealt by family. There the
counts of a family are summed over all pieces and each piece's keys get their code lengths or counts, packed alike; they
go back to the piece and meet its texts, which stream past them. A string that is everywhere is one number a piece, not one
row an occurrence, so frequent strings don't make hot tasks. Counts of three-byte strings, at most 2^24 numbers however
large the corpus, are broadcast. Texts are shuffled once, to meet their piece's values. A task holds one family of all
pieces, or the values of one piece and a batch of texts.

Words are known by 63 bits of a hash; two of a billion distinct words collide with a chance of a few per cent, and
then share a count.

Nulls and odd rows: a null text is empty and scores its end; null ids are in the training fold of the empty text's
crc32; repeated rows are all counted and scored alike; without training texts every byte costs log10(1 / 256).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, written
from .textvec import Words, chunks, mix

ORDER = 5
PIECE_BYTES = 32 << 20
#: A piece's number is its partition's, times 2^PIECE_BITS, plus its own there.
PIECE_BITS = 24
FAMILY_BITS = 12
START, END, SYMBOLS = 0xFE, 0xFF, 256
#: Keys of words have the top bit but one set; strings of up to six bytes never reach it.
WORD = np.int64(1) << np.int64(62)


def grams(block: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(the strings of order + 1 bytes that end at each byte or end of each text, where each text's begin)."""
    pad = bytes([START]) * order
    joined = np.frombuffer(b"".join(pad + b + bytes([END]) for b in block), dtype=np.uint8)
    n = np.array([len(b) + 1 for b in block])
    code = np.zeros(len(joined), dtype=np.int64)
    for k in range(order + 1):
        code[order:] |= joined[order - k : len(joined) - k].astype(np.int64) << (8 * k) if len(joined) > order else 0
    starts = np.concatenate([[0], np.cumsum(n + order)[:-1]]).astype(np.int64)
    inside = np.ones(len(joined), dtype=bool)
    for k in range(order):
        inside[starts + k] = False
    return code[inside], np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)


def word_keys(block: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(keys of the words, first word of each text and the end of the last)."""
    w = Words(block)
    return (w.hash >> np.uint64(2)).astype(np.int64) | WORD, w.first


#: The key of the end token of the base.
END_WORD = WORD


class _Sums:
    """Distinct keys with two sums, merged when many are held."""

    def __init__(self, most: int = 1 << 21):
        self.keys, self.n, self.held, self.most = [], [], 0, most

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.keys.append(keys)
        self.n.append(n)
        self.held += len(keys)
        if self.held > self.most:
            k, n = self.merged()
            self.keys, self.n, self.held = [k], [n], len(k)
            self.most = max(self.most, 2 * len(k))

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        keys, n = np.concatenate(self.keys), np.concatenate(self.n)
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.add.reduceat(n, first)


def packed(x: np.ndarray) -> bytes:
    """Numbers as compressed bytes, all first bytes together, then all second ones, and so on."""
    return zlib.compress(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes(), 1)


def unpacked(b: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(b), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def packed_keys(sorted_keys: np.ndarray) -> bytes:
    return packed(np.diff(sorted_keys, prepend=np.int64(0)))


def unpacked_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unpacked(b, "<i8"))


def families_of(keys: np.ndarray, word_bits: int) -> np.ndarray:
    """Strings: a hash of the context's last three bytes. Words: after those, the hash's first word_bits bits."""
    words = (1 << FAMILY_BITS) + ((keys >> np.int64(62 - word_bits)) & np.int64((1 << word_bits) - 1))
    strings = mix(((keys >> 8) & 0xFFFFFF).astype(np.uint64)) >> np.uint64(64 - FAMILY_BITS)
    return np.where(keys >= WORD, words, strings.astype(np.int64))


def pieces_of(b: pa.RecordBatch, state: list[int], piece_bytes: int) -> np.ndarray:
    """The batch's rows' pieces; state: [piece, its bytes], kept from batch to batch of a partition."""
    size = pc.fill_null(pc.binary_length(b.column("_t").cast(pa.large_binary())), 0).to_numpy().astype(np.int64) + 1
    out = np.empty(len(size), dtype=np.int64)
    if not state:
        state += [TaskContext.get().partitionId() << PIECE_BITS, 0]
    at = 0
    ends = np.cumsum(size)
    while at < len(size):  # a piece ends with the text that fills it, wherever batches end
        before = ends[at - 1] if at else 0
        upto = min(len(size), int(np.searchsorted(ends, before + piece_bytes - state[1])) + 1)
        out[at:upto] = state[0]
        state[1] += int(ends[upto - 1] - before)
        if state[1] >= piece_bytes:
            state[0], state[1] = state[0] + 1, 0
        at = upto
    return out


PACKED = "piece bigint, family int, keys binary, n binary"


def _piece_keys(order: int, word_bits: int, piece_bytes: int):
    """PACKED: each piece's distinct strings and words and how often training texts of the piece have them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, sums, state = None, _Sums(), []

        def done():
            k, n = sums.merged()
            f = families_of(k, word_bits)
            by = np.argsort(f, kind="stable")  # keys ascend in each family
            k, n, f = k[by], n[by], f[by]
            cut = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1], [True]]))
            parts = list(zip(cut[:-1], cut[1:], strict=True))
            columns = [pa.array([piece] * len(parts), pa.int64()), pa.array(f[cut[:-1]].astype(np.int32))]
            columns += [pa.array([packed_keys(k[x:y]) for x, y in parts], pa.binary()), pa.array([packed(n[x:y]) for x, y in parts], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["piece", "family", "keys", "n"])

        for b in batches:
            pieces, learn = pieces_of(b, state, piece_bytes), b.column("learn").to_numpy(zero_copy_only=False)
            texts = b.column("_t").to_pylist()
            cuts = [0, *(np.flatnonzero(np.diff(pieces)) + 1).tolist(), len(pieces)]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if y == x:
                    continue
                if piece is not None and pieces[x] != piece:
                    yield done()
                    sums = _Sums()
                piece = int(pieces[x])
                for train in (True, False):
                    for _, block in chunks([t for t, s in zip(texts[x:y], learn[x:y], strict=True) if bool(s) == train]):
                        for keys in (grams(block, order)[0], word_keys(block)[0], np.full(len(block), END_WORD)):
                            k, n = np.unique(keys, return_counts=True)
                            sums.add(k, n if train else np.zeros(len(k), dtype=np.int64))
        if piece is not None:
            yield done()

    return scan


def _pieced(piece_bytes: int):
    """doc_id, _t and the same pieces as _piece_keys has."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list[int] = []
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(pieces_of(b, state, piece_bytes)), b.column("doc_id"), b.column("_t")], names=["piece", "doc_id", "_t"])

    return scan


def _low_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(low, n): counts of three-byte strings (START or a byte, twice, then a byte or END) and, as low -1, of base tokens."""
    total, tokens = np.zeros(1 << 24, dtype=np.int64), 0
    for b in batches:
        for _, block in chunks(b.column("_t").to_pylist()):
            seen, n = np.unique(grams(block, 2)[0], return_counts=True)
            total[seen] += n
            tokens += len(Words(block)) + len(block)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[seen, -1]), pa.array(np.r_[total[seen], tokens])], names=["low", "n"])


class LowOrders:
    """Contexts of two bytes, one and none: counts, totals, distinct symbols, and what an escape from them excludes below."""

    def __init__(self, strings: np.ndarray, n: np.ndarray):
        """strings: the three-byte strings of training, ascending, and how often they occur."""
        self.strings, self.n = strings, n
        context, pair = strings >> 8, strings & 0xFFFF
        self.c1 = np.bincount(pair, weights=n, minlength=1 << 16).reshape(256, 256)
        self.t2 = np.bincount(context, weights=n, minlength=1 << 16)
        self.u2 = np.bincount(context, minlength=1 << 16)
        self.x2 = np.bincount(context, weights=self.c1.ravel()[pair], minlength=1 << 16)  # counts at order 1 of what it has seen
        self.t1, self.u1 = self.c1.sum(axis=1), (self.c1 > 0).sum(axis=1)
        self.c0 = self.c1.sum(axis=0)
        self.t0, self.u0 = int(self.c0.sum()), int((self.c0 > 0).sum())
        self.x1 = ((self.c1 > 0) * self.c0).sum(axis=1)

    def c2(self, strings: np.ndarray) -> np.ndarray:
        """How often each three-byte string occurs."""
        if not len(self.strings):
            return np.zeros(len(strings))
        at = np.searchsorted(self.strings, strings)
        at[at == len(self.strings)] = 0
        return np.where(self.strings[at] == strings, self.n[at], 0).astype(float)


def _step(c, total, distinct, out, escape, open_):
    """One order's part: adds log10 of what is coded here to out, of escapes to escape; returns what is still open.

    Where no symbol is left (total 0) nothing is paid: the escape is certain.
    """
    here = open_ & (c > 0)
    sure = np.maximum(total + distinct, 1)
    out[here] = escape[here] + np.log10(c[here] / sure[here])
    rest = open_ & (c == 0)
    pays = rest & (distinct > 0)
    escape[pays] += np.log10(distinct[pays] / sure[pays])
    return rest


def code_lengths(strings: np.ndarray, n: np.ndarray, low: LowOrders, order: int = ORDER) -> np.ndarray:
    """log10 probability of each string's last byte after its others.

    strings: distinct, ascending, with their training counts n (0: not in training), and complete: with a string of
    training every other one whose context ends in the same three bytes.
    """
    size = len(strings)
    counts, totals, distinct, excluded, context_of = {}, {}, {}, {}, {}
    for k in range(order, 2, -1):
        mask = np.int64((1 << (8 * (k + 1))) - 1)
        g, inverse = np.unique(strings & mask, return_inverse=True)
        c = np.bincount(inverse, weights=n, minlength=len(g))
        ctx, of = np.unique(g >> 8, return_inverse=True)
        counts[k] = c[inverse]
        totals[k] = np.bincount(of, weights=c)[of][inverse]
        distinct[k] = np.bincount(of, weights=c > 0)[of][inverse]
        context_of[k] = (g, c, of, inverse)
    b2, b1, s = (strings >> 8) & 0xFFFF, (strings >> 8) & 0xFF, strings & 0xFF
    counts[2], totals[2], distinct[2], excluded[2] = low.c2(strings & 0xFFFFFF), low.t2[b2], low.u2[b2], low.x2[b2]
    counts[1], totals[1], distinct[1], excluded[1] = low.c1[b1, s], low.t1[b1], low.u1[b1], low.x1[b1]
    counts[0], totals[0], distinct[0] = low.c0[s], np.full(size, low.t0), np.full(size, low.u0)
    for k in range(order, 2, -1):
        g, c, of, inverse = context_of[k]
        shorter = g & np.int64((1 << (8 * k)) - 1)
        if k > 3:
            g2, c2, _, _ = context_of[k - 1]
            below = c2[np.searchsorted(g2, shorter)]
        else:
            below = low.c2(shorter)
        excluded[k] = np.bincount(of, weights=np.where(c > 0, below, 0))[of][inverse]
    out, escape = np.zeros(size), np.zeros(size)
    open_ = np.ones(size, dtype=bool)
    gone, gone_distinct = np.zeros(size), np.zeros(size)
    for k in range(order, -1, -1):
        open_ = _step(counts[k], totals[k] - gone, distinct[k] - gone_distinct, out, escape, open_)
        if k:
            seen = totals[k] > 0
            gone = np.where(seen, excluded[k], 0)
            gone_distinct = np.where(seen, distinct[k], 0)
    out[open_] = escape[open_] - np.log10(SYMBOLS - low.u0)
    return out


VALUED = "piece bigint, family int, keys binary, value binary, known bigint"


def _valued(low, order: int):
    """VALUED: the strings' code lengths (float32), the words' counts (int64); known: the family's words of training, once.

    Rows come sorted by family; one family is held at a time.
    """

    def of(family: int, rows: list[tuple]) -> pa.RecordBatch:
        keys = [unpacked_keys(r[1]) for r in rows]
        cut = np.cumsum([0, *map(len, keys)])
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(inverse, weights=np.concatenate([unpacked(r[2], "<i8") for r in rows]), minlength=len(distinct))
        words = family >= 1 << FAMILY_BITS
        value = count.astype(np.int64) if words else code_lengths(distinct, count, low.value, order).astype(np.float32)
        known = [int((count > 0).sum()) if words else 0] + [0] * (len(rows) - 1)
        columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([family] * len(rows), pa.int32()), pa.array([r[1] for r in rows], pa.binary())]
        columns.append(pa.array([packed(value[inverse[x:y]]) for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary()))
        return pa.RecordBatch.from_arrays([*columns, pa.array(known, pa.int64())], names=["piece", "family", "keys", "value", "known"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, held = None, []
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("family", "piece", "keys", "n")), strict=True):
                if held and row[0] != family:
                    yield of(family, held)
                    held = []
                family = row[0]
                held.append(row[1:])
        if held:
            yield of(family, held)

    return scan


OUT = "n_tokens bigint, n_known bigint, base_log double, score double"


class Table:
    """Distinct keys with a value each, ordered by a hash whose first bits point at their place: some two steps a key looked up."""

    def __init__(self, keys: np.ndarray, value: np.ndarray):
        hashed = mix(keys.astype(np.uint64))
        by = np.argsort(hashed)
        self.keys, self.value = keys[by], value[by]
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        size = np.bincount((hashed >> self.shift).astype(np.int64), minlength=1 << bits)
        self.most, self.start = int(size.max()), (np.cumsum(size) - size).astype(np.int32)

    def at(self, k: np.ndarray) -> np.ndarray | None:
        """The places of k; None if some aren't there."""
        if not len(k):
            return np.zeros(0, dtype=np.int64)
        at = self.start[mix(k.astype(np.uint64)) >> self.shift].astype(np.int64)
        left = np.arange(len(k))
        for _ in range(self.most):  # keys of the same first bits stand together
            left = left[self.keys.take(at[left], mode="clip") != k[left]]
            if not len(left):
                return at
            at[left] += 1
        return None


class Values:
    """A piece's strings with their code lengths and words with their counts."""

    def __init__(self, rows: list[tuple[int, bytes, bytes]]):
        self.tables = {}
        for words in (False, True):
            mine = [r for r in rows if (r[0] >= 1 << FAMILY_BITS) == words]
            keys = np.concatenate([np.zeros(0, dtype=np.int64), *(unpacked_keys(r[1]) for r in mine)])
            value = np.concatenate([np.zeros(0, dtype="<f4"), *(unpacked(r[2], "<i8" if words else "<f4") for r in mine)])
            self.tables[words] = Table(keys, value)

    def of(self, k: np.ndarray, words: bool) -> np.ndarray:
        table = self.tables[words]
        at = table.at(k)
        if at is None:
            raise RuntimeError("a text changed its piece between two reads; its input isn't deterministic")
        return table.value[at].astype(np.float64)


def _scored(order: int):
    """Rows come sorted by (piece, is_text): a piece's values, then its texts, which are scored batch by batch."""

    def of(values: Values, ids: pa.Array, texts: list[str | None]) -> Iterator[pa.RecordBatch]:
        end = values.of(np.array([END_WORD]), True)[0]
        at = 0
        for _, block in chunks(texts):
            strings, starts = grams(block, order)
            score = np.add.reduceat(values.of(strings, False), starts)
            words, first = word_keys(block)
            count = values.of(words, True)
            logs = np.concatenate([[0.0], np.cumsum(np.log10(count + 1))])
            known = np.concatenate([[0], np.cumsum(count > 0)])
            columns = [ids.slice(at, len(block)), pa.array(np.diff(first) + 1), pa.array(known[first[1:]] - known[first[:-1]] + int(end > 0))]
            columns += [pa.array(logs[first[1:]] - logs[first[:-1]] + np.log10(end + 1)), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_known", "base_log", "score"])
            at += len(block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, held, values = None, [], None
        for b in batches:
            pieces, is_text = b.column("piece").to_numpy(), b.column("is_text").to_numpy(zero_copy_only=False).astype(bool)
            cuts = np.flatnonzero(np.concatenate([[True], (np.diff(pieces) != 0) | (is_text[1:] != is_text[:-1]), [True]])).tolist()
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                part = b.slice(x, y - x)
                if pieces[x] != piece:
                    piece, held, values = pieces[x], [], None
                if is_text[x]:
                    if values is None:
                        values, held = Values(held), []
                    yield from of(values, part.column("doc_id"), part.column("_t").to_pylist())
                else:
                    held += zip(*(part.column(c).to_pylist() for c in ("family", "keys", "value")), strict=True)

    return scan


def ppm_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_out: int = 2, order: int = ORDER, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    docs must give the same rows in the same order each time it is read, as files do.
    """
    if not 2 <= order <= 5:
        raise ValueError("order is in 2..5")
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
    learn = crc_mod(F.col("doc_id"), folds) != held_out
    counts = source.filter(learn).select("_t").mapInArrow(_low_counts, "low bigint, n bigint").groupBy("low").agg(F.sum("n").alias("n")).toPandas()
    tokens = int(counts.loc[counts["low"] < 0, "n"].sum())
    seen = counts[counts["low"] >= 0].sort_values("low")  # at most 2^24 rows
    low = spark.sparkContext.broadcast(LowOrders(seen["low"].to_numpy(np.int64), seen["n"].to_numpy(np.int64)))

    n_bytes = source.agg(F.sum(F.octet_length("_t"))).first()[0] or 0
    word_bits = min(16, 6 + (n_bytes // piece_bytes).bit_length())
    known = source.withColumn("learn", learn)
    keys = known.mapInArrow(_piece_keys(order, word_bits, piece_bytes), PACKED)
    dealt = keys.repartition("family").sortWithinPartitions("family")
    valued = written(dealt.mapInArrow(_valued(low, order), VALUED), "ppm-values")
    own = F.col("piece").bitwiseAND(F.lit((1 << PIECE_BITS) - 1))
    last, most, vocabulary = valued.agg(F.max(F.shiftright("piece", PIECE_BITS)), F.max(own), F.sum("known")).first()
    parts = (last or 0) + 1

    id_type = docs.schema[id_col].dataType.simpleString()
    texts = known.mapInArrow(_pieced(piece_bytes), f"piece bigint, doc_id {id_type}, _t string").withColumn("is_text", F.lit(True))
    both = texts.unionByName(valued.select("piece", "family", "keys", "value").withColumn("is_text", F.lit(False)), allowMissingColumns=True)
    # each piece in a partition of its own, unless a few partitions have far more pieces than the others
    tasks = min(parts * ((most or 0) + 1), max(parts, n_bytes // piece_bytes) * 4)
    task = F.pmod(F.shiftright("piece", PIECE_BITS) + own * parts, F.lit(tasks)).cast("int")
    met = both.withColumn("task", task).repartitionById(int(tasks), "task").sortWithinPartitions("piece", "is_text")
    scored = met.mapInArrow(_scored(order), f"doc_id {id_type}, {OUT}")
    vocabulary = vocabulary or 0
    base = F.col("base_log") - F.col("n_tokens") * F.lit(float(np.log10(tokens + vocabulary + 1)))
    return scored.select(
        "doc_id",
        (crc_mod(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(tokens)).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )

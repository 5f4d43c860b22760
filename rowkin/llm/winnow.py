"""Benchmark decontamination by winnowing.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the lower-cased (A-Z) texts. Of each benchmark item and each
document, the hashes of all K-word grams are taken and the smallest of every W consecutive ones is kept (the
rightmost among equals). A span of WINDOW = W + K - 1 words that item and document share has the same W hashes in
both, so the same one is kept in both: joining kept hashes finds every shared window. A document's window whose
kept hash is joined is extended to all its words and looked up among the items' windows (by a 64-bit hash of its word
hashes), so equal gram hashes alone make no hit. Each window is looked up once, however often its words are repeated in
text and item, so that work is linear in the text and in the hits. Hit windows that touch make a span. An item of fewer
words is one window, and is looked up as a whole.

Scale: the benchmark is the smaller side. It is read in blocks of at most block_words words, or one item; a block's index is
made once, as sorted arrays of 16 bytes a word, and broadcast, so a benchmark of any size works with bounded memory.
Documents are not shuffled: they are scanned in Arrow batches, and a batch's memory follows CHUNK or the longest text.
With several blocks, there is a scan for each; it writes the hits of documents that have any, by row number, to the shared
folder and its index is given back. They are united by row and joined with the documents: broadcast up to
max_broadcast rows, beyond it by shuffle. Then docs must give the same rows in the same order each time, as files do.

Nulls and odd rows: a null text has no words and no hits; an item without words has no window; repeated rows
are judged alike; items that share an id count once a distinct id; a null item id is named "null"; an empty benchmark
hits nothing; columns named like the results, in any case, are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sized_broadcast, written
from .textvec import Words, chunks, gram_hash, grams_at

WINDOW, K = 10, 5


def kept_of(grams: np.ndarray, w: int) -> np.ndarray:
    """For each w consecutive hashes the position of the smallest, the rightmost among equals."""
    size = max(0, len(grams) - w + 1)
    low, at = grams[w - 1 : w - 1 + size].copy(), np.full(size, w - 1, dtype=np.int64)
    for i in range(w - 2, -1, -1):
        here = grams[i : i + size]
        less = here < low
        low[less], at[less] = here[less], i
    return at + np.arange(size)


class Lookup:
    """Hashes and the items that have them: sorted pairs."""

    def __init__(self, hashes: list[np.ndarray], items: list[int]):
        key = np.concatenate([np.zeros(0, dtype=np.uint64), *hashes])
        item = np.repeat(np.array(items, dtype=np.int32), [len(h) for h in hashes])
        order = np.lexsort((item, key))
        key, item = key[order], item[order]
        new = np.concatenate([[True], (np.diff(key) != 0) | (np.diff(item) != 0)]) if len(key) else np.zeros(0, dtype=bool)
        self.key, self.item = key[new], item[new]

    def __contains__(self, x: int) -> bool:
        return bool(self.has(np.array([x], dtype=np.uint64))[0])

    def has(self, x: np.ndarray) -> np.ndarray:
        if not len(self.key):
            return np.zeros(len(x), dtype=bool)
        at = np.searchsorted(self.key, x)
        at[at == len(self.key)] = 0
        return self.key[at] == x

    def join(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into x, item) of all equal pairs."""
        low, high = np.searchsorted(self.key, x, side="left"), np.searchsorted(self.key, x, side="right")
        n = high - low
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        return np.repeat(np.arange(len(x)), n), self.item[at]


class Index:
    """A block of the benchmark: kept hashes, windows, and items that are shorter than a window, by length."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW, k: int = K):
        self.window, self.k = window, k
        self.ids = sorted({i for i, _ in items})
        number = {x: i for i, x in enumerate(self.ids)}
        prints: list[np.ndarray] = []
        windows: list[tuple[np.ndarray, int]] = []
        short: dict[int, list[tuple[np.ndarray, int]]] = {}
        at = 0
        for _, block in chunks([t for _, t in items]):
            w = Words(block, "alnum")
            for a, b in zip(w.first[:-1], w.first[1:], strict=True):
                item, at, n = number[items[at][0]], at + 1, int(b - a)
                if n >= window:
                    grams = gram_hash(w.hash[a:b], k)
                    prints.append(np.unique(grams[kept_of(grams, window - k + 1)]))
                    windows.append((np.unique(gram_hash(w.hash[a:b], window)), item))
                elif n:
                    short.setdefault(n, []).append((gram_hash(w.hash[a:b], n), item))
        self.prints = Lookup(prints, [0] * len(prints))
        self.windows = Lookup([h for h, _ in windows], [i for _, i in windows])
        self.short = {n: Lookup([h for h, _ in x], [i for _, i in x]) for n, x in sorted(short.items())}

    def found(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, number of words, item) of all windows of the chunk's texts that are items' windows."""
        of, count = w.text_of(), len(w)
        out = [(np.zeros(0, dtype=np.int64),) * 3]

        def inside(n: int) -> np.ndarray:
            """Where n words of one text begin."""
            return np.flatnonzero(of[: count - n + 1] == of[n - 1 :]) if count >= n else np.zeros(0, dtype=np.int64)

        if len(self.prints.key) and count >= self.window:
            grams = gram_hash(w.hash, self.k)
            # winnowing all texts at once: a window's smallest hash is the same with other texts' windows beside it
            kept, start = kept_of(grams, self.window - self.k + 1), inside(self.window)
            joined = np.zeros(len(grams), dtype=bool)
            fingerprints = np.unique(kept[start])
            joined[fingerprints] = self.prints.has(grams[fingerprints])
            start = start[joined[kept[start]]]
            at, item = self.windows.join(grams_at(w.hash, start, self.window))
            out.append((start[at], np.full(len(at), self.window), item))
        for n, lookup in self.short.items():
            start = inside(n)
            start = start[lookup.has(grams_at(w.hash, start, n))]
            at, item = lookup.join(grams_at(w.hash, start, n))
            out.append((start[at], np.full(len(at), n), item))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def hits(index: Index, texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int]], set[str]]]:
    """(number of words, spans (first word, one after the last), ids of items) of each text."""
    for _, block in chunks(texts):
        w = Words(block, "alnum")
        start, n, item = index.found(w)
        if not len(start):
            yield from ((int(b - a), [], set()) for a, b in zip(w.first[:-1], w.first[1:], strict=True))
            continue
        text = np.searchsorted(w.first, start, side="right") - 1
        by = np.argsort(text, kind="stable")
        start, n, item = start[by], n[by], item[by]
        cut = np.searchsorted(text[by], np.arange(len(block) + 1))
        for t in range(len(block)):
            a, mine = w.first[t], slice(cut[t], cut[t + 1])
            ids = {index.ids[i] for i in np.unique(item[mine])}
            yield int(w.first[t + 1] - a), united((start[mine] - a).tolist(), (start[mine] - a + n[mine]).tolist()), ids


def united(start: list[int], end: list[int]) -> list[tuple[int, int]]:
    """The stretches that intervals cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(start, end, strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _summary(n_words: int, spans: list[tuple[int, int]], ids: set[str]) -> tuple:
    sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    return n_words, sum(b - a for a, b in spans), len(ids), sha, [{"first": a, "last": b - 1} for a, b in spans]


NAMES = ["n_words", "n_hit", "n_items", "items_sha256", "spans"]
OUT = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, spans array<struct<first:int,last:int>>"


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str, str | None]]]:
    """The benchmark's items in blocks of about block_words words: read one partition after the other, never all at once."""
    held, size = [], 0
    named = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")), text_col)
    for item, text in named.toLocalIterator():
        n = len((text or "").split())
        if held and size + n > block_words:
            yield held
            held, size = [], 0
        held.append((item, text))
        size += n
    yield held


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: tuple[str, ...] | None = None,
    window: int = WINDOW,
    k: int = K,
    block_words: int = 4_000_000,
    max_broadcast: int = 100_000,
) -> DataFrame:
    """One row per row of docs: the columns `keep` (all by default), n_words, n_hit, n_items, items_sha256, spans, contaminated."""
    made = (*NAMES, "contaminated", "_row", "_text", "_spans", "_ids")
    keep = tuple(c for c in (docs.columns if keep is None else keep) if c.lower() not in made)
    context = docs.sparkSession.sparkContext
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("_text"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields if f.name != "_text")
    blocks = benchmark_blocks(benchmark, item_col, item_text_col, block_words)
    first, second = next(blocks), next(blocks, None)
    index = context.broadcast(Index(first, window, k))
    if second is None:

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = [_summary(*x) for x in hits(index.value, b["_text"].tolist())]
                yield pd.concat([b.drop(columns="_text"), pd.DataFrame(rows, columns=NAMES, index=b.index)], axis=1)

        out = source.mapInPandas(scan, fields + OUT)
    else:
        out = _in_blocks(source, index, second, blocks, fields, window, k, max_broadcast)
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def _block_hits(numbered: DataFrame, index: Broadcast) -> DataFrame:
    """_row, spans (first and end by turns) and ids of the rows that the block hits, in the shared folder."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = zip(b["_row"], hits(index.value, b["_text"].tolist()), strict=True)
            rows = [(row, [x for s in spans for x in s], sorted(ids)) for row, (_, spans, ids) in found if ids]
            yield pd.DataFrame(rows, columns=["_row", "_spans", "_ids"])

    found = numbered.select("_row", "_text").mapInPandas(scan, "_row bigint, _spans array<bigint>, _ids array<string>")
    return written(found, "winnow-hits")


def _in_blocks(source: DataFrame, index: Broadcast, second: list, blocks: Iterator[list], fields: str, window: int, k: int, max_broadcast: int) -> DataFrame:
    """As decontaminate, for a benchmark of several blocks: a pass for each, one index at a time."""
    numbered = source.withColumn("_row", F.monotonically_increasing_id())
    context, found, block = source.sparkSession.sparkContext, None, second
    while index is not None:
        mine = _block_hits(numbered, index)
        found = mine if found is None else found.unionByName(mine)
        index.destroy()
        index = None if block is None else context.broadcast(Index(block, window, k))
        block = next(blocks, None)
    both = found.groupBy("_row").agg(F.flatten(F.collect_list("_spans")).alias("_spans"), F.array_distinct(F.flatten(F.collect_list("_ids"))).alias("_ids"))
    both = written(both, "winnow-united")  # a row meets as many rows as there are blocks
    joined = numbered.join(sized_broadcast(both, max_broadcast), "_row", "left").drop("_row")

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n = [int(x) for _, block in chunks(b["_text"].tolist()) for x in np.diff(Words(block, "alnum").first)]
            ends = [[] if s is None else list(s) for s in b["_spans"]]
            ids = [set() if x is None else set(x) for x in b["_ids"]]
            rows = [_summary(c, united(s[::2], s[1::2]), x) for c, s, x in zip(n, ends, ids, strict=True)]
            yield pd.concat([b.drop(columns=["_text", "_spans", "_ids"]), pd.DataFrame(rows, columns=NAMES, index=b.index)], axis=1)

    return joined.mapInPandas(summed, fields + OUT)

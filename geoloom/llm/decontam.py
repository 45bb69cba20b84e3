"""Benchmark decontamination by an FM-index over each shard of training documents.

A shard's documents become runs of benchmark-vocabulary words. The runs are
suffix-sorted into an FM-index whose Burrows-Wheeler symbols lie in a wavelet
matrix. All benchmark windows are searched backward at once, their occurrences
are located through sampled suffix positions, and overlapping ones merge into
removal spans.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import column, per_row, remove, shared_folder, table, unused, words

WINDOW = 13
#: Of the original text: words are the same before and after lower-casing A-Z.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class WaveletMatrix:
    """Ranks and accesses of symbols 0..2**bits-1 over a fixed sequence, for arrays of positions at once."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often `symbol` occurs before `end`."""
        begin = np.zeros_like(end)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            a, b = ones[begin], ones[end]
            begin, end = np.where(bit, zeros + a, begin - a), np.where(bit, zeros + b, end - b)
        return end - begin

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at `at`, and how often each occurs before it."""
        symbol, begin, end = np.zeros_like(at), np.zeros_like(at), at
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            a, b = ones[begin], ones[end]
            bit = ones[end + 1] > b
            symbol = symbol * 2 + bit
            begin, end = np.where(bit, zeros + a, begin - a), np.where(bit, zeros + b, end - b)
        return symbol, end - begin


class Marks:
    """Which of many places are marked, a bit each, and how many are before a place."""

    def __init__(self, marked: np.ndarray):
        bits = np.packbits(np.concatenate([marked, np.zeros(-len(marked) % 64 + 64, bool)]), bitorder="little")
        self.words = bits.view(np.uint64)
        self.counts = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)])

    def has(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def before(self, at: np.ndarray) -> np.ndarray:
        low = self.words[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.counts[at >> 6] + np.bitwise_count(low)


class FMIndex:
    """Over runs of symbols from 1 on, each closed by a 0. No match reaches over a 0."""

    def __init__(self, sequence: np.ndarray, top: int, sample: int = 8):
        """top: the largest symbol. Every `sample`-th position and each run's start keeps its suffix position."""
        n = len(sequence)
        closing = sequence == 0
        closes = int(closing.sum())
        rank = np.where(closing, np.cumsum(closing) - 1, sequence.astype(np.int64) + closes - 1)
        step = 1
        while True:  # prefix doubling; closing symbols differ, so it ends at the longest repeated run
            follow = np.zeros(n, np.int64)
            follow[: n - step] = rank[step:] + 1
            key = rank * (int(rank.max(initial=0)) + 2) + follow
            suffixes = np.argsort(key, kind="stable")
            key = key[suffixes]
            new = np.empty(n, np.int64)
            new[suffixes] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            rank = new
            if n == 0 or rank[suffixes[-1]] == n - 1:
                break
            step *= 2
        last = sequence[suffixes - 1].astype(np.int64)
        self.first = np.concatenate([[0, closes], closes + np.cumsum(np.bincount(sequence[~closing], minlength=top + 1)[1:])])
        self.tree = WaveletMatrix(last, max(1, int(top).bit_length()))
        known = (suffixes % sample == 0) | (last == 0)
        self.known = Marks(known)
        self.at = suffixes[known]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the rows of `phrases` that occur: their numbers, and their intervals of suffixes."""
        row = np.arange(len(phrases))
        symbol = phrases[:, -1]
        low, high = self.first[symbol], self.first[symbol + 1]
        for k in range(phrases.shape[1] - 2, -1, -1):
            alive = low < high
            row, low, high = row[alive], low[alive], high[alive]
            symbol = phrases[row, k]
            low = self.first[symbol] + self.tree.rank(symbol, low)
            high = self.first[symbol] + self.tree.rank(symbol, high)
        alive = low < high
        return row[alive], low[alive], high[alive]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes numbered `rows`: walked back to a sampled one."""
        out = np.empty(len(rows), np.int64)
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            known = self.known.has(rows)
            out[todo[known]] = self.at[self.known.before(rows[known])] + steps
            todo, rows = todo[~known], rows[~known]
            symbol, before = self.tree.access(rows)
            rows = self.first[symbol] + before
            steps += 1
        return out


class Phrases:
    """Windows of `window` consecutive words of benchmark items; an item of fewer words, but not none, is one window."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.ids = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.ids)}
        spelled = [(number[i], words(t)) for i, t in items]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for _, ws in spelled for w in ws}), 1)}
        made: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for item, ws in spelled:
            if ws:
                size = min(window, len(ws))
                rows = np.lib.stride_tricks.sliding_window_view(np.array([self.vocabulary[w] for w in ws], np.int32), size)
                made.setdefault(size, []).append((rows, np.full(len(rows), item, np.int32)))
        #: By length: distinct windows, and for each of them its items as a slice of a flat list.
        self.by_length = {}
        for size, parts in made.items():
            rows, inverse = np.unique(np.concatenate([r for r, _ in parts]), axis=0, return_inverse=True)
            pairs = np.unique(np.stack([inverse.ravel(), np.concatenate([i for _, i in parts])]), axis=1)
            self.by_length[size] = rows.astype(np.int64), np.searchsorted(pairs[0], np.arange(len(rows) + 1)), pairs[1]
        self.shortest = min(self.by_length, default=0)


def find(texts: list[str | None], phrases: Phrases) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[str]]]:
    """Of each text of a shard: its number of words, merged hit spans of words (end exclusive), ids of items found."""
    get = phrases.vocabulary.get
    parts = [[get(w, 0) for w in words(t)] for t in texts]
    counts = np.array([len(p) for p in parts], np.int64)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[list[str]] = [[] for _ in texts]
    if not phrases.by_length:
        return counts, spans, items
    starts = np.concatenate([[0], np.cumsum(counts + 1)])  # a 0 after each text
    flat = np.zeros(int(starts[-1]), np.int32)
    for s, p in zip(starts, parts, strict=False):
        flat[s : s + len(p)] = p
    edge = np.diff(np.concatenate([[0], (flat != 0).astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    fits = end - begin >= phrases.shortest  # a shorter run can hold no window
    begin, end = begin[fits], end[fits]
    if not len(begin):
        return counts, spans, items
    size = end - begin + 1  # with its closing 0
    run_at = np.concatenate([[0], np.cumsum(size)])
    source = np.repeat(begin - run_at[:-1], size) + np.arange(run_at[-1])  # of each indexed position, its place in flat
    sequence = flat[source]
    sequence[run_at[1:] - 1] = 0
    index = FMIndex(sequence, len(phrases.vocabulary))
    cover = np.zeros(len(flat) + 1, np.int32)
    for length, (rows, at, of) in phrases.by_length.items():
        found, low, high = index.search(rows)
        if not len(found):
            continue
        n = high - low
        suffix = np.repeat(high - np.cumsum(n), n) + np.arange(n.sum())
        place = source[index.locate(suffix)]
        np.add.at(cover, place, 1)
        np.add.at(cover, place + length, -1)
        pairs = np.unique(np.stack([np.searchsorted(starts, place, "right") - 1, np.repeat(found, n)]), axis=1)
        for doc, phrase in pairs.T:
            items[doc] += [phrases.ids[i] for i in of[at[phrase] : at[phrase + 1]]]
    edge = np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8), [0]]))
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
        doc = int(np.searchsorted(starts, a, "right")) - 1
        spans[doc].append((int(a - starts[doc]), int(b - starts[doc])))
    return counts, spans, [sorted(set(i)) for i in items]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


FOUND = "struct<n_words:bigint,spans:array<struct<start:int,end:int>>,items:array<string>>"
ARROW_FOUND = pa.struct(
    [("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string()))]
)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    out: str = "found",
    window: int = WINDOW,
    block_bytes: int = 4_000_000,
    shard_bytes: int = 4_000_000,
) -> DataFrame:
    """Adds `out` to docs: n_words, spans (of words, merged, end exclusive) and items (ids as text, sorted).

    benchmark has item_id and text. Items go out in blocks of about `block_bytes`
    of text: the block count follows from the table's measured size, and each
    block is one more pass over the same rows. Between passes the rows with what was
    found lie in the shared folder, so the driver and the workers hold one block at a
    time. Documents are indexed in shards of about `shard_bytes` (a longer document
    is a shard of its own), whole and without a shuffle.

    Null texts have no words. Items without words, null item texts and null
    item ids find nothing. Several rows of one item_id are one item with all
    their windows. Repeated documents stay, each with its own result; empty
    tables give no row, or no finds. A column already named `out` is replaced.
    """
    spark = docs.sparkSession
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t"))
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    folder, result = None, docs
    for block in range(blocks):
        if block:
            before, folder = folder, f"{shared_folder(spark)}/found-{uuid.uuid4().hex}"
            result.write.parquet(folder)
            result = spark.read.parquet(folder)
            share.unpersist()
            if before:
                remove(spark, before)
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block).collect()
        share = spark.sparkContext.broadcast(Phrases([(r.i, r.t) for r in rows], window))  # of about block_bytes
        result = searched(result, share, text, out, shard_bytes, earlier=block > 0)
    return result


def searched(docs: DataFrame, share: Broadcast, text: str, out: str, shard_bytes: int, earlier: bool) -> DataFrame:
    """One pass: adds `out` for one block of phrases, or with earlier joins it to what `out` already holds."""
    if earlier:
        both = unused(docs, "both")
        docs = docs.select("*", F.struct(column(text).alias("text"), column(out).alias("found")).alias(both))
        kept = [c for c in docs.columns if c not in (both, out)]
        return per_row(docs, both, {out: FOUND}, lambda: found_in(share, shard_bytes, True)).select(*map(column, [*kept, out]))
    return per_row(docs, text, {out: FOUND}, lambda: found_in(share, shard_bytes, False))


def found_in(share: Broadcast, shard_bytes: int, earlier: bool) -> Callable[[pa.Array], list[pa.Array]]:
    phrases = share.value

    def made(column: pa.Array) -> list[pa.Array]:
        texts = (column.field("text") if earlier else column).to_pylist()
        found, at = [], 0
        while at < len(texts):
            shard, held = at, 0
            while at < len(texts) and (at == shard or held + len(texts[at] or "") <= shard_bytes):
                held += len(texts[at] or "")
                at += 1
            for n, spans, ids in zip(*find(texts[shard:at], phrases), strict=True):
                found.append((int(n), spans, ids))
        if earlier:
            for k, e in enumerate(column.field("found").to_pylist()):
                n, spans, ids = found[k]
                found[k] = n, merged([*spans, *((s["start"], s["end"]) for s in e["spans"])]), sorted({*ids, *e["items"]})
        return [pa.array([{"n_words": n, "spans": [{"start": a, "end": b} for a, b in spans], "items": ids} for n, spans, ids in found], ARROW_FOUND)]

    return made


def hits(found: str = "found") -> Column:
    """Words in any occurrence of a window."""
    return F.aggregate(column(found)["spans"], F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]).cast("long"))


def is_contaminated(found: str = "found") -> Column:
    return (hits(found) > 0) & (20 * hits(found) >= column(found)["n_words"])


def removal_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of code points (end exclusive) of the text that spans of words cover."""
    places = [m.span() for m in WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in spans]


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark window, as digests of its finds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        hits().alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def brute_force(docs: list[tuple], benchmark: list[tuple], window: int = WINDOW) -> list[tuple]:
    """The rows of op6 by plain search, for tests."""
    wanted: dict[tuple, set] = {}
    for item, text in benchmark:
        ws = words(text)
        size = min(window, len(ws))
        for k in range(len(ws) - size + 1 if ws else 0):
            wanted.setdefault(tuple(ws[k : k + size]), set()).add(str(item))
    lengths = {len(w) for w in wanted}
    out = []
    for doc, text in docs:
        ws = words(text)
        hit, found = [False] * len(ws), set()
        for size in lengths:
            for k in range(len(ws) - size + 1):
                if (i := wanted.get(tuple(ws[k : k + size]))) is not None:
                    found |= i
                    hit[k : k + size] = [True] * size
        n = sum(hit)
        out.append((doc, len(ws), n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n > 0 and 20 * n >= len(ws)))
    return out


OP6_SQL = r"""
with lowered as (
  select doc_id, row_number() over () as r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents),
items as (
  select cast(item_id as varchar) as item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from benchmark where item_id is not null and text is not null),
phrases as (
  select distinct item_id, size, array_to_string(list_slice(ws, k, k + size - 1), ' ') as phrase
  from (select item_id, ws, least(13, len(ws)) as size, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) as k from items where len(ws) > 0)),
places as (
  select r, size, k, array_to_string(list_slice(ws, k, k + size - 1), ' ') as phrase
  from (select r, ws, size, unnest(range(1, len(ws) - size + 2)) as k from lowered, (select distinct size from phrases) where len(ws) >= size)),
occurs as (select p.r, p.k, p.size, f.item_id from places p join phrases f on p.phrase = f.phrase and p.size = f.size),
hit as (select r, count(distinct w) as n from (select r, unnest(range(k, k + size)) as w from occurs) group by r),
named as (select r, count(*) as n, string_agg(item_id, ',' order by item_id) as ids from (select distinct r, item_id from occurs) group by r)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(h.n, 0) as bigint) as n_hit, cast(coalesce(m.n, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(h.n, 0) > 0 and 20 * coalesce(h.n, 0) >= len(ws) as contaminated
from lowered l left join hit h on l.r = h.r left join named m on l.r = m.r
"""

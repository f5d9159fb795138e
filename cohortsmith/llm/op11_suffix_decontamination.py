"""Benchmark decontamination by training suffix arrays.

The documents are the training text.  Every task turns its documents into words (A-Z lower-cased;
a word is a run of digits, letters and all that is not ASCII) and builds suffix arrays over them,
one per shard of at most ``SHARD`` words: word ranks are packed, sorted, and tied suffixes are
sorted again by prefix doubling until they differ or the longest test suffix is covered.  Every
suffix of every benchmark item is then searched in every shard by binary search, word after word:
the range of training suffixes that begin like it narrows until it is empty, which gives the
longest verbatim match and where it stands.  A range met at ``window`` words (or at the end of a
shorter item) is the list of all places of that window.  Words are compared as 64-bit codes;
the words of every place found are then compared byte by byte, so the result is exact.

Nothing of the documents is shuffled.  The benchmark is the stated query set: it goes to the tasks
in blocks of about ``block_words`` words, long items in overlapping pieces, so no broadcast grows
with it; blocks are searched one after the other and their hits are united per document.  A
document longer than a shard is searched in overlapping stretches.

Defined cases: a null text has no words and no hits; an item without words is never met; a null
item_id is written as the empty string, and rows with one item_id are one item; repeated rows and
null doc_ids keep their rows; an empty table of documents gives an empty result, an empty
benchmark leaves all documents clean; other input columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, whole_text
from .op5_polynomial_dedup import normalised

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHARD = 1 << 20  # places of a suffix array, document ends included
PIECE = 512
BLOCK_WORDS = 1 << 18
SLICE = 1 << 22
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15


class Words:
    """The words of some texts: codes, where they stand in the joined bytes, first word of each text."""

    def __init__(self, texts: list[bytes], seed: int = 0):
        self.data = np.frombuffer(b"\0".join(texts), np.uint8)
        table = np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64)[_LOWER]
        parts, at, n = [], 0, len(self.data)
        while at < n:
            end = min(n, at + SLICE)
            while end < n and _IS_WORD[self.data[end]]:  # not inside a word
                gap = np.flatnonzero(~_IS_WORD[self.data[end:end + SLICE]])
                end = end + int(gap[0]) if len(gap) else min(n, end + SLICE)
            parts.append(self._slice(at, end, table))
            at = end
        cat = lambda k, t: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, t)
        self.starts, self.ends, self.codes = cat(0, np.int64), cat(1, np.int64), cat(2, np.uint64)
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.first = np.searchsorted(self.starts, np.concatenate([[0], np.cumsum(lengths)]))

    def _slice(self, at: int, end: int, table: np.ndarray):
        b = self.data[at:end]
        edge = np.diff(np.concatenate([[False], _IS_WORD[b], [False]]).view(np.int8))
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        with np.errstate(over="ignore"):
            up, down = _powers(len(b))
            total = np.zeros(len(b) + 1, np.uint64)
            np.cumsum(table[b] * up, out=total[1:])
            code = (total[e] - total[s]) * down[s]
            code = (code ^ (code >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return s + at, e + at, code ^ (code >> np.uint64(32))

    def equal(self, i: np.ndarray, other: "Words", j: np.ndarray) -> np.ndarray:
        """Whether words ``i`` are the words ``j`` of ``other``, byte by byte."""
        n = self.ends[i] - self.starts[i]
        same = n == other.ends[j] - other.starts[j]
        left = np.flatnonzero(same)
        for k in range(int(n[left].max(initial=0))):
            left = left[n[left] > k]
            good = _LOWER[self.data[self.starts[i[left]] + k]] == _LOWER[other.data[other.starts[j[left]] + k]]
            same[left[~good]] = False
            left = left[good]
        return same


_POWERS: dict[int, tuple] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse modulo 2^64."""
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        steps = [np.full(size, b, np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
        for x in steps:
            x[0] = 1
        _POWERS[size] = tuple(np.cumprod(x, dtype=np.uint64) for x in steps)
    return tuple(p[:n] for p in _POWERS[size])


class SuffixArray:
    """Sorted word suffixes of some stretches of text; a suffix ends where its stretch does."""

    def __init__(self, codes: np.ndarray, stretches: list[tuple[int, int]], depth: int):
        size = sum(b - a for a, b in stretches) + len(stretches)
        self.word = np.full(size, -1, np.int64)  # word number at each place, -1 at ends
        at = 0
        for a, b in stretches:
            self.word[at:at + b - a] = np.arange(a, b)
            at += b - a + 1
        place = np.flatnonzero(self.word >= 0)
        bits = max(1, size.bit_length())
        low = (1 << bits) - 1
        # ranks of words, in the order of their codes
        c = codes[self.word[place]] >> np.uint64(bits) << np.uint64(bits) | np.arange(len(place), dtype=np.uint64)
        c = np.sort(c)
        order, top = (c & np.uint64(low)).astype(np.int64), c >> np.uint64(bits)
        new = np.concatenate([[True], top[1:] != top[:-1]])[:len(top)]
        self.vocabulary = top[new]
        self.bits = bits
        self.rank = np.zeros(size + depth + 64, np.int64)
        self.rank[place[order]] = np.cumsum(new)
        # a first sort by as many words as fit beside the place in 63 bits, then doubling of what is tied
        each = max(1, len(self.vocabulary).bit_length())
        h = max(1, (63 - bits) // each)
        h = min(h, 63)
        key = np.zeros(len(place), np.int64)
        for k in range(h):
            key = key << each | self.rank[place + k]
        key = np.sort(key << bits | place)
        self.suffix, key = key & low, key >> bits
        new = np.concatenate([[True], key[1:] != key[:-1]])[:len(key)]
        group = np.zeros(size + 1, np.int64)  # rank by the first h words; 0 where a stretch has ended
        heads = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        group[self.suffix] = heads + 1
        while h < depth:
            tied = ~(new & np.append(new[1:], True))
            idx = np.flatnonzero(tied)
            if not len(idx):
                break
            s = self.suffix[idx]
            k = np.sort(((heads[idx] + 1) << bits | group[np.minimum(s + h, size)]) << bits | s)
            s, k = k & low, k >> bits
            self.suffix[idx] = s
            new[idx] = np.concatenate([[True], k[1:] != k[:-1]])
            heads = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            group[s] = heads[idx] + 1
            h *= 2

    def ranks(self, codes: np.ndarray) -> np.ndarray:
        """The ranks of words here, 0 for words that are not."""
        top = codes >> np.uint64(self.bits)
        at = np.minimum(np.searchsorted(self.vocabulary, top), max(0, len(self.vocabulary) - 1))
        return np.where(self.vocabulary[at] == top, at + 1, 0) if len(self.vocabulary) else np.zeros(len(codes), np.int64)

    def search(self, want: np.ndarray, start: np.ndarray, end: np.ndarray, need: np.ndarray):
        """For the word sequences ``want[start:end]``: words matched, a place of that match, and the
        range of suffixes that begin with the first ``need`` words (empty where none does)."""
        n = len(start)
        lo, hi, matched = np.zeros(n, np.int64), np.full(n, len(self.suffix)), np.zeros(n, np.int64)
        low, high = np.zeros(n, np.int64), np.zeros(n, np.int64)
        act = np.arange(n)
        for d in count():
            act = act[(start[act] + d < end[act]) & (matched[act] == d)]
            if not len(act):
                break
            w = want[start[act] + d]
            a = self._bound(lo[act], hi[act], d, w)
            z = self._bound(a, hi[act], d, w + 1)
            ok = (w > 0) & (a < z)
            act = act[ok]
            lo[act], hi[act], matched[act] = a[ok], z[ok], d + 1
            full = act[need[act] == d + 1]
            low[full], high[full] = lo[full], hi[full]
        return matched, self.suffix[np.minimum(lo, max(0, len(self.suffix) - 1))] if len(self.suffix) else lo, low, high

    def _bound(self, a: np.ndarray, z: np.ndarray, d: int, w: np.ndarray) -> np.ndarray:
        """The first of suffixes a..z-1, alike in ``d`` words, whose next word is at least ``w``."""
        a, z = a.copy(), z.copy()
        while (open_ := a < z).any():
            mid = (a + z) >> 1
            less = np.zeros(len(a), bool)
            less[open_] = self.rank[self.suffix[mid[open_]] + d] < w[open_]
            a, z = np.where(open_ & less, mid + 1, a), np.where(open_ & ~less, mid, z)
        return a


class TestBlock:
    """The suffixes of some benchmark pieces, as they go to the tasks."""

    def __init__(self, rows: list[tuple[str, int, list[str]]], window: int):
        """``rows``: (item, number of its first word, words)."""
        self.items = sorted({r[0] for r in rows}, key=lambda i: i.encode())
        number = {i: k for k, i in enumerate(self.items)}
        texts = [" ".join(r[2]).encode() for r in rows]
        for self.seed in count():
            self.words = Words(texts, self.seed)
            w = sorted({x for r in rows for x in r[2]})
            if len(np.unique(Words([x.encode() for x in w], self.seed).codes)) == len(w):
                break  # different test words have different codes
        n = np.diff(self.words.first)
        self.start = np.arange(len(self.words.codes))
        self.end = np.repeat(self.words.first[1:], n)
        self.item = np.repeat(np.array([number[r[0]] for r in rows], np.int64), n)
        self.offset = np.concatenate([np.arange(k) + r[1] for k, r in zip(n, rows)]) if len(rows) else n
        head = np.isin(self.start, self.words.first[:-1])
        short = head & (self.end - self.start < window) & (self.offset == 0)
        self.need = np.where(short, self.end - self.start, window)
        self.depth = int(n.max(initial=1))
        self.vocabulary, self.sample = np.unique(self.words.codes, return_index=True)


def _shards(first: np.ndarray, depth: int, size: int = SHARD):
    """Lists of (text, first word, end): whole texts, or overlapping stretches of very long ones."""
    shard, used, step = [], 0, max(1, size // 2 - depth)
    for t in range(len(first) - 1):
        a, b = int(first[t]), int(first[t + 1])
        while a < b:
            z = min(b, a + step + depth)
            if used + z - a + 1 > size and shard:
                yield shard
                shard, used = [], 0
            shard.append((t, a, z))
            used += z - a + 1
            a = b if z == b else a + step
    if shard:
        yield shard


def search_texts(texts: list[bytes], block: TestBlock, shard_words: int = SHARD):
    """(words per text, mask of words inside windows, sorted (text, item) pairs, longest matches),
    the last one (words matched, text, word in it) per suffix of the block."""
    words = Words(texts, block.seed)
    n = len(words.codes)
    best = np.zeros((len(block.start), 3), np.int64)
    cover, pairs = np.zeros(n + 1, np.int64), [np.zeros((0, 2), np.int64)]
    for shard in _shards(words.first, block.depth, shard_words):
        sa = SuffixArray(words.codes, [(a, z) for _, a, z in shard], block.depth)
        matched, place, low, high = sa.search(sa.ranks(block.words.codes), block.start, block.end, block.need)
        more = np.flatnonzero(matched > best[:, 0])
        at = sa.word[place[more]]
        text = np.searchsorted(words.first, at, "right") - 1
        best[more] = np.stack([matched[more], text, at - words.first[text]], axis=1)
        found = np.flatnonzero(low < high)
        if not len(found):
            continue
        # windows with the same words have the same range: each range is read once
        spans, which = np.unique(np.stack([low[found], high[found], block.need[found]], axis=1), axis=0, return_inverse=True)
        times = spans[:, 1] - spans[:, 0]
        span = np.repeat(np.arange(len(spans)), times)
        k = np.arange(len(span)) - np.repeat(np.cumsum(times) - times, times) + spans[span, 0]
        at, need = sa.word[sa.suffix[k]], spans[span, 2]
        inside = np.zeros(n + 1, np.int64)
        np.add.at(inside, at, 1)
        np.add.at(inside, at + need, -1)
        seen = np.flatnonzero(np.cumsum(inside)[:n] > 0)
        same = words.equal(seen, block.words, block.sample[np.searchsorted(block.vocabulary, words.codes[seen])
                                                           .clip(max=len(block.vocabulary) - 1)])
        wrong = np.zeros(n + 1, np.int64)
        wrong[seen[~same] + 1] = 1
        wrong = np.cumsum(wrong)
        ok = wrong[at + need] == wrong[at]
        at, need, span = at[ok], need[ok], span[ok]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + need, -1)
        text = np.searchsorted(words.first, at, "right") - 1
        met = np.unique(np.stack([span, text], axis=1), axis=0)
        of_span = np.unique(np.stack([which.ravel(), block.item[found]], axis=1), axis=0)
        first, last = np.searchsorted(of_span[:, 0], met[:, 0]), np.searchsorted(of_span[:, 0], met[:, 0], "right")
        r = np.repeat(np.arange(len(met)), last - first)
        k = np.arange(len(r)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + first[r]
        pairs.append(np.unique(np.stack([met[r, 1], of_span[k, 1]], axis=1), axis=0))
    return np.diff(words.first), words.first, np.cumsum(cover)[:n] > 0, np.unique(np.concatenate(pairs), axis=0), best


_MATCH = "n_words long, hits array<struct<start:long,end:long>>, items array<string>"
_MATCH_ARROW = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                          ("items", pa.list_(pa.string()))])


def _lists(values: pa.Array, owner: np.ndarray, n: int) -> pa.Array:
    """The values as one list per owner (owners ascending)."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), values)


def _matches(texts: list[bytes], block: TestBlock) -> pa.Array:
    n_words, first, hit, pairs, _ = search_texts(texts, block)
    # runs of hit words, cut at the ends of texts
    edge = np.flatnonzero(np.concatenate([hit[:1], (hit[1:] != hit[:-1])])) if len(hit) else np.zeros(0, np.int64)
    cut = np.union1d(edge, first[(first < len(hit))]) if len(hit) else edge
    z = np.append(cut[1:], len(hit))
    run = np.flatnonzero(hit[cut]) if len(cut) else cut
    a, z = cut[run], z[run]
    text = np.searchsorted(first, a, "right") - 1
    hits = pa.StructArray.from_arrays([pa.array(a - first[text]), pa.array(z - first[text])], names=["start", "end"])
    items = pa.array(block.items, pa.string()).take(pa.array(pairs[:, 1]))
    return pa.StructArray.from_arrays([pa.array(n_words.astype(np.int64)), _lists(hits, text, len(texts)), _lists(items, pairs[:, 0], len(texts))],
                                      fields=list(_MATCH_ARROW))


def _searched(block):
    """The column function that searches one block's suffixes in the texts of each batch."""
    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in it:
            texts = texts.to_pylist()
            parts, group, size = [], [], 0
            for t in texts:
                group.append(t)
                size += len(t)
                if size >= SLICE:
                    parts.append(_matches(group, block.value))
                    group, size = [], 0
            if group:
                parts.append(_matches(group, block.value))
            yield pa.concat_arrays(parts) if parts else pa.array([], _MATCH_ARROW)
    return F.arrow_udf(run, _MATCH)


def test_pieces(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item, first, words: the benchmark's words, long items in pieces that share window - 1 words."""
    words = F.regexp_extract_all(normalised(), F.lit(WORD), F.lit(0))
    t = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("w")).filter("size(w) > 0")
    firsts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)), F.lit(PIECE - window + 1))
    return (t.select("item", "w", F.explode(firsts).alias("first"))
             .select("item", F.col("first").cast("long").alias("first"), F.slice("w", F.col("first") + 1, PIECE).alias("words")))


def test_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS):
    """The benchmark as ``TestBlock``s of about ``block_words`` words (all there is on the driver)."""
    pieces = test_pieces(benchmark, window).distinct()
    total = pieces.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_words))
    for k in range(blocks):
        rows = pieces.filter(F.pmod(F.xxhash64("item", "first"), F.lit(blocks)) == k).collect()
        yield TestBlock(sorted((r["item"], r["first"], r["words"]) for r in rows), window)


def contaminated_words(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, hits array<struct<start,end>> (runs of words inside benchmark windows),
    items array<string> (benchmark items with windows in the text, sorted) of every document."""
    spark = docs.sparkSession
    blocks = [spark.sparkContext.broadcast(b) for b in test_blocks(benchmark, window, block_words)]
    t = docs.select("doc_id", whole_text().alias("text"))
    found = [t.select("doc_id", *(["text"] if len(blocks) > 1 else []), _searched(b)(F.col("text").cast("binary")).alias("m")) for b in blocks]
    if len(found) == 1:
        return found[0].select("doc_id", "m.n_words", "m.hits", "m.items")
    key = [F.col("doc_id"), F.sha2("text", 256).alias("h")]
    every = stored(found[0].select(*key, "m.n_words"), "decontaminated")
    some = reduce(DataFrame.unionByName, [stored(f.select(*key, "m").filter(F.size("m.items") > 0).distinct(), "block-hits") for f in found])
    some = some.groupBy(F.col("doc_id").alias("_d"), F.col("h").alias("_h")).agg(
        F.array_sort(F.flatten(F.collect_list("m.hits"))).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("m.items")))).alias("items"))
    # runs of different blocks may touch
    runs = F.aggregate("hits", F.slice("hits", 1, 0), lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= x["start"]),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            F.try_element_at(acc, F.lit(-1))["start"].alias("start"), F.greatest(F.try_element_at(acc, F.lit(-1))["end"], x["end"]).alias("end"))))
    ).otherwise(F.concat(acc, F.array(x))))
    j = every.join(some.withColumn("hits", runs), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), "left")
    return j.select("doc_id", "n_words", F.coalesce("hits", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("hits"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark window occurs."""
    text = whole_text().cast("binary")
    keep = F.lit(True)
    for b in test_blocks(benchmark, window):
        keep = keep & (F.size(_searched(docs.sparkSession.sparkContext.broadcast(b))(text)["items"]) == 0)
    return docs.filter(keep)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item, first (number of the suffix's first word), words (longest verbatim match, at most to
    the end of its piece), doc_id and position (word) of one such match, for every benchmark suffix
    that is met at all.  Of matches of one length the least doc_id and position is given."""
    spark = docs.sparkSession
    found = []
    for b in test_blocks(benchmark, window):
        block = spark.sparkContext.broadcast(b)

        def run(it, block=block):
            for batch in it:
                ids, texts = batch.column(0), batch.column(1).to_pylist()
                *_, best = search_texts(texts, block.value)
                some = np.flatnonzero(best[:, 0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.value.items, pa.string()).take(pa.array(block.value.item[some])), pa.array(block.value.offset[some]),
                     pa.array(best[some, 0]), ids.take(pa.array(best[some, 1])), pa.array(best[some, 2])],
                    names=["item", "first", "words", "doc_id", "position"])

        t = docs.select(F.col("doc_id").cast("long"), whole_text().cast("binary").alias("text"))
        found.append(t.mapInArrow(run, "item string, first long, words long, doc_id long, position long"))
    best = reduce(DataFrame.unionByName, found).groupBy("item", "first").agg(
        F.min(F.struct((-F.col("words")).alias("n"), "doc_id", "position")).alias("m"))
    return best.select("item", "first", (-F.col("m.n")).alias("words"), "m.doc_id", "m.position")

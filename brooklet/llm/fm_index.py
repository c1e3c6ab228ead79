"""Removal of word passages that an earlier document holds, by compressed FM-indexes.

A window is ``WINDOW`` consecutive words of one document; the words it covers go if
the window's words also start in a document of a smaller id. The earliest copy stays.

One index of all documents can't be distributed, and asking every document of every
shard's index takes the square of the input. So both the text that a shard indexes
and the text that streams through it are dealt by content:

1. Every window has an anchor, the leftmost of its GRAM-word strings of least hash.
   Equal windows have equal anchors at equal offsets, so a window whose anchor
   string no other document holds has no copy. Partial aggregates find the strings
   that two ids hold; anchors are about one in 20 words.
2. The words that an anchor's windows cover are its segment. Segments of shared anchors
   are grouped by the words themselves, by partial aggregates, to one row with its least
   and greatest id: a passage that any share of all documents holds is a few rows.
   What stays are the distinct segments of each anchor string.
3. Distinct segments, dealt by anchor string, make the shards: a task takes whole anchor strings
   up to ``SHARD`` words, builds their FM-index (suffix order of at least WINDOW words by
   doubling, wavelet matrix of the words before them) and streams the segments through it, all
   in step: backward search extends the match by one word to the left, and cuts it to
   WINDOW - 1 words before, by the class of suffixes that share so many. These are the matching
   statistics, capped at WINDOW; the least id in the interval tells whether the
   window stands in an earlier document.
4. A segment's first document loses the windows found there; all later documents of a segment
   lose its words whole. Occurrences (ids and places, no text) are joined with the segments' results; adaptive execution may split a segment of many.

An anchor string of more than ``VARIED`` distinct segments (a common phrase in many contexts) is
cut into single windows first: each distinct window is then a segment of its own, and those
of one id go at once. Such windows are dealt by their words, so no shard holds all of the phrase's. The
same index and search serve both, and all ways give the same spans.

Null texts have no words. Documents under WINDOW words lose nothing. Long texts are taken
whole. Rows that repeat an id never match each other, whatever their texts; a null id comes
before all others. An empty table gives an empty result. Reports read doc_id and text
alone; ``deduplicated_documents`` keeps all columns, whatever their names, joins the kept words of a changed text by one space and
leaves other texts as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.llm.common import bounded_batches, byte_column, every, map_all, pieces, released, table, unused, written
from brooklet.llm.near_dups import mixed

WINDOW, GRAM = 50, 8
SHARD, VARIED = 1 << 19, 4096
_NULL_ID = -(1 << 63)
_ODD = np.uint64(0xD6E8FEB86659FD93)


class Wavelet:
    """A wavelet matrix: how often a symbol occurs before a place, in one step for each bit of the symbols.

    A level is a bit vector of 64-bit words with the count of ones before each word: 1.5 bits for a bit.
    """

    def __init__(self, symbols: np.ndarray, kinds: int) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.bits = max(1, int(kinds - 1).bit_length())
        for bit in range(self.bits - 1, -1, -1):
            ones = (symbols >> bit) & 1
            packed = np.zeros(len(ones) // 64 + 1, np.uint64)
            raw = np.packbits(ones.astype(np.uint8), bitorder="little")
            packed.view(np.uint8)[: len(raw)] = raw
            before = np.append(0, np.cumsum(np.bitwise_count(packed), dtype=np.int64))[:-1].astype(np.uint32)
            zeros = len(ones) - int(ones.sum())
            self.levels.append((packed, before, zeros))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])
        kind = np.arange(kinds)
        self._origin = self._descend(kind, np.zeros(kinds, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (packed, before, zeros) in enumerate(self.levels):
            word = at >> 6
            ones = before[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            ones = ones.astype(np.int64)
            at = np.where((symbol >> (self.bits - 1 - k)) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._descend(symbol, at) - self._origin[symbol]


class FmIndex:
    """An FM-index of some texts of symbols from 1 on, for patterns of up to ``window`` symbols.

    Suffixes are ordered by their first 2**k >= window symbols, which is all that
    such patterns see. ``owner`` has a number for each text; the least owner of a pattern's interval
    is what a search is asked for.
    """

    def __init__(self, texts: list[np.ndarray], owner: np.ndarray, window: int) -> None:
        self.window = window
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        data = np.zeros(int(sizes.sum()), np.int64)  # each text ends with 0
        starts = np.cumsum(sizes) - sizes
        for t, at in zip(texts, starts.tolist(), strict=True):
            data[at : at + len(t)] = t
        kinds = int(data.max(initial=0)) + 1
        order, ranks = _suffix_order(data, window)
        self.first = np.append(0, np.cumsum(np.bincount(data, minlength=kinds)))[:-1]
        self._wavelet = Wavelet(data[order - 1], kinds)  # the symbol before each suffix, in suffix order
        text = np.repeat(np.arange(len(texts)), sizes)
        self._owner = owner[text[order]]
        self._class, self._class_low, self._class_high = _classes(order, ranks, window - 1)
        whole, self._whole_low, _ = _classes(order, ranks, window)
        self._whole, self._least = whole, np.minimum.reduceat(self._owner, self._whole_low)

    def extended(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with one symbol more in front."""
        both = self._wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high])) + np.tile(self.first[symbol], 2)
        return both[: len(symbol)], both[len(symbol) :]

    def shortened(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the first window - 1 symbols of patterns of window symbols."""
        kind = self._class[low]
        return self._class_low[kind], self._class_high[kind]

    def least_owners(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """For each window of each text, the least owner of a text that holds it; the index holds all of them, so no search fails.

        All texts step to the left together, from their ends; the longest lead.
        """
        sizes = np.array([len(t) for t in texts], np.int64)
        by = np.argsort(-sizes, kind="stable")
        n, longest = len(texts), int(sizes.max(initial=0))
        symbols = np.zeros((longest, n), np.int64)  # row k: the k-th symbol from the end
        for column, i in enumerate(by.tolist()):
            symbols[: sizes[i], column] = texts[i][::-1]
        low, high = np.zeros(n, np.int64), np.full(n, len(self._owner), np.int64)
        out = np.zeros((longest, n), np.int64)
        for k in range(longest):
            live = int(np.searchsorted(-sizes[by], -k, side="left"))  # texts of more than k symbols
            low, high = low[:live], high[:live]
            if k >= self.window:
                low, high = self.shortened(low)
            low, high = self.extended(symbols[k, :live], low, high)
            if k >= self.window - 1:
                out[k, :live] = self._least[self._whole[low]]
        found: list[np.ndarray] = [np.empty(0, np.int64)] * n
        for column, i in enumerate(by.tolist()):
            found[i] = out[self.window - 1 : sizes[i], column][::-1]
        return found


def _suffix_order(data: np.ndarray, window: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffixes by their first 2**k >= window symbols, ranks by 1, 2, 4, .. symbols); behind the end stands the least."""
    rank = data.copy()
    ranks, width = [rank], 1
    while width < window:
        key = rank * (int(rank.max(initial=0)) + 2)
        key[:-width] += rank[width:] + 1
        _, rank = np.unique(key, return_inverse=True)
        ranks.append(rank)
        width *= 2
    return np.argsort(rank, kind="stable"), ranks


def _classes(order: np.ndarray, ranks: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each place, first place, end of each class): neighbours in suffix order that share ``length`` symbols."""
    same, at = np.ones(max(0, len(order) - 1), bool), 0
    for bit in range(len(ranks) - 1, -1, -1):
        if length >> bit & 1:
            padded = np.append(ranks[bit], np.full(at, -1))
            here = padded[order + at]
            same &= here[1:] == here[:-1]
            at += 1 << bit
    low = np.append(0, np.flatnonzero(~same) + 1)
    kind = np.append(0, np.cumsum(~same))
    return kind, low, np.append(low[1:], len(order))


# Anchors and segments.


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 1 << 17:
            self[word] = h
        return h


def anchors(words: list[bytes], hashes: dict, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, behind the last window) of each anchor of a document of at least ``window`` words.

    A window starts from first to behind last in order; its anchor is its leftmost gram of least hash.
    """
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(h) - gram + 1
    g = np.zeros(n, np.uint64)
    for k in range(gram):
        g = (g ^ h[k : k + n]) * _ODD
        g ^= g >> np.uint64(29)
    g = mixed(g)
    width = window - gram + 1
    view = np.lib.stride_tricks.sliding_window_view(g, width)
    at = np.empty(len(view), np.int64)
    for i in range(0, len(view), 1 << 14):
        at[i : i + (1 << 14)] = view[i : i + (1 << 14)].argmin(1)
    at += np.arange(len(at))
    low = np.append(0, np.flatnonzero(at[1:] != at[:-1]) + 1)
    place = at[low]
    return g[place], place, low, np.append(low[1:], len(at))


def _keyed(docs: DataFrame) -> DataFrame:
    """(id, one, two, text): id and a hash of 128 bits tell rows apart."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"), *_marks(), F.col("doc_id").cast("long").alias("doc_id"), "text")


def _marks() -> list[Column]:
    return [F.xxhash64("text").alias("one"), F.xxhash64("text", F.lit(1)).alias("two")]


def _find_anchors(keyed: DataFrame, window: int) -> DataFrame:
    """(h, id, one, two, place) of the anchors of all rows."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for rows, texts in pieces(batch, byte_column(batch, "text"), 1 << 20):
                found_h, found_place, found_row = [], [], []
                for i, text in zip(rows, texts, strict=True):
                    words = text.split()
                    if len(words) >= window:
                        h, place, _, _ = anchors(words, hashes, window)
                        found_h.append(h)
                        found_place.append(place)
                        found_row.append(np.full(len(h), i))
                if found_h:
                    at = pa.array(np.concatenate(found_row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(found_h).view(np.int64)), *(batch.column(k).take(at) for k in range(3)), pa.array(np.concatenate(found_place))], ["h", "id", "one", "two", "place"]
                    )

    return keyed.select("id", "one", "two", "text").mapInArrow(run, "h long, id long, one long, two long, place long")


def _segments(placed: DataFrame, window: int) -> DataFrame:
    """(h, id, one, two, start, whole, words) of each row's shared anchors: the windows' words, and their number less one."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            wanted = batch.column(3).to_pylist()
            for rows, texts in pieces(batch, byte_column(batch, "text"), 1 << 19):
                out, row = [], []
                for i, text in zip(rows, texts, strict=True):
                    words = text.split()
                    h, place, low, high = anchors(words, hashes, window)
                    held = np.isin(place, np.array(wanted[i]))
                    for k in np.flatnonzero(held).tolist():
                        a, b = int(low[k]), int(high[k])
                        out.append((int(h[k].view(np.int64)), a, b - a, b" ".join(words[a : b + window - 1])))
                        row.append(i)
                at = pa.array(row, pa.int64())
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)] if out else []
                if columns:
                    yield pa.RecordBatch.from_arrays([columns[0], *(batch.column(k).take(at) for k in range(3)), *columns[1:]], ["h", "id", "one", "two", "start", "windows", "words"])

    return placed.select("id", "one", "two", "places", "text").mapInArrow(run, "h long, id long, one long, two long, start long, windows int, words binary")


def _single_windows(segments: DataFrame, window: int) -> DataFrame:
    """Segments cut into their windows, each dealt by its own words."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            row, start, text = [], [], []
            for i, (at, words) in enumerate(zip(batch["start"].to_pylist(), batch["words"].to_pylist(), strict=True)):
                each = words.split(b" ")
                for k in range(len(each) - window + 1):
                    row.append(i)
                    start.append(at + k)
                    text.append(b" ".join(each[k : k + window]))
            at = pa.array(row, pa.int64())
            own = [xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int64()), *(batch[c].take(at) for c in ("id", "one", "two")), pa.array(start, pa.int64()), pa.array([1] * len(row), pa.int32()), pa.array(text, pa.binary())], batch.schema.names
            )

    return segments.mapInArrow(run, segments.schema)


def statistics(rows: list[tuple[bytes, int]], window: int) -> list[np.ndarray]:
    """For each segment (words, id): whether each of its windows also stands in a segment of a smaller id."""
    number: dict[bytes, int] = {}
    texts = [np.array([number.setdefault(w, len(number) + 1) for w in words.split(b" ")], np.int64) for words, _ in rows]
    owner = np.array([i for _, i in rows], np.int64)
    index = FmIndex(texts, owner, window)
    least = index.least_owners(texts)
    return [x < i for x, i in zip(least, owner.tolist(), strict=True)]


def _searched(distinct: DataFrame, window: int, shard: int) -> DataFrame:
    """(h, one_of, two_of, first, lows, highs): the runs of windows that each segment's first document loses."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answered(rows: list[tuple]) -> pa.RecordBatch:
            columns = []
            for (h, words, first, last), lost in zip(rows, statistics([(r[1], r[2]) for r in rows], window), strict=True):
                edge = np.flatnonzero(np.diff(np.concatenate([[0], lost.astype(np.int8), [0]])))
                if len(edge) or last > first:
                    digest = xxhash.xxh3_128_digest(words)
                    columns.append((h, digest, first, edge[::2].tolist(), (edge[1::2] + window - 1).tolist()))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array([c[k] for c in columns], t) for k, t in enumerate(kinds)], ["h", "digest", "first", "lows", "highs"])

        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if size >= shard and row[0] != last:  # whole anchor strings only
                    yield answered(held)
                    held, size = [], 0
                held.append(row)
                last, size = row[0], size + row[1].count(b" ") + 1
        if held:
            yield answered(held)

    dealt = distinct.select("h", "words", "first", "last").repartition("h").sortWithinPartitions("h", "first", "words")
    return dealt.mapInArrow(run, "h long, digest binary, first long, lows array<int>, highs array<int>")


def _digested(segments: DataFrame) -> DataFrame:
    """The occurrences: segments with a digest of 128 bits in place of their words."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest = pa.array([xxhash.xxh3_128_digest(w) for w in batch["words"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("h", "id", "one", "two", "start", "windows")), digest], ["h", "id", "one", "two", "start", "windows", "digest"])

    return segments.mapInArrow(run, "h long, id long, one long, two long, start long, windows int, digest binary")


def _matched(segments: DataFrame, distinct: DataFrame, window: int, shard: int) -> DataFrame:
    """(id, one, two, low, high): spans of words to remove."""
    found = written(_searched(distinct, window, shard), "statistics")
    met = _digested(segments).join(found, ["h", "digest"])
    whole = met.where(F.col("id") > F.col("first")).select("id", "one", "two", F.col("start").alias("low"), (F.col("start") + F.col("windows") + window - 1).alias("high"))
    runs = met.where((F.col("id") == F.col("first")) & (F.size("lows") > 0)).select("id", "one", "two", "start", F.explode(F.arrays_zip("lows", "highs")).alias("x"))
    return whole.union(runs.select("id", "one", "two", (F.col("start") + F.col("x.lows")).alias("low"), (F.col("start") + F.col("x.highs")).alias("high")))


def repeated_spans(docs: DataFrame, window: int = WINDOW, shard: int = SHARD, varied: int = VARIED) -> DataFrame:
    """(id, one, two, lows, highs): the spans of words, unmerged, that each row loses."""
    if window < GRAM:
        raise ValueError(f"a window has {GRAM} words at least")
    keyed = _keyed(docs)
    placed = written(_find_anchors(keyed, window), "anchors")
    shared = placed.groupBy("h").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("h")
    rows = placed.join(written(shared, "shared"), "h").groupBy("id", "one", "two").agg(F.collect_list("place").alias("places"))
    segments = written(_segments(keyed.join(rows, ["id", "one", "two"]), window), "segments")
    grouped = lambda df: df.groupBy("h", "words").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    distinct = written(grouped(segments), "distinct")
    hot = written(distinct.groupBy("h").count().where(F.col("count") > varied).select("h"), "varied")
    spans = None
    if not hot.isEmpty():
        single = written(_single_windows(segments.join(hot, "h", "left_semi"), window), "windows")
        spans = _matched(single, grouped(single).where("first < last"), window, shard)
        segments, distinct = segments.join(hot, "h", "left_anti"), distinct.join(hot, "h", "left_anti")
    found = _matched(segments, distinct, window, shard)
    found = found if spans is None else found.union(spans)
    return found.groupBy("id", "one", "two").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))


def kept_words(words: list[bytes], lows: list[int] | None, highs: list[int] | None) -> list[bytes]:
    """The words outside all spans."""
    if not lows:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.array(lows), 1)
    np.add.at(edge, np.array(highs), -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]


def removal_report(docs: DataFrame, window: int = WINDOW, **bounds: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    joined = _keyed(docs).join(repeated_spans(docs, window, **bounds), ["id", "one", "two"], "left").select("doc_id", "text", "lows", "highs")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, lows, highs in zip(byte_column(batch, "text"), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words = text.split()
                kept = kept_words(words, lows, highs)
                out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string())))], ["doc_id", "n_words", "n_removed", "kept_sha256"]
            )

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def deduplicated_documents(docs: DataFrame, window: int = WINDOW, **bounds: int) -> DataFrame:
    """``docs`` with repeated passages cut from their texts; n_chars follows where there is one."""
    owner, one, two, lows, highs = unused(docs.columns, "owner", "one", "two", "lows", "highs")
    spans = repeated_spans(docs, window, **bounds).toDF(owner, one, two, lows, highs)
    first, second = _marks()
    own = (F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)) == F.col(owner)) & (F.xxhash64("text") == F.col(one)) & (F.xxhash64("text", F.lit(1)) == F.col(two))
    joined = docs.join(spans, own, "left").select(*every(docs), lows, highs)
    names, schema = docs.columns, docs.schema

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = names.index("text")
            low, high = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()
            texts = batch.column(at).to_pylist()
            done = [b" ".join(kept_words(t.encode().split(), x, y)).decode() if x else t for t, x, y in zip(texts, low, high, strict=True)]
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(done, columns[at].type)
            if "n_chars" in names:
                k = names.index("n_chars")
                columns[k] = pa.array([len(d) if x else c for d, x, c in zip(done, low, columns[k].to_pylist(), strict=True)], columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_all(joined, run, schema)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return removal_report(table(spark, sf_dir, "documents"))


QUERIES = {"op13_substring_dedup": op13_substring_dedup}
ORACLES = {
    "op13_substring_dedup": r"""WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, k, array_to_string(words[k : k + 49], ' ') AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS k FROM split)
), earlier AS (
  SELECT doc_id, k FROM windows JOIN (SELECT w, min(doc_id) AS first FROM windows GROUP BY w) USING (w) WHERE first < doc_id
), lost AS (SELECT DISTINCT doc_id, unnest(range(k, k + 50)) AS spot FROM earlier),
gone AS (SELECT doc_id, list(spot) AS spots, count(*) AS n FROM lost GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(array_to_string(CASE WHEN spots IS NULL THEN words ELSE list_filter(words, lambda x, i: NOT list_contains(spots, i)) END, ' ')) AS kept_sha256
FROM split LEFT JOIN gone USING (doc_id)"""
}

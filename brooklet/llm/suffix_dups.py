"""Removal of repeated byte strings, by longest previous factors over suffix orders.

A byte goes if a string of ``LENGTH`` bytes over it also starts elsewhere (in the
same document or another). The longest previous factor of a place is the longest
string there that also starts at an earlier place. In suffix order the earlier
place that shares most with it is the previous or the next one of smaller place;
the factor's length is the least common prefix on the way. Mirrored (greater
places) this gives the longest later factor. A place whose factor reaches LENGTH
starts a repeated string: ``keep="first"`` removes those with an earlier match,
so that the first copy stays, ``keep="none"`` those with any match.

One suffix array of all documents can't be distributed, and only factors of
LENGTH bytes matter, so suffixes are ordered by their first LENGTH bytes, group by
group of suffixes that can match at all:

1. Every window of LENGTH bytes has an anchor, the least hash of its GRAM-byte
   strings. Equal windows have equal anchors at equal offsets, so a window whose
   anchor's string occurs once has no match. Anchors are about one in 60 bytes.
2. An anchor's context is all that its windows can cover. Anchors that share the
   whole context (equal in two independent 64-bit hashes) are matches of each
   other in every window; partial aggregates find each run's first place, and a
   join, which may split a hot run, brings it back (level 1).
3. One anchor per differing context of a shared anchor string goes on with its
   context's bytes, dealt by anchor string (level 2). The task sorts the suffixes
   that start at the anchors and induces from them, byte by byte to the left, the
   order of the suffixes that start 1, 2, .. bytes before (``suffix_orders``);
   common prefixes come from the bytes, factors from ``previous_factors``.
4. An anchor string with more than ``GROUP`` differing contexts is dealt again, in
   ``PARTS`` ranges of the windows' offsets: the windows of a range agree in all
   bytes that each of them covers, and these bytes are the key. Such a key of more
   than GROUP contexts is a string of at least 183 bytes that occurs that often;
   its few windows go out as rows of 128-bit digests, and partial aggregates find
   each run's first place. All ways give the same spans.

Texts and hashes never pass the driver.

Null texts count as empty; nothing is removed from texts under LENGTH bytes. Very
long texts are read whole, one at a time. An empty table gives an empty result.
Rows that repeat a doc_id with another text are documents of their own (told apart
by 128 bits of hashes); rows that
repeat id and text match each other under ``keep="none"`` and are one
document under ``keep="first"``, each of them cut alike. A null doc_id is an id of its own, before all
others. Ties: of equal strings the one of the smallest (doc_id, text hash,
position) is the first. Reports read doc_id and text alone; ``deduplicated_documents``
keeps all columns, whatever their names.
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

LENGTH = 200
GRAM = 64
GROUP, PARTS = 32_768, 8
_CHUNK = 8192
_NULL_ID = -(1 << 63)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _joined(h: np.ndarray, step: int) -> np.ndarray:
    """Hashes of strings of 2 * step bytes from those of step bytes."""
    x = h[: max(0, len(h) - step)] * _ODD
    x += h[step:]
    x ^= x >> np.uint64(29)
    return x


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """The hash of the ``gram`` bytes (a power of two) that start at each place."""
    h, step = _BYTES[data], 1
    while step < gram:
        h, step = _joined(h, step), 2 * step
    return h


def _sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The minimum (or maximum) of x[i : i + width], for each i with a whole window."""
    op = np.minimum if least else np.maximum
    n = len(x) - width + 1
    if n <= 0:
        return np.empty(0, x.dtype)
    padded = np.full(-(-len(x) // width) * width, _TOP if least else np.uint64(0), x.dtype)
    padded[: len(x)] = x
    grid = padded.reshape(-1, width)
    ahead = op.accumulate(grid, axis=1).reshape(-1)
    back = op.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return op(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, anchor hash, context hash) of all anchors of some texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64))
    blob = b"".join(texts)
    data = np.frombuffer(blob, np.uint8)
    if len(data) < length:
        return none
    order = mixed(gram_hashes(data, gram))
    width = length - gram + 1
    valid = np.zeros(len(data), np.int32)  # of window starts: +1 at a text's first, -1 behind its last
    long = sizes >= length
    if not long.any():
        return none
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, ends[long] - length + 1, -1)
    whole = np.cumsum(valid)[: len(data) - length + 1] > 0
    least = np.where(whole, _sliding(order, width, True), np.uint64(0))
    held = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero((_sliding(held, width, False) == order) & (order != 0))
    owner = np.searchsorted(ends, at, side="right")
    first, end = starts[owner], ends[owner]
    left = np.maximum(at - (length - gram), first)
    right = np.minimum(at + length, end)
    spans = zip(left.tolist(), right.tolist(), (at - left).tolist(), strict=True)
    context = np.fromiter((xxhash.xxh3_64_intdigest(blob[x:y], k) for x, y, k in spans), np.uint64, len(at))
    return owner, at - first, order[at], context


def _block_minima(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Minima of x[i : i + 2**k] for each k with 2**k <= ``most``; blocks past the end are cut short."""
    out = [x]
    while 2 << (len(out) - 1) <= most:
        half, low = 1 << (len(out) - 1), out[-1].copy()
        np.minimum(low[:-half], low[half:], out=low[:-half])
        out.append(low)
    return out


def _factors_before(place: np.ndarray, common: np.ndarray, reach: int) -> np.ndarray:
    """The common prefix of each suffix with its previous smaller one in suffix order, 0 where there is none in reach."""
    n = len(place)
    smaller, shared = _block_minima(place, reach), _block_minima(np.append(common, 0), reach)
    at, low = np.arange(n), np.full(n, LENGTH, np.int64)  # all places in at..i are at least place[i]
    for k in range(len(smaller) - 1, -1, -1):
        to = at - (1 << k)
        skips = to >= 0
        skips &= smaller[k][to] > place  # a negative index is masked
        low = np.where(skips, np.minimum(low, shared[k][to]), low)
        at = np.where(skips, to, at)
    found = at > 0
    return np.where(found, np.minimum(low, np.append(common, 0)[at - 1]), 0)


def previous_factors(place: np.ndarray, common: np.ndarray, reach: int | None = None) -> np.ndarray:
    """The longest previous factor (up to LENGTH) of each suffix.

    ``place`` holds the suffixes' places in suffix order, ``common`` the common
    prefixes of neighbours. The previous and the next smaller place share most
    with a suffix among all earlier places. They are found by descending over
    block minima, so a run of n neighbours takes log n steps for all at once;
    ``reach`` bounds the neighbours that share LENGTH bytes.
    """
    if len(place) < 2:
        return np.zeros(len(place), np.int64)
    reach = reach or len(place)
    before = _factors_before(place, common, reach)
    after = _factors_before(place[::-1], common[::-1], reach)[::-1]
    return np.maximum(before, after)


class _RangeMinima:
    """Minima over any ranges of an array, by two overlapping blocks."""

    def __init__(self, x: np.ndarray) -> None:
        self.blocks = np.stack(_block_minima(x, max(1, len(x))))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The minima of x[low : high], each range nonempty."""
        k = np.frexp((high - low).astype(float))[1] - 1
        return np.minimum(self.blocks[k, low], self.blocks[k, high - (1 << k)])


def _matrix(data: np.ndarray, at: np.ndarray, size: np.ndarray, width: int, step: int) -> np.ndarray:
    """Row i: the ``size[i]`` bytes at ``at[i]``, ``at[i] + step``, .., then zeros."""
    out = np.zeros((len(at), width), np.uint8)
    for k in range(width):
        rows = np.flatnonzero(size > k)
        out[rows, k] = data[at[rows] + step * k]
    return out


def suffix_orders(contexts: list[bytes], left: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(offset, context numbers, common prefixes of neighbours) of the suffixes that start ``offset`` bytes before the anchors.

    Only suffixes of at least LENGTH bytes that share the bytes before the anchor
    with another are listed, in the order of their first LENGTH bytes; a common
    prefix is exact if it reaches LENGTH (the most that is told), else it is less.
    """
    n, sizes = len(contexts), np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    anchor = np.cumsum(sizes) - sizes + left
    tail = [c[x : x + LENGTH] for c, x in zip(contexts, left.tolist(), strict=True)]
    order = np.array(sorted(range(n), key=tail.__getitem__), np.int64)
    del tail
    behind = np.minimum(sizes - left, LENGTH)[order]
    after = _matrix(data, anchor[order], behind, LENGTH, 1)
    common = np.zeros(max(1, n - 1), np.int16)
    for i in range(0, n - 1, _CHUNK):
        j = min(n - 1, i + _CHUNK)
        differ = after[i:j] != after[i + 1 : j + 1]
        common[i:j] = np.where(differ.any(1), differ.argmax(1), LENGTH)
    del after
    minima = _RangeMinima(common)
    ahead = left[order]
    before = _matrix(data, anchor[order] - 1, ahead, LENGTH - GRAM, -1)
    live, kind = np.arange(n), np.zeros(n, np.int64)  # suffixes of one kind share all bytes before the anchor
    for offset in range(LENGTH - GRAM + 1):
        if offset:
            far = ahead[live] >= offset
            live, kind = live[far], kind[far]
            if len(live) < 2:
                return
            byte = before[live, offset - 1]
            by = np.argsort(byte, kind="stable")  # the order one byte to the left, induced from the last one
            live, kind, byte = live[by], kind[by], byte[by]
            new = (byte[1:] != byte[:-1]) | (kind[1:] != kind[:-1])
            kind = np.cumsum(np.append(0, new))
            paired = ~(np.append(True, new) & np.append(new, True))
            live, kind = live[paired], kind[paired]
        if len(live) < 2:
            return
        need = LENGTH - offset
        whole = behind[live] >= need
        here, same = live[whole], kind[whole]
        if len(here) < 2:
            continue
        shares = np.zeros(len(here) - 1, np.int64)
        alike = np.flatnonzero(same[1:] == same[:-1])
        shares[alike] = offset + np.minimum(minima(here[alike], here[alike + 1]), need)
        yield offset, order[here], shares


def matched_starts(contexts: list[bytes], left: np.ndarray, keep: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context number, least, greatest start) of the windows with a match; contexts come in order of place.

    All windows of a context hold its anchor, so their union is one span.
    """
    n = len(contexts)
    least, most = np.zeros(n, np.int64), np.full(n, -1)
    for offset, owner, shares in suffix_orders(contexts, left):
        full = np.append(shares >= LENGTH, False)
        able = full | np.append(False, full[:-1])  # next to neither of these no factor reaches LENGTH
        if not able.any():
            continue
        at = np.flatnonzero(able)
        place, common = owner[at], np.where(full[at[:-1]] & (np.diff(at) == 1), LENGTH, 0)
        ends = np.flatnonzero(np.append(common < LENGTH, True))
        reach = int(np.diff(np.append(-1, ends)).max())
        factor = previous_factors(place, common, reach)
        if keep == "none":
            factor = np.maximum(factor, previous_factors(-place, common, reach))
        rows = place[factor >= LENGTH]
        least[rows] = left[rows] - offset
        most[rows] = np.maximum(most[rows], left[rows] - offset)
    rows = np.flatnonzero(most >= 0)
    return rows, least[rows], most[rows]


def part_bounds(part: int, parts: int = PARTS) -> tuple[int, int]:
    """The first offset of a part and the first behind it."""
    offsets = LENGTH - GRAM + 1
    return part * offsets // parts, (part + 1) * offsets // parts


def merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs of some half-open spans; spans that touch are one run."""
    if not len(low):
        return low, high
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    new = np.concatenate([[True], low[1:] > reach[:-1]])
    return low[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(low) - 1]])]


#: What tells rows apart: the id, and a hash of 128 bits of the text.
_ROW = ["id", "one", "two"]
#: What tells places apart, and orders them.
_PLACE = [*_ROW, "pos"]
_TYPES = "id long, one long, two long"


def _hashed() -> list[Column]:
    return [F.xxhash64("text"), F.xxhash64("text", F.lit(1))]


def _keyed(docs: DataFrame) -> DataFrame:
    """(id, one, two, doc_id, text)."""
    one, two = _hashed()
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"), one.alias("one"), two.alias("two"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def _find_anchors(keyed: DataFrame) -> DataFrame:
    """(id, one, two, pos, h, c) of every anchor."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in pieces(batch, byte_column(batch, "text"), 1 << 18):
                owner, at, h, context = anchors(texts)
                if len(at):
                    row = pa.array(np.array(rows, np.int64)[owner])
                    yield pa.RecordBatch.from_arrays([*(batch.column(k).take(row) for k in range(3)), pa.array(at), pa.array(h.view(np.int64)), pa.array(context.view(np.int64))], [*_PLACE, "h", "c"])

    return keyed.select(*_ROW, "text").mapInArrow(run, f"{_TYPES}, pos long, h long, c long")


def _contexts(placed: DataFrame) -> DataFrame:
    """(h, id, one, two, pos, left, bytes) of each row's places [(h, pos)]; left is how far the bytes start before the anchor."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(4).to_pylist()
            for i, text in enumerate(byte_column(batch, "text")):
                at = [x["pos"] for x in places[i]]
                low = [max(0, q - (LENGTH - GRAM)) for q in at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x["h"] for x in places[i]], pa.int64()),
                        *(batch.column(k).take(pa.array([i] * len(at), pa.int64())) for k in range(3)),
                        pa.array(at, pa.int64()),
                        pa.array([q - x for q, x in zip(at, low, strict=True)], pa.int32()),
                        pa.array([text[x : q + LENGTH] for q, x in zip(at, low, strict=True)], pa.binary()),
                    ],
                    _CONTEXT,
                )

    return placed.select(*_ROW, "text", "places").mapInArrow(run, f"h long, {_TYPES}, pos long, left int, bytes binary")


def _match_groups(contexts: DataFrame, keep: str) -> DataFrame:
    """(id, one, two, low, high): the span of each context's matched windows, group by group of one key h.

    Rows that repeat a place (of rows that repeat id and text) are one under ``keep="first"``.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def matched(rows: pa.Table) -> pa.RecordBatch:
            if keep == "first":
                key = np.stack([rows[c].to_numpy() for c in ("h", *_PLACE)])
                rows = rows.take(pa.array(np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(0)))))
            left = rows["left"].to_numpy().astype(np.int64)
            owner, low, high = matched_starts(rows["bytes"].to_pylist(), left, keep)
            at = rows["pos"].to_numpy()[owner] - left[owner]
            return pa.RecordBatch.from_arrays([*(rows[c].combine_chunks().take(pa.array(owner)) for c in _ROW), pa.array(at + low), pa.array(at + high + LENGTH)], [*_ROW, "low", "high"])

        for batch in (part for b in batches for part in (b.slice(i, _CHUNK) for i in range(0, b.num_rows, _CHUNK))):
            last = batch["h"][-1].as_py()
            if held and held[-1]["h"][-1].as_py() == last:  # one group throughout
                if batch["h"][0].as_py() == last:
                    held.append(batch)
                    continue
            rows = pa.Table.from_batches([*held, batch])
            cut_ = int(np.searchsorted(rows["h"].to_numpy(), last))  # the last group may go on
            held = rows.slice(cut_).to_batches()
            if cut_:
                yield matched(rows.slice(0, cut_))
        if held:
            yield matched(pa.Table.from_batches(held))

    dealt = contexts.select(*_CONTEXT).repartition("h").sortWithinPartitions("h", *_PLACE)
    return dealt.mapInArrow(run, f"{_TYPES}, low long, high long")


_CONTEXT = ["h", *_PLACE, "left", "bytes"]


def _part(context: bytes, left: int, part: int) -> tuple[int, bytes] | None:
    """(bytes before the anchor, bytes) of the windows of one part, None if the context has none."""
    low, end = part_bounds(part)
    first = max(0, left - (end - 1))
    out = context[first : left + LENGTH - low]
    return (left - first, out) if left >= low and len(out) >= LENGTH else None


def _part_keys(contexts: DataFrame) -> DataFrame:
    """(key, part, id, one, two, pos) of each part of each context; the key is a hash of the bytes that all windows of the part cover."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, parts = [], [], []
            for i, (left, context) in enumerate(zip(batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True)):
                for part in range(PARTS):
                    if _part(context, left, part):
                        low, end = part_bounds(part)
                        rows.append(i)
                        parts.append(part)
                        keys.append(xxhash.xxh3_64_intdigest(context[left - low : left + LENGTH - end + 1], part) - (1 << 63))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(parts, pa.int32()), *(batch.column(k).take(at) for k in range(1, 5))], ["key", "part", *_PLACE])

    return contexts.select(*_CONTEXT).mapInArrow(run, f"key long, part int, {_TYPES}, pos long")


def _match_hot(contexts: DataFrame, keep: str, group: int) -> DataFrame:
    """The spans of groups too large for a task, dealt again by part and the bytes that the part's windows share."""

    @released
    def clip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_part(c, x, p) for c, x, p in zip(batch.column(6).to_pylist(), batch.column(5).to_pylist(), batch.column(7).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.binary()), batch.column(8)], [*_CONTEXT, "n"]
            )

    contexts = written(contexts.dropDuplicates(["h", *_PLACE]) if keep == "first" else contexts, "contexts")
    keys = written(_part_keys(contexts), "parts")
    shared = written(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-parts")
    rows = contexts.drop("h").join(keys.join(shared, "key"), _PLACE).select(F.col("key").alias("h"), *_CONTEXT[1:], "part", "n")
    parts = written(rows.mapInArrow(clip, f"h long, {_TYPES}, pos long, left int, bytes binary, n long"), "clipped")
    return _match_groups(parts.where(F.col("n") <= group), keep).union(_match_windows(parts.where(F.col("n") > group), keep))


def _match_windows(contexts: DataFrame, keep: str) -> DataFrame:
    """The spans of strings that occur more often than a task should hold: windows as rows, runs by partial aggregates."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, prints = [], [], []
            for i, (place, left, context) in enumerate(zip(*(batch.column(k).to_pylist() for k in (4, 5, 6)), strict=True)):
                for start in range(max(0, left - (LENGTH - GRAM)), min(left, len(context) - LENGTH) + 1):
                    rows.append(i)
                    places.append(place - left + start)
                    prints.append(xxhash.xxh3_128_digest(context[start : start + LENGTH], left - start))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in (1, 2, 3)), pa.array(places, pa.int64()), pa.array(prints, pa.binary())], [*_PLACE, "w"])

    windows = written(contexts.select(*_CONTEXT).mapInArrow(run, f"{_TYPES}, pos long, w binary"), "windows")
    place = F.struct(*_PLACE)
    runs = windows.groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    found = windows.join(runs, "w")
    found = found.where(place != F.col("first")) if keep == "first" else found
    return found.select(*_ROW, F.col("pos").alias("low"), (F.col("pos") + LENGTH).alias("high"))


def repeated_spans(docs: DataFrame, keep: str = "first", group: int = GROUP) -> DataFrame:
    """(id, one, two, lows, highs): the unmerged spans to remove of every row that has any."""
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    keyed, place = _keyed(docs), F.struct(*_PLACE)
    every = _find_anchors(keyed)
    shared = (
        every.groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low"), F.max("c").alias("high"))
        .where("n > 1")
        .select("h", (F.col("low") != F.col("high")).alias("varied"))
    )
    again = written(every.join(written(shared, "shared"), "h"), "shared-anchors")

    # Level 1: runs of one whole context.
    runs = again.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"), F.first("varied").alias("varied"))
    runs = written(runs.where("varied OR n > 1"), "runs")
    whole = again.join(runs.where("n > 1").select("h", "c", "first"), ["h", "c"])
    whole = whole.where(place != F.col("first")) if keep == "first" else whole
    spans = whole.select(*_ROW, (F.col("pos") - (LENGTH - GRAM)).alias("low"), (F.col("pos") + LENGTH).alias("high"))

    # Level 2: windows of the first anchor of each context, where contexts differ.
    firsts = runs.where("varied").select("h", "first.*")
    large = firsts.groupBy("h").count().where(F.col("count") > group).select("h")

    def contexts(of: DataFrame) -> DataFrame:
        per = of.groupBy(*_ROW).agg(F.collect_list(F.struct("h", "pos")).alias("places"))
        return _contexts(keyed.join(per, _ROW))

    large = written(large, "large")
    if not large.isEmpty():
        spans = spans.union(_match_hot(contexts(firsts.join(large, "h", "left_semi")), keep, group))
        firsts = firsts.join(large, "h", "left_anti")
    spans = spans.union(_match_groups(contexts(firsts), keep))
    return spans.groupBy(*_ROW).agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))


def cut(text: bytes, lows: list[int] | None, highs: list[int] | None) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, maximal runs removed)."""
    if not lows:
        return text, 0, 0
    low, high = merged(np.maximum(np.array(lows, np.int64), 0), np.minimum(np.array(highs, np.int64), len(text)))
    edges = [0, *(int(x) for pair in zip(low, high, strict=True) for x in pair), len(text)]
    return b"".join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)), int((high - low).sum()), len(low)


def removal_report(docs: DataFrame, keep: str = "none") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    joined = _keyed(docs).join(repeated_spans(docs, keep), _ROW, "left").select("doc_id", "text", "lows", "highs")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_column(batch, "text")
            done = [cut(*x) for x in zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([d[1] for d in done], pa.int64()),
                    pa.array([d[2] for d in done], pa.int64()),
                    pa.array([hashlib.sha256(d[0]).hexdigest() for d in done], pa.string()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def deduplicated_documents(docs: DataFrame, keep: str = "first") -> DataFrame:
    """``docs`` with repeated strings cut from their texts; n_chars follows where there is one.

    Columns stay as they are. A cut through a character drops its remaining bytes.
    """
    owner, one, two, lows, highs = unused(docs.columns, "owner", "one", "two", "lows", "highs")
    spans, hashed = repeated_spans(docs, keep).toDF(owner, one, two, lows, highs), _hashed()
    own = (F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)) == F.col(owner)) & (hashed[0] == F.col(one)) & (hashed[1] == F.col(two))
    joined = docs.join(spans, own, "left").select(*every(docs), lows, highs)
    names, schema = docs.columns, docs.schema

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = names.index("text")
            null = batch.column(at).is_null().to_pylist()
            done = [cut(*x)[0].decode("utf-8", "ignore") for x in zip(byte_column(batch, f"c{at}"), batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist(), strict=True)]
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array([None if z else d for z, d in zip(null, done, strict=True)], columns[at].type)
            if "n_chars" in names:
                k = names.index("n_chars")
                columns[k] = pa.array([None if z and c is None else len(d) for z, d, c in zip(null, done, columns[k].to_pylist(), strict=True)], columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_all(joined, run, schema)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return removal_report(table(spark, sf_dir, "documents"), keep="none")


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
ORACLES: dict[str, str] = {}

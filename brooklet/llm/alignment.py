"""Alignment of two tokenizers over the same bytes, by byte-owner arrays.

A text (a space before it) is encoded by A, a byte-level BPE, and by B, a
sentencepiece model that adds the space itself. Every byte has an owner in each:
``np.repeat`` of token numbers over token lengths. Runs of one pair of owners are
the overlaps, so each is a link of an A token with a B token; where both owners
change at once, both tokenizers end a token, and the text is cut into groups.

Neither encoder joins the two sides of one space between visible characters (B's
pieces are checked for it: none goes on behind a space), so both end a token
there, and alignments of words can be remembered: new words of a block are encoded
and aligned together, once.

A link's count is the number of documents that hold its pair of ids linked. Links
meet counts without a row per link: texts are taken in blocks of ``BLOCK`` bytes
(a longer text alone), a block brings each of its pairs once, with the number of
its documents, partial aggregates sum these, and a join takes the counts of a
block's pairs back to the block. A pair in every document costs a row per block,
and adaptive execution may split it. The rows of one A id are at most B's
vocabulary. Neither ids nor counts pass the driver; the two vocabulary files (some
3 MB) travel with the tasks.

Null and empty texts, and texts that a tokenizer doesn't give back byte for byte,
have no tokens: zeros and no groups. Long texts are taken whole. Rows that repeat
an id, or an id and a text, are documents of their own, and each counts. Special
tokens' strings are plain text. An empty table gives an empty result; only doc_id
and text are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, fields
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brooklet.llm.common import bounded_batches, released, table, written

BLOCK = 4 << 20
#: Bytes of blocks that a task holds while it writes or reads them: a block of BLOCK is some 7 MB.
GROUP = 8 << 20
#: Words whose alignment a task remembers, and the longest of them, in characters.
WORDS, WORD_CHARS = 1 << 18, 64
#: About how many characters are encoded at once.
CHUNK = 1 << 16
#: Places where neither encoder joins what stands before and behind: one space between visible characters.
#: How byte-level vocabularies of this kind split texts (a fixed value of the format).
WORDS_OF_A = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_APART = re.compile(r"(?<=\S)(?= \S)")
_REGULAR = re.compile(r"[^\s\u2581](?:[^ \u2581]*[^\s\u2581])?")


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: visible ones for themselves, the others from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {**{chr(b): b for b in visible}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


@dataclass(frozen=True)
class Alignment:
    """Ids of A and B, the owners and first byte of each link (owners are token numbers), the bytes where both end a token (but the last), and each token's group."""

    a: np.ndarray
    b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    starts: np.ndarray
    cuts: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray

    def pairs(self) -> np.ndarray:
        """The pair of ids of each link, A's in the upper half."""
        return (self.a[self.link_a].astype(np.int64) << 32) | self.b[self.link_b]


@dataclass(frozen=True)
class Facts:
    """What a report needs of an aligned text: counts, the groups as text, and the links' pairs of ids."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: str
    pairs: np.ndarray


def owners(lengths: np.ndarray) -> np.ndarray:
    """The token that owns each byte."""
    return np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)


class Aligner:
    """Both encoders, from the bytes of their files."""

    def __init__(self, a_file: bytes, b_file: bytes) -> None:
        import sentencepiece
        import tiktoken

        letters, model = byte_letters(), json.loads(a_file)["model"]
        spelled = {i: bytes(letters[c] for c in token) for token, i in model["vocab"].items()}
        self._bytes_a = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if [model["vocab"][m] for m in merged] != sorted(model["vocab"][m] for m in merged):
            raise ValueError("the ids of A don't follow its merges")
        # The same merges, by rank: three times as fast as the library that the file is of (a test compares them).
        self._first = tiktoken.Encoding("a", pat_str=WORDS_OF_A, mergeable_ranks={b: i for i, b in spelled.items()}, special_tokens={})
        self._second = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        pieces = [self._second.id_to_piece(i) for i in range(self._second.get_piece_size())]
        if any("\u2581" in p.lstrip("\u2581") for p in pieces):
            raise ValueError("a piece of B goes on behind a space, so texts can't be cut before spaces")
        none = [self._second.is_control(i) or self._second.is_unknown(i) for i in range(len(pieces))]
        self._bytes_b = [b"" if none[i] else bytes([int(p[3:5], 16)]) if self._second.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(pieces)]
        self._length_a, self._length_b = (np.array([len(x) for x in spelled], np.int32) for spelled in (self._bytes_a, self._bytes_b))
        #: An id behind each mark: "," inside a list, "|" before B's, ";" before a group.
        self._ids = max(len(self._bytes_a), len(pieces))
        self._written = [f"{mark}{i}" for mark in ",|;" for i in range(self._ids)]

    def align_chunk(self, spaced: str) -> Alignment | None:
        """The alignment of a text that begins with its space, None if a tokenizer doesn't give it back."""
        b = self._second.encode(spaced[1:])
        raw = spaced.encode()
        if b"".join(map(self._bytes_b.__getitem__, b)) != raw:
            return None
        a = self._first.encode_ordinary(spaced)
        if b"".join(map(self._bytes_a.__getitem__, a)) != raw:
            return None
        a, b = np.array(a, np.int32), np.array(b, np.int32)
        length_a, length_b = self._length_a[a], self._length_b[b]
        own_a, own_b = owners(length_a), owners(length_b)
        new_a, new_b = own_a[1:] != own_a[:-1], own_b[1:] != own_b[:-1]
        starts = np.append(0, np.flatnonzero(new_a | new_b) + 1)
        cuts = np.flatnonzero(new_a & new_b) + 1
        group = lambda length: np.searchsorted(cuts, np.cumsum(length) - length, side="right")
        return Alignment(a, b, own_a[starts], own_b[starts], starts, cuts, group(length_a), group(length_b))

    def align(self, text: str | None) -> Alignment | None:
        """The alignment of a text of any length, None if it has no tokens."""
        parts, size = [], 0
        for chunk in chunks(text):
            x = self.align_chunk(chunk)
            if x is None:
                return None
            n_a, n_b, groups = (sum(f(p) for p in parts) for f in (lambda p: len(p.a), lambda p: len(p.b), lambda p: len(p.cuts)))
            cuts = x.cuts + size if not parts else np.append(size, x.cuts + size)
            groups += bool(parts)
            parts.append(Alignment(x.a, x.b, x.link_a + n_a, x.link_b + n_b, x.starts + size, cuts, x.group_a + groups, x.group_b + groups))
            size += len(chunk.encode())
        return Alignment(*(np.concatenate([getattr(p, f.name) for p in parts]) for f in fields(Alignment))) if parts else None

    def groups_text(self, x: Alignment) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        side = np.concatenate([2 * x.group_a, 2 * x.group_b + 1])
        order = np.argsort(side, kind="stable")
        side = side[order]
        new = np.append(True, side[1:] != side[:-1])
        mark = np.where(new, np.where(side % 2 == 1, 1, 2), 0)
        return "".join(map(self._written.__getitem__, (mark * self._ids + np.concatenate([x.a, x.b])[order]).tolist()))[1:]

    def facts(self, text: str | None) -> Facts | None:
        """The facts of a text, chunk by chunk; None if it has no tokens."""
        n, groups, pairs = np.zeros(4, np.int64), [], []
        for chunk in chunks(text):
            x = self.align_chunk(chunk)
            if x is None:
                return None
            n += (len(x.a), len(x.b), len(x.cuts) + 1, len(x.starts))
            groups.append(self.groups_text(x))
            pairs.append(x.pairs())
        return Facts(*n.tolist(), ";".join(groups), np.concatenate(pairs)) if pairs else None


def _ranges(low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers low[i], low[i] + 1, .. of each range, one range after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - count), count)


def chunks(text: str | None) -> Iterator[str]:
    """A space and the text, cut where both encoders treat the sides apart, in chunks of CHUNK characters or little more."""
    spaced, begin = (" " + text) if text else "", 0
    while begin < len(spaced):
        found = _APART.search(spaced, begin + CHUNK) if len(spaced) - begin > CHUNK else None
        end = found.start() if found else len(spaced)
        yield spaced[begin:end]
        begin = end


class Words:
    """The facts of words that stand between single spaces, remembered: both encoders treat each apart.

    New words are encoded together, many at a time, and their facts cut out of the
    common alignment. Words that a tokenizer doesn't give back, and those that touch other white
    space, are ``odd``: their texts are aligned as a whole.
    """

    def __init__(self, aligner: Aligner, most: int = WORDS) -> None:
        self._aligner, self._most = aligner, most
        self._clear()

    def _clear(self) -> None:
        self._at: dict[str, int] = {}
        self._groups: list[str] = []
        self._n = np.empty((0, 4), np.int64)
        self._pairs, self._ends = np.empty(0, np.int64), np.zeros(1, np.int64)
        self._hits = np.empty(0, np.int64)

    def _forget(self) -> None:
        """Keep the words that came again since the last time, half of what may be held at most."""
        keep = np.flatnonzero(self._hits > 1)
        keep = keep[np.argsort(-self._hits[keep], kind="stable")[: self._most // 2]]
        words, groups, n, count = list(self._at), self._groups, self._n[keep], self._n[keep, 3]
        pairs = self._pairs[_ranges(self._ends[keep], count)]
        self._clear()
        self._at = {words[k]: i for i, k in enumerate(keep.tolist())}
        self._groups = [groups[k] for k in keep.tolist()]
        self._n, self._pairs, self._ends, self._hits = n, pairs, np.append(0, np.cumsum(count)), np.zeros(len(keep), np.int64)

    def facts(self, texts: list[str | None]) -> Iterator[Facts | None]:
        """The facts of some texts, a few million characters at most (or one longer text)."""
        split = [t.split(" ") if t else [] for t in texts]
        each = [np.fromiter(map(self._at.get, words, repeat(-1)), np.int64, len(words)) for words in split]
        new = {words[k] for words, at in zip(split, each, strict=True) for k in np.flatnonzero(at < 0).tolist()}
        odd = {w for w in new if len(w) > WORD_CHARS or not _REGULAR.fullmatch(w)}
        if len(self._at) + len(new) - len(odd) > self._most and self._at:
            self._forget()
            yield from self.facts(texts)
            return
        held, size = [], 0
        for w in sorted(new - odd):
            held.append(w)
            size += len(w) + 1
            if size >= CHUNK:
                odd |= self._learn(held)
                held, size = [], 0
        odd |= self._learn(held)
        for words, at in zip(split, each, strict=True):
            for k in np.flatnonzero(at < 0).tolist():
                at[k] = self._at.get(words[k], -1)
        seen = np.concatenate([*each, [-1]])
        self._hits += np.bincount(seen[seen >= 0], minlength=len(self._hits))
        for text, at in zip(texts, each, strict=True):
            if not len(at) or at.min() < 0:
                yield self._aligner.facts(text)
                continue
            pairs = self._pairs[_ranges(self._ends[at], self._n[at, 3])]
            yield Facts(*self._n[at].sum(axis=0).tolist(), ";".join([self._groups[k] for k in at.tolist()]), pairs)

    def _learn(self, words: list[str]) -> set[str]:
        """Remember some words; returns those that can't be."""
        if not words:
            return set()
        joined = "".join(f" {w}" for w in words)
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        x = self._aligner.align_chunk(joined)
        if x is None or not np.isin(ends[:-1], x.cuts).all():
            half = len(words) // 2
            return set(words) if not half else self._learn(words[:half]) | self._learn(words[half:])
        per = lambda starts: np.bincount(np.searchsorted(ends, starts, side="right"), minlength=len(words))
        start = lambda ids, length: np.cumsum(length[ids]) - length[ids]
        counts = np.stack([per(start(x.a, self._aligner._length_a)), per(start(x.b, self._aligner._length_b)), per(np.append(0, x.cuts)), per(x.starts)], axis=1)
        groups, last = self._aligner.groups_text(x).split(";"), np.cumsum(counts[:, 2]).tolist()
        base = len(self._groups)
        self._groups += [";".join(groups[i - n : i]) for i, n in zip(last, counts[:, 2].tolist(), strict=True)]
        self._at.update({w: base + k for k, w in enumerate(words)})
        self._n = np.concatenate([self._n, counts])
        self._ends = np.append(self._ends, self._ends[-1] + np.cumsum(counts[:, 3]))
        self._pairs = np.concatenate([self._pairs, x.pairs()])
        self._hits = np.append(self._hits, np.zeros(len(words), np.int64))
        return set()


def _files(a: str | None, b: str | None) -> tuple[bytes, bytes]:
    own = default_vocabularies()
    return Path(a or own[0]).read_bytes(), Path(b or own[1]).read_bytes()


def aligned_documents(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """(doc_id, a_ids, b_ids, cuts, link_a, link_b) of every row; ``a`` and ``b`` are the paths of the vocabulary files.

    ``cuts`` are byte offsets in the spaced text where both end a token, links are token numbers.
    """
    files = _files(a, b)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*files)
        for batch in batches:
            found = [aligner.align(x.as_py()) for x in batch.column(1)]
            columns = [pa.array([[] if x is None else getattr(x, k) for x in found], pa.list_(pa.int32())) for k in ("a", "b", "cuts", "link_a", "link_b")]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *columns], ["doc_id", "a_ids", "b_ids", "cuts", "link_a", "link_b"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{k} array<int>" for k in ("a_ids", "b_ids", "cuts", "link_a", "link_b")))


_FACTS = ("n_a", "n_b", "n_groups", "n_links")
_BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
    "sizes array<int>, pairs array<long>, times array<int>, distinct array<long>, holders array<int>"
)


def _block(number: int, ids: list[int | None], facts: Iterator[Facts | None]) -> pa.RecordBatch:
    """One row of a block's documents, of their pairs, and of all pairs of the block with the number of its documents that hold them."""
    rows, pairs, times = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for doc_id, x in zip(ids, facts, strict=True):
        own, often = (pairs[0], times[0]) if x is None else np.unique(x.pairs, return_counts=True)
        digest = "" if x is None else hashlib.sha256(x.groups.encode()).hexdigest()
        rows.append((doc_id, *((0, 0, 0, 0) if x is None else (x.n_a, x.n_b, x.n_groups, x.n_links)), digest, len(own)))
        pairs.append(own)
        times.append(often)
    flat = np.concatenate(pairs)
    distinct, holders = np.unique(flat, return_counts=True)  # a document brings a pair once
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            *[one(columns[k], pa.int64()) for k in range(5)],
            one(columns[5], pa.string()),
            one(columns[6], pa.int32()),
            one(flat, pa.int64()),
            one(np.concatenate(times).astype(np.int32), pa.int32()),
            one(distinct, pa.int64()),
            one(holders.astype(np.int32), pa.int32()),
        ],
        [x.split()[0] for x in _BLOCKS.split(", ")],
    )


def _in_blocks(docs: DataFrame, files: tuple[bytes, bytes], size: int) -> DataFrame:
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number = Words(Aligner(*files)), TaskContext.get().partitionId() << 32
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc_id)
                texts.append(text.as_py())
                held += len(texts[-1] or "")
                if held >= size or len(ids) >= size >> 8:
                    yield _block(number, ids, words.facts(texts))
                    number, ids, texts, held = number + 1, [], [], 0
        if ids:
            yield _block(number, ids, words.facts(texts))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _BLOCKS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents again, each with the counts of its links."""
    for batch in batches:
        flat = lambda name, k: batch.column(name)[k].values
        for k in range(batch.num_rows):
            sizes = flat("sizes", k).to_numpy()
            pairs, times = flat("pairs", k).to_numpy(), flat("times", k).to_numpy().astype(np.int64)
            counts, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            if len(pairs):
                known = flat("known", k)
                order = np.argsort(known.field("pair").to_numpy())
                at = order[np.searchsorted(known.field("pair").to_numpy()[order], pairs)]
                found = known.field("found").to_numpy()[at]
                counts, best = found >> 1, found & 1
            ends = np.cumsum(sizes)
            sums = lambda x: np.append(0, np.cumsum(x))[ends] - np.append(0, np.cumsum(x))[ends - sizes]  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [*[flat(c, k) for c in ("doc_id", *_FACTS)], pa.array(sums(times * best)), pa.array(sums(times * counts)), flat("groups_sha256", k)],
                ["doc_id", *_FACTS, "n_best", "count_sum", "groups_sha256"],
            )


def alignment_report(docs: DataFrame, a: str | None = None, b: str | None = None, size: int = BLOCK) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    blocks = written(_in_blocks(docs, _files(a, b), size), "blocks", GROUP)
    pairs = blocks.select("block", F.explode(F.arrays_zip("distinct", "holders")).alias("x")).select("block", F.col("x.distinct").alias("pair"), F.col("x.holders").alias("holders"))
    counts = pairs.groupBy("pair").agg(F.sum("holders").alias("n"))
    top = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    found = counts.select("pair", (F.shiftleft("n", 1) + (F.col("n") == top).cast("long")).alias("found"))
    known = pairs.select("block", "pair").join(written(found, "pair-counts"), "pair").groupBy("block").agg(F.collect_list(F.struct("pair", "found")).alias("known"))
    joined = blocks.select("block", "doc_id", *_FACTS, "groups_sha256", "sizes", "pairs", "times").join(known, "block", "left")
    facts = ", ".join(f"{c} long" for c in (*_FACTS, "n_best", "count_sum"))
    return joined.mapInArrow(released(_counted), f"doc_id long, {facts}, groups_sha256 string")


def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return alignment_report(table(spark, sf_dir, "documents"))


QUERIES = {"op11_cross_tokenizer": op11_cross_tokenizer}
ORACLES: dict[str, str] = {}

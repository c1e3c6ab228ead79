"""Language by cross-parsing: the language whose text parses a document into fewest phrases.

For each language a suffix automaton holds every substring of some of its text.
A document is parsed greedily: a phrase grows while the automaton follows, then
a new one starts. Phrases times log2 of the text behind the automaton estimate
the cross entropy; the least wins (ties: the first name in order). The score is
the runner-up's share of both, 0.5 for a tie and near 1 for a clear case.

Every text is parsed whole, from its first byte to its last. Texts are lanes of
an array: one step advances all of a batch, in all languages, by one byte, and
lanes carry their states from block to block. Where fewer than ``LANES`` texts of a batch are that
long, they are finished byte by byte, with the same result. Case is folded;
digits, marks and white space are one symbol.

Null texts and texts without a letter (general category L) are ``und`` with score
0. Without learnable rows everything is, and an empty table gives an empty result.
Rows that repeat are judged each for itself and alike; if they bring a doc_id into
the sample, its texts count once each. Only doc_id, text and lang are read, so
other columns, whatever their names, change nothing. Learning takes whole texts,
in hash order of their ids: at most ``LEARN_ROWS`` rows of each language, as far
as they fit ``LEARN_BYTES`` bytes together (documented bounds); a language without
a text that short learns from its shortest one. There is no bound on the number
of languages: the model has one automaton for each, stored by its moves, of which
there are fewer than three for each of its LEARN_BYTES bytes, eight bytes each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brooklet.llm.common import bucket, pieces, released, table

LEARN_ROWS, LEARN_BYTES = 192, 40_000
#: Texts that are still parsed together, and steps between two looks at how many are left.
LANES, STEPS = 24, 1024
#: Places before the last one where room for the next state is sought.
LOOK_BACK = 256
#: Rows and bytes of text that are parsed together.
ROWS, PIECE = 8192, 16 << 20
_LETTER = regex.compile(r"\p{L}")
_REST, _UNKNOWN = 0, 1


class Model(NamedTuple):
    names: list[str]
    symbols: np.ndarray  # of each byte
    width: int
    moves: np.ndarray  # of all languages: at state + symbol, the state that the move belongs to and, in the low 32 bits, the next one
    starts: np.ndarray  # by symbol and language: the state behind the first symbol of a phrase; 0 leads nowhere
    weights: list[float]


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 1 is the root, 0 none."""
    go: list[dict[int, int]] = [{}, {}]
    link, length, last = [0, 0], [0, 0], 1
    for s in symbols:
        new = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p and s not in go[p]:
            go[p][s] = new
            p = link[p]
        if not p:
            link[new] = 1
        else:
            q = go[p][s]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p and go[p].get(s) == q:
                    go[p][s] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return go


def fold(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def placed(go: list[dict[int, int]], width: int, begin: int) -> tuple[list[int], int]:
    """(a place for each state, the end), such that no two moves share place + symbol, nor two states a place.

    Places start at ``begin``. States of several moves come first, each where its
    moves fit between the earlier ones; states of one move fill the gaps. So an
    automaton takes about as many cells as it has moves, however many symbols there
    are. States without moves have place 0.
    """
    place = [0] * len(go)
    low, held, used = 0, 0, 0  # bits of the cells and places from ``low`` on, all counted from ``begin``
    for state in sorted((k for k, row in enumerate(go) if len(row) > 1), key=lambda k: (-len(go[k]), k)):
        taken = used
        for s in go[state]:
            taken |= held >> s
        at = (~taken & (taken + 1)).bit_length() - 1  # the lowest bit that is not set
        place[state], used = low + at, used | 1 << at
        for s in go[state]:
            held |= 1 << at + s
        behind = max(0, at - LOOK_BACK)
        low, held, used = low + behind, held >> behind, used >> behind
    end = max(place) + 1
    size = end + width
    filled, places = bytearray(size), bytearray(size)
    single: dict[int, list[int]] = {}
    for state, row in enumerate(go):
        if len(row) == 1:
            single.setdefault(next(iter(row)), []).append(state)
        elif row:
            places[place[state]] = 1
            for s in row:
                filled[place[state] + s] = 1
    cell = 0
    while single:
        if cell == len(filled):
            filled.extend(bytes(size))
            places.extend(bytes(size))
        if not filled[cell]:
            for s, states in single.items():
                at = cell - s
                if at >= 0 and not places[at]:
                    place[states.pop()], places[at], end = at, 1, max(end, at + 1)
                    if not states:
                        del single[s]
                    break
        cell += 1
    return [p + begin if row else 0 for p, row in zip(place, go, strict=True)], end + begin


def fit(samples: dict[str, list[str]]) -> Model | None:
    """The automata of some texts by language."""
    joined = {name: b" ".join(fold(t) for t in texts) for name, texts in sorted(samples.items())}
    joined = {name: t for name, t in joined.items() if t}
    if not joined:
        return None
    symbols = np.full(256, _REST, np.uint8)
    seen = sorted({b for t in joined.values() for b in t if b >= 0x80 or 97 <= b <= 122})
    symbols[128:] = _UNKNOWN
    symbols[97:123] = _UNKNOWN
    for i, b in enumerate(seen):
        symbols[b] = 2 + i
    width = 2 + len(seen)
    parts, starts, weights, begin = [], [], [], 1
    for text in joined.values():
        go = automaton(symbols[np.frombuffer(text, np.uint8)].tolist())
        place, end = placed(go, width, begin)
        cells = np.full(end - begin + width, -1, np.int64)  # no state has the number of an empty cell
        places, moved = np.array(place, np.int64), [len(row) for row in go]
        owners = np.repeat(places, moved)
        by, to = (np.fromiter(chain.from_iterable(x), np.int64, len(owners)) for x in (go, (row.values() for row in go)))
        cells[owners + by - begin] = owners << 32 | places[to]
        parts.append(cells)
        starts.append([place[go[1].get(s, 0)] for s in range(width)])
        weights.append(math.log2(max(2, len(text))))
        begin += len(cells)
    moves = np.concatenate([np.full(1, -1, np.int64), *parts, np.full(width, -1, np.int64)])
    return Model(list(joined), symbols, width, moves, np.array(starts, np.int64).T.copy(), weights)


def chosen(texts: list[str], size: int = LEARN_BYTES) -> list[str]:
    """The first of some texts that fit ``size`` bytes together, one that doesn't fit passed over; else the first."""
    out, left = [], size
    for text in texts:
        n = len(text.encode("utf-8", "replace"))
        if n <= left:
            out.append(text)
            left -= n
    return out or texts[:1]


def cleaned(samples: dict[str, list[str]]) -> dict[str, list[str]]:
    """The texts that automata of the other half of the sample ascribe to their own language.

    Labelled rows may quote another language; such a row would let its language
    parse the other's text. Languages that would lose most of their rows keep all.
    """
    halves = [fit({name: chosen(texts[k::2]) for name, texts in samples.items()}) for k in (1, 0)]
    out = {}
    for name, texts in samples.items():
        own = [t for k in (0, 1) for t, (found, _) in zip(texts[k::2], predict(halves[k], texts[k::2]), strict=True) if found == name]
        out[name] = own if 2 * len(own) > len(texts) else texts
    return out


def phrases(model: Model, coded: list[np.ndarray]) -> np.ndarray:
    """Phrases of each text (its symbols) in each language: one step takes all texts in all languages a symbol further."""
    languages = len(model.names)
    out = np.zeros((len(coded), languages))
    order = sorted(range(len(coded)), key=lambda i: -len(coded[i]))
    sizes = np.array([len(coded[i]) for i in order])
    if not len(sizes):
        return out
    moves, starts = model.moves, model.starts
    # State 0 leads nowhere: the next symbol starts a phrase. So does a symbol that the language lacks, and the one behind it.
    count, state = np.zeros((len(order), languages), np.int64), np.zeros((len(order), languages), np.int64)
    cell, move, first = np.empty_like(state), np.empty_like(state), np.empty_like(state)
    missed = np.empty(state.shape, bool)
    at, lanes = 0, len(order)
    while lanes >= LANES:
        steps = int(min(STEPS, sizes[0] - at))
        grid = np.zeros((steps, lanes), np.int64)
        for lane in range(lanes):
            part = coded[order[lane]][at : at + steps]
            grid[: len(part), lane] = part
        live = np.searchsorted(-sizes, -(at + np.arange(steps)), side="left")  # lanes longer than each step
        for row, n in zip(grid, live.tolist(), strict=True):
            row, here, c, m, f, no = row[:n], state[:n], cell[:n], move[:n], first[:n], missed[:n]
            np.add(here, row[:, None], out=c)
            np.take(moves, c, out=m, mode="clip")  # always within: the mode spares a copy
            np.take(starts, row, axis=0, out=f, mode="clip")
            np.right_shift(m, 32, out=c)
            np.not_equal(c, here, out=no)
            np.bitwise_and(m, 0xFFFFFFFF, out=here)
            np.copyto(here, f, where=no)
            np.add(count[:n], no, out=count[:n])
        at += steps
        lanes = int(np.searchsorted(-sizes, -at, side="left"))
    cells = memoryview(moves)
    for lane in range(lanes):
        rest = coded[order[lane]][at:].tolist()
        for k in range(languages):
            here, more, begins = int(state[lane, k]), 0, starts[:, k].tolist()
            for c in rest:
                m = cells[here + c]
                if m >> 32 == here:
                    here = m & 0xFFFFFFFF
                else:
                    more += 1
                    here = begins[c]
            count[lane, k] += more
    out[order] = count
    return out


def predict(model: Model | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, score) of each text."""
    result: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
    if model is None:
        return result
    live = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
    coded = [model.symbols[np.frombuffer(fold(texts[i] or ""), np.uint8)] for i in live]
    total = phrases(model, coded) * model.weights
    for i, costs in zip(live, total, strict=True):
        order = np.argsort(costs, kind="stable")
        best = costs[order[0]]
        second = costs[order[1]] if len(order) > 1 else best
        result[i] = (model.names[order[0]], float(second / (best + second)))
    return result


def fit_from(docs: DataFrame, learn: Column) -> Model | None:
    """Automata of a bounded sample of each language, chosen by the hash of the ids."""
    rows = docs.where(learn & F.col("lang").isNotNull() & (F.octet_length("text") > 0)).select("lang", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("part"))
    short = F.octet_length("text") <= LEARN_BYTES
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count_if(short).alias("n")).collect()}
    # A threshold on the hash leaves some more than LEARN_ROWS rows, of which the first are ranked.
    limits = [(name, min(1 << 30, (2 * LEARN_ROWS << 30) // n)) for name, n in counts.items() if n]
    samples: dict[str, list[str]] = {name: [] for name in counts}
    if limits:
        first = Window.partitionBy("lang").orderBy("part", "text")
        side = docs.sparkSession.createDataFrame(limits, "lang string, most long")
        able = rows.where(short).join(F.broadcast(side), "lang").where("part < most").drop("most").distinct()
        for r in able.withColumn("place", F.row_number().over(first)).where(F.col("place") <= LEARN_ROWS).orderBy("lang", "place").collect():
            samples[r["lang"]].append(r["text"])
    long = [name for name, n in counts.items() if not n]
    if long:
        shortest = rows.where(F.col("lang").isin(long)).groupBy("lang").agg(F.min(F.struct(F.octet_length("text"), "text")).alias("least"))
        samples |= {r["lang"]: [r["least"]["text"]] for r in shortest.collect()}
    return fit({name: chosen(texts) for name, texts in cleaned(samples).items()})


def identify(docs: DataFrame, model: Model | None, held_out: Column) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    names = ["doc_id", "held_out", "lang_pred", "score"]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [t or "" for t in part.column(2).to_pylist()]
                found = [x for _, some in pieces(part, texts, PIECE) for x in predict(model, some)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = bucket(F.col("doc_id"), 5)
    return identify(docs, fit_from(docs, remainder != 0), F.coalesce(remainder == 0, F.lit(False)))


QUERIES = {"op5_language_id": op5_language_id}
ORACLES: dict[str, str] = {}

"""Near-duplicate groups: fast similarity sketches, banding, exact verification, components.

Words are A-Z lower-cased ``[^\\x20\\x09-\\x0D]+`` runs of whole texts; a document's
set holds its distinct word shingles as 64-bit hashes (fewer words than a
shingle: the whole sequence as one). Null, empty and blank texts have an empty
set and link with nothing.

Plan. One pass turns every text, however long, into its set's size, a 128-bit set
fingerprint, a sketch of ``BINS`` coordinates (a byte of each) and its band keys;
this table is written in the shared folder. Documents with one fingerprint form a
class and only its smallest id goes on, so thousands of copies cost one row.
Classes that share a band key are a bucket; the family of a class is all buckets
in which its id is the smallest, and every pair of a bucket is in a family.

A family meets in tasks of at most two blocks of ``BLOCK`` members: larger
families are cut into blocks and each two blocks meet, so no task holds an
unbounded group. First only sketches meet: members without a partner that agrees
in at least ``NEAR`` of the coordinates drop out, so a boilerplate band shared by
unlike documents moves no text. The texts of the others follow. There each member
is first compared with the smallest id; pairs that this joins need no comparison.
For the others pairs that agree in sketches are compared on full sets. Only links
leave the task, never pairs, and every link is confirmed on full sets.

Two documents of similarity 0.8 share no band with probability
(1 - 0.8**6)**40 = 5e-6 and agree in fewer than NEAR of the coordinates with 4e-6.

Repeated doc_ids: rows with one doc_id are one document if their texts agree;
otherwise each row is linked under that id, and all rows get the id's component.
A null doc_id has a null component and is kept. An empty table gives an empty
result. Only doc_id and text are read; ``kept_documents`` keeps all columns,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brooklet.llm.common import bounded_batches, byte_column, dropped, every, pieces, released, table, unused, written

BANDS, ROWS = 40, 6
BINS = BANDS * ROWS
SHINGLE = 5
PERCENT = 80
BLOCK = 1024
NEAR = 0.68
_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (splitmix64's finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Word to 64-bit hash; forgets all once large, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_sets(texts: list[bytes], size: int, hashes: dict[bytes, int]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out = []
    for text in texts:
        words = text.lower().split()
        n = len(words)
        if not n:
            out.append(np.empty(0, np.uint64))
            continue
        h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
        width = min(size, n)
        s = h[: n - width + 1].copy()
        for k in range(1, width):
            s = s * _GOLD + h[k : n - width + 1 + k]
            s ^= s >> np.uint64(29)
        out.append(np.unique(mixed(s ^ np.uint64(width))))
    return out


def sketch(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """Fast similarity sketches, one row per nonempty set.

    Round i < bins hashes every element to one bin with a value above those of
    earlier rounds; a bin keeps its least value, so a bin that is filled stays
    as it is. After ``bins`` rounds, round bins + j puts every element in bin j:
    no coordinate stays empty, and all but short sets fill within a few rounds.
    """
    n = len(sets)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    table_ = np.full((n, bins), empty, np.uint64)
    live = np.arange(n)
    for i in range(2 * bins):
        if not len(live):
            break
        owner = np.repeat(live, [len(sets[k]) for k in live])
        v = mixed(np.concatenate([sets[k] for k in live]) + np.uint64(0x9E3779B97F4A7C15 * (i + 1) & 0xFFFFFFFFFFFFFFFF))
        value = (np.uint64(i) << np.uint64(54)) | (v >> np.uint64(10))
        column = ((v & np.uint64(0xFFFFFFFF)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64) if i < bins else np.full(len(v), i - bins)
        np.minimum.at(table_.reshape(-1), owner * bins + column, value)
        live = live[(table_[live] == empty).any(1)]
    return table_


def band_keys(sketches: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    n, bins = sketches.shape
    parts = sketches.reshape(n, bands, bins // bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD, (n, bands)).copy()
    for k in range(parts.shape[2]):
        key = mixed(key ^ parts[:, :, k]) + _GOLD
    return key


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, mark, n_shingles, print_a, print_b, bands, coded) of every row.

    ``mark`` is a hash of the text, ``coded`` the last byte of each coordinate.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            for rows, texts in pieces(batch, byte_column(batch, "text"), 1 << 20):
                sets = shingle_sets(texts, shingle, hashes)
                full = [i for i, s in enumerate(sets) if len(s)]
                sketches = sketch([sets[i] for i in full])
                keys = band_keys(sketches).view(np.int64)
                codes = dict(zip(full, (sketches & np.uint64(0xFF)).astype(np.uint8), strict=True))
                prints = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
                signed = np.array([[p >> 64, p & 0xFFFFFFFFFFFFFFFF] for p in prints], np.uint64).view(np.int64)
                offsets = np.concatenate([[0], np.cumsum([BANDS if len(s) else 0 for s in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows)),
                        batch.column(1).take(pa.array(rows)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(signed[:, 0]),
                        pa.array(signed[:, 1]),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1))),
                        pa.array([codes[i].tobytes() if i in codes else b"" for i in range(len(sets))], pa.binary()),
                    ],
                    ["doc_id", "mark", "n_shingles", "print_a", "print_b", "bands", "coded"],
                )

    return docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(run, "doc_id long, mark long, n_shingles long, print_a long, print_b long, bands array<long>, coded binary")


class _Forest:
    """Union-find over positions."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _partners(i: int, coded: np.ndarray, n: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """Which members may be similar to member i, by sketches and set sizes, and meet it in this task."""
    fits = ((coded == coded[i]).sum(1) >= NEAR * coded.shape[1]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])) & ((side | side[i]) == 3)
    fits[i] = False
    return fits


def hopeful(coded: np.ndarray, n: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """Which members of a family have any partner in this task."""
    out = np.zeros(len(n), bool)
    for i in range(len(n)):
        if not out[i]:
            fits = _partners(i, coded, n, side, percent)
            if fits.any():
                out |= fits
                out[i] = True
    return out


def family_links(sets: list[np.ndarray], coded: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (positions) that join a family's similar sets; position 0 is the family's first id, if that has a partner.

    ``side`` says which members are of this task's first and second block (both:
    3); pairs within a single block of two are left to the task of that block.
    """
    n = np.array([len(x) for x in sets], np.int64)

    def similar(i: int, j: int) -> bool:
        if 100 * min(n[i], n[j]) < percent * max(n[i], n[j]):
            return False
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return 100 * both >= percent * (int(n[i]) + int(n[j]) - both)

    forest, links = _Forest(len(sets)), []
    for i in range(1, len(sets)):
        if similar(0, i) and forest.join(0, i):
            links.append((0, i))
    loose = [i for i in range(1, len(sets)) if forest.root(i) != 0]
    for i in loose if len(sets) > 2 else ():
        for j in np.flatnonzero(_partners(i, coded, n, side, percent)).tolist():
            if forest.root(i) != forest.root(j) and similar(i, j) and forest.join(i, j):
                links.append((i, j))
    return links


_MEETING = ["family", "low", "high", "side", "id", "mark", "n", "coded"]


def _by_meeting(rows: DataFrame, make: Callable[[], tuple[Callable[[dict], dict], Callable[[list[dict]], Iterator[pa.RecordBatch]]]], schema: str) -> DataFrame:
    """A map over the members of each (family, low, high), in order of their ids; blocks bound their number.

    ``make`` gives, for each task, what becomes of a member as it comes and what to do with the members that meet.
    """

    @released
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrive, run = make()
        key, members = None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for r in batch.slice(at, 256).to_pylist():
                    here = (r["family"], r["low"], r["high"])
                    if here != key:
                        if len(members) > 1:
                            yield from run(members)
                        key, members = here, []
                    members.append(arrive(r))
        if len(members) > 1:
            yield from run(members)

    blocks = _MEETING[:3]
    return rows.repartition(*blocks).sortWithinPartitions(*blocks, "id").mapInArrow(each, schema)


def _sketches(members: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    coded = np.frombuffer(b"".join(r["coded"] for r in members), np.uint8).reshape(len(members), -1)
    return coded, np.array([r["n"] for r in members], np.int64), np.array([r["side"] for r in members])


def met(rows: DataFrame, percent: int) -> DataFrame:
    """The rows (of ``_MEETING``) of the members that have a partner where they meet."""

    def run(members: list[dict]) -> Iterator[pa.RecordBatch]:
        kept = [r for r, x in zip(members, hopeful(*_sketches(members), percent).tolist(), strict=True) if x]
        if kept:
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in kept], t) for c, t in zip(_MEETING, types, strict=True)], _MEETING)

    return _by_meeting(rows, lambda: (lambda r: r, run), "family long, low int, high int, side int, id long, mark long, n long, coded binary")


def compared(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The links (a, b) of families: rows of ``_MEETING`` and text."""

    def make() -> tuple[Callable[[dict], dict], Callable[[list[dict]], Iterator[pa.RecordBatch]]]:
        hashes = _WordHashes()

        def arrive(r: dict) -> dict:
            r["set"] = shingle_sets([(r.pop("text") or "").encode()], shingle, hashes)[0]
            return r

        def run(members: list[dict]) -> Iterator[pa.RecordBatch]:
            coded, _, side = _sketches(members)
            pairs = [(members[i]["id"], members[j]["id"]) for i, j in family_links([r["set"] for r in members], coded, side, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([y for _, y in pairs], pa.int64())], ["a", "b"])

        return arrive, run

    return _by_meeting(rows, make, "a long, b long")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) of every id in links (a, b): the smallest id reachable.

    Every round gives each id the smallest label among its neighbours, then the
    label of its label (a pointer jump); each round is a written table, and the
    number of rounds is logarithmic for stars and chains alike.
    """
    both = links.select(F.col("a").alias("id"), F.col("b").alias("other")).union(links.select(F.col("b"), F.col("a"))).where("id <> other").distinct()
    edges = written(both, f"{name}-edges")
    state = written(edges.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("component")), f"{name}-state")
    while True:
        label = state.select(F.col("id").alias("other"), F.col("component").alias("near"))
        hop = edges.join(label, "other").groupBy("id").agg(F.min("near").alias("near"))
        least = state.join(hop, "id").select("id", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        jump = state.select(F.col("id").alias("component"), F.col("component").alias("root"))
        moved = written(least.join(jump, "component", "left").select("id", "was", F.least("component", F.coalesce("root", "component")).alias("component")), f"{name}-state")
        same = moved.where("component <> was").isEmpty()
        dropped(state)
        state = moved
        if same:
            dropped(edges)
            return state.select("id", "component")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(signatures(base, shingle), "signatures")
    full = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Written aggregates: a join of two plain shuffles can be split where a key is hot.
    classes = written(full.groupBy("print_a", "print_b").agg(F.min("doc_id").alias("rep")), "prints")
    member = full.select("doc_id", "print_a", "print_b").join(classes, ["print_a", "print_b"])

    chosen = classes.select("print_a", "print_b", F.col("rep").alias("doc_id"))
    reps = written(full.join(chosen, ["print_a", "print_b", "doc_id"], "left_semi").dropDuplicates(["doc_id", "print_a", "print_b"]).select("doc_id", "mark", "n_shingles", "bands", "coded"), "classes")
    sketches = reps.select(F.col("doc_id").alias("id"), "mark", F.col("n_shingles").alias("n"), "coded")
    meetings = written(_families(reps), "families").hint("merge").join(sketches, "id").select(*_MEETING)
    partners = written(met(meetings, percent), "partners")
    # Dealt by id at every size: the plan doesn't turn into another one as families grow.
    texts = base.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"), "text")
    texts = texts.dropDuplicates(["id", "mark"]) if _repeats(base) else texts
    rows = partners.hint("merge").join(texts, ["id", "mark"]).select(*_MEETING, "text")
    links = written(compared(rows, shingle, percent), "links")
    found = components(links)

    # Copies hang on their representative, so components of the representatives are enough.
    by_id = (
        member.select("doc_id", "rep")
        .join(found.select(F.col("id").alias("rep"), "component"), "rep", "left")
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("component", "rep")).alias("component"))
    )
    return signed.select("doc_id", "n_shingles").join(by_id, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        (F.coalesce("component", "doc_id").eqNullSafe(F.col("doc_id"))).alias("kept"),
    )


def _families(reps: DataFrame, block: int | None = None) -> DataFrame:
    """(family, low, high, side, id): the members of each family, once for each two blocks they are compared in."""
    block = block or BLOCK
    spread = reps.select(F.col("doc_id").alias("id"), F.explode("bands").alias("band"))
    first = spread.groupBy("band").agg(F.min("id").alias("family"), F.max("id").alias("last")).where("family <> last").select("band", "family")
    member = written(spread.join(written(first, "buckets"), "band").select("family", "id").distinct(), "members")
    large = written(member.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).where("blocks > 1"), "large")
    placed = member.join(large, "family", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    pair = lambda x, y, s: F.struct(F.least(x, y).alias("low"), F.greatest(x, y).alias("high"), s.alias("side"))
    side = lambda k: F.when(F.col("own") == k, 3).when(F.col("own") < k, 1).otherwise(2)
    mine = F.transform(others, lambda k: pair(F.col("own"), k, side(k)))
    every = F.flatten(F.transform(others, lambda i: F.transform(F.sequence(i, F.col("blocks") - 1), lambda j: pair(i, j, F.lit(3)))))
    meets = F.when(F.col("id") == F.col("family"), every).otherwise(mine)
    return placed.select("family", "id", F.explode(meets).alias("meet")).select("family", "meet.low", "meet.high", "meet.side", "id")


def _repeats(base: DataFrame) -> bool:
    """Whether a doc_id occurs twice."""
    return not base.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty()


def kept_documents(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that represent their group, columns unchanged.

    Of rows with one doc_id one stays, the first by text, then by all its columns.
    """
    lost, twice, place = unused(docs.columns, "lost", "twice", "place")
    # Written ids: their size decides whether documents move for the join at all.
    gone = written(near_duplicates(docs, shingle, percent).where("NOT kept").select(F.col("doc_id").alias(lost)).distinct(), "gone")
    left = docs.join(gone, F.col("doc_id").cast("long") == F.col(lost), "left_anti")
    again = written(docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias(twice)).count().where("count > 1").select(twice), "again")
    if again.isEmpty():
        return left
    same = F.col("doc_id").cast("long") == F.col(twice)
    first = Window.partitionBy("doc_id").orderBy("text", F.to_json(F.struct(*every(docs))))
    one = left.join(again, same, "left_semi").withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).select(*every(docs))
    return left.join(again, same, "left_anti").union(one)


def op6_minhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


QUERIES = {"op6_minhash_near_dups": op6_minhash_near_dups}
ORACLES: dict[str, str] = {}

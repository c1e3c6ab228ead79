"""BPE encoding and decoding by a streaming transducer with bounded lookahead.

Encoding of a prefix at a token boundary is a prefix of the encoding, so one
token per place of a word is enough: the last token of the encoding of the word
up to there. A token may end at a place if it fits the last token of the place
where it starts, that is, if merging the two tokens' symbols gives just these two
again. The transducer reads a word symbol by symbol. A place is live while the
symbols since then begin some token; whatever follows continues from a live place
or from the end, and no token is longer than the longest product of the merge
list (``sufficient_lookahead``), so at most that many places are live. Tokens
that the paths to all of them share are stable and are emitted, and only the
window behind them is kept, however long the word is. Every word goes through
the transducer; what it emits for short words is remembered in a bounded table.

Decoding turns ids into bytes and bytes into text as they come
(``Decoder``, an incremental byte-to-text state machine): by default the tokens'
spelling joined by a space, as a tokenizer file without decoder asks for, or
plain text. At the end of a word no byte is pending, so what the machine makes
of a word is remembered beside its ids.

Splitting uses the letters and digits of the tokenizers library's own tables, and
case and composition follow it where its Unicode version is later than the
interpreter's.

Texts are handled whole, word by word; the digests are updated as tokens come, so
very long texts and words take bounded memory. Null counts as empty: no tokens,
digests of the empty string. Strings of special tokens inside a text become those
tokens (the longest first where several begin at one place). Rows that repeat, in
doc_id or altogether, are encoded each for itself and alike; a row that repeats
the text just before it takes over its result. An empty table gives an empty
result. Only doc_id and text are read, whatever the names of other columns.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import itertools
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from brooklet.llm.common import released, table

END = "</w>"
#: Fixed values of the tokenizer file's format: white space, and the split pattern's parts.
_SPACES = "\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
_ODD_SPACE = regex.compile("[\x1c-\x1f]")
_PLAIN = regex.compile("[!-~]+")
_BLOCK = 8192
_MARKS = frozenset(",.;:!?")
#: A comma or full stop that belongs to a longer run of marks.
_TIED = re.compile(r"(?:[^\w\s]|_)[,.]|[,.][^\w\s]")
#: Pieces a codec remembers in each of two generations, and pairs of tokens for each piece.
_WORDS = 350_000
_PAIRS = 2
#: How many times its lookahead the transducer reads before it looks for stable tokens.
WINDOW = 4
#: Stands before the first token; no token holds a space.
_START = " "


def _points() -> Iterable[int]:
    """All code points but surrogates."""
    return itertools.chain(range(0xD800), range(0xE000, 0x110000))


class Script(NamedTuple):
    """What texts are made of by the library's Unicode tables."""

    letters: list[tuple[int, int]]  # first and last code point of each range
    digits: list[tuple[int, int]]
    later: frozenset[str]  # characters that the interpreter's tables don't have
    lower: dict[int, str]  # lower case where it isn't the interpreter's


@functools.cache
def library_script() -> Script:
    from tokenizers import Regex, normalizers

    def inside(pattern: str) -> list[tuple[int, int]]:
        held = normalizers.Replace(Regex(pattern), "").normalize_str("".join(map(chr, _points())))
        return _ranges(map(ord, held))

    later = frozenset(c for a, b in inside(r"\p{Cn}") for c in map(chr, range(a, b + 1)) if unicodedata.category(c) == "Cn")
    small = normalizers.Lowercase()
    lower = {c: x for c in _points() if (x := small.normalize_str(chr(c))) != chr(c).lower()}
    return Script(inside(r"[^\p{L}]"), inside(r"[^\p{N}]"), later, lower)


def _ranges(points: Iterable[int]) -> list[tuple[int, int]]:
    """Ascending code points as ranges."""
    out: list[tuple[int, int]] = []
    for c in points:
        if out and c == out[-1][1] + 1:
            out[-1] = (out[-1][0], c)
        else:
            out.append((c, c))
    return out


def _class(ranges: list[tuple[int, int]], limit: int = 0x110000) -> str:
    """Ranges as they stand in a character class, for texts of code points below ``limit``."""
    return "".join(rf"\U{a:08x}-\U{min(b, limit):08x}" for a, b in ranges if a < limit)


def piece_pattern(script: Script, limit: int = 0x110000) -> regex.Pattern:
    """The split pattern, for texts of code points below ``limit``: a small class is searched faster."""
    letters, digits = _class(script.letters, limit), _class(script.digits, limit)
    return regex.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{_SPACES}{letters}{digits}]+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next free one from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, free = [""] * 256, 256
    for b in range(256):
        if b in shown:
            letters[b] = chr(b)
        else:
            letters[b], free = chr(free), free + 1
    return letters


class Vocabulary(NamedTuple):
    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    special: dict[str, int]
    whole: frozenset[str]  # tokens that the merges make of their own symbols
    heads: frozenset[str]  # what such tokens begin with

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        ranks = {p: i for i, p in enumerate(pairs)}
        whole = frozenset(t for t in model["vocab"] if merge(symbols(t), ranks) == [t])
        heads = frozenset("".join(parts[:k]) for parts in map(symbols, whole) for k in range(1, len(parts)))
        return cls(model["vocab"], ranks, {t["content"]: t["id"] for t in data["added_tokens"]}, whole, heads)


def symbols(token: str) -> list[str]:
    """The base symbols of a token: its letters, the last one with the end mark if the token has it."""
    if token.endswith(END) and len(token) > len(END):
        letters = list(token[: -len(END)])
        letters[-1] += END
        return letters
    return list(token)


def merge(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge by rank, leftmost first, until no pair has a rank."""
    while len(parts) > 1:
        rank, at = min((ranks.get(pair, 1 << 60), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
        if rank == 1 << 60:
            break
        parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]
    return parts


def sufficient_lookahead(ranks: dict[tuple[str, str], int]) -> int:
    """The symbols of the longest product of a merge list: no later symbol changes tokens that end further back."""
    parts = {a + b: (a, b) for a, b in ranks}
    sizes: dict[str, int] = {}
    for product in parts:
        todo = [product]
        while todo:  # parts first, without recursion: a merge list may be deep
            token = todo[-1]
            missing = [x for x in parts.get(token, ()) if x not in sizes]
            if missing:
                todo += missing
                continue
            sizes[token] = sum(sizes[x] for x in parts[token]) if token in parts else 1
            todo.pop()
    return max(sizes.values(), default=1)


class Transducer:
    """Encodes words symbol by symbol in memory bounded by the lookahead."""

    def __init__(self, vocabulary: Vocabulary, pairs: int = _PAIRS * _WORDS) -> None:
        self.vocabulary = vocabulary
        self.pairs = pairs
        self.lookahead = sufficient_lookahead(vocabulary.ranks)
        self._made_of = {a + b: (a, b) for a, b in vocabulary.ranks}
        self._ends: dict[str, list[tuple[str, float]]] = {}
        self._begins: dict[str, list[tuple[str, float]]] = {}
        self._known: dict[tuple[str, str], bool] = {}

    def _side(self, token: str, right: bool) -> list[tuple[str, float]]:
        """The parts that stand at one end of a token while it grows, each with the rank of the merge that absorbs it."""
        held = self._ends if right else self._begins
        known = held.get(token)
        if known is None:
            known, part, rank = [], token, float("inf")
            while True:
                known.append((part, rank))
                pair = self._made_of.get(part)
                if pair is None:
                    break
                part, rank = pair[right], self.vocabulary.ranks[pair]
            held[token] = known
        return known

    def fits(self, left: str, right: str) -> bool:
        known = self._known.get((left, right))
        if known is None:
            if len(self._known) >= self.pairs:
                self._known.clear()
            known = self._known[left, right] = self._fits(left, right)
        return known

    def _fits(self, left: str, right: str) -> bool:
        """Whether merging the symbols of two whole tokens gives the two again.

        Merges apply in order of rank, so a pair over the border is merged only
        if its rank comes before the ranks that absorb its two parts; of equal
        ranks the leftmost pair goes first.
        """
        ranks = self.vocabulary.ranks
        begins = self._begins.get(right) or self._side(right, False)
        for a, until_a in self._ends.get(left) or self._side(left, True):
            for b, until_b in begins:
                rank = ranks.get((a, b))
                if rank is not None and rank < until_a and rank <= until_b:
                    return False
        return True

    def encode(self, word: str) -> Iterator[str]:
        """The tokens of a word of letters; each is emitted once no continuation can change it.

        The window grows by at most ``WINDOW`` times the lookahead at once; then
        the tokens shared by the paths to all live places go out and leave it.
        """
        n, base, stop = len(word), 0, 0
        last = {0: _START}  # of a place of the window: the last token of the encoding up to there
        while base < n:
            stop = min(n, stop + WINDOW * self.lookahead)
            at = stop if stop == n else self._shared(word, stop, base, last)
            out = []
            while at > base:
                token = last.get(at) or self._last(word, at, base, last)
                if not token:
                    raise ValueError("a symbol has no token")
                out.append(token)
                at -= len(token) if at < n else len(token) - len(END)
            if out:
                yield from reversed(out)
                base = stop if stop == n else base + sum(map(len, out))
                last = {base: out[0]}

    def _last(self, word: str, at: int, base: int, last: dict[int, str]) -> str:
        """The last token of the encoding of a word up to a place; empty if that encoding does not pass the window's base."""
        whole, known = self.vocabulary.whole, self._known
        text = word[:at] if at < len(word) else word + END
        for place in range(max(base, at - self.lookahead), at):
            token = text[place:]
            if token in whole:
                before = last.get(place)
                if before is None:
                    before = self._last(word, place, base, last)
                if before and (before is _START or known.get((before, token)) or self.fits(before, token)):
                    last[at] = token
                    return token
        last[at] = ""
        return ""

    def _shared(self, word: str, stop: int, base: int, last: dict[int, str]) -> int:
        """The last place that the paths to all live places share: later symbols change nothing before it."""
        paths = {stop, *(p for p in range(max(base, stop - self.lookahead), stop) if word[p:stop] in self.vocabulary.heads)}
        while len(paths) > 1:
            high = max(paths)
            paths.discard(high)
            token = last.get(high) or self._last(word, high, base, last)
            if token:
                paths.add(high - len(token))
        return paths.pop()


class Entry(NamedTuple):
    """What a piece of text becomes: token count, ids as text, decoded tokens as text."""

    count: int
    ids: str
    decoded: str


class Codec:
    """Whole texts to ids and back."""

    def __init__(self, vocabulary: Vocabulary, script: Script, words: int = _WORDS) -> None:
        self.vocabulary = vocabulary
        self.most = words
        self.transducer = Transducer(vocabulary, _PAIRS * words)
        self.letters = byte_letters()
        self.token_of = {i: t for t, i in vocabulary.ids.items()} | {i: t for t, i in vocabulary.special.items()}
        self.spellings = {i: t.encode() for i, t in self.token_of.items()}
        self.numbers = {t: str(i) for t, i in vocabulary.ids.items()}
        self.spelled = Decoder(self)
        self.pieces, self.latin = piece_pattern(script), piece_pattern(script, 0x250)
        self.later, self.lower = script.later, script.lower
        self.odd = min("Σ", *self.later, *map(chr, self.lower))  # below it, texts need nothing of these
        self.specials = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(vocabulary.special, key=len, reverse=True)) + ")") if vocabulary.special else None
        self.pieces_seen: dict[str, Entry] = {}  # two generations: what is used stays, memory is bounded
        self.older: dict[str, Entry] = {}

    def split(self, text: str) -> list[str]:
        """The pieces that merges stay within; white space is between them."""
        return (self.latin if max(text, default="") < "\u0250" else self.pieces).findall(text)

    def folded(self, text: str) -> str:
        """Composed and in lower case, letter by letter."""
        if text.isascii():
            return text.lower()
        if max(text) < self.odd:
            return unicodedata.normalize("NFC", text).lower()
        if self.later.isdisjoint(text):
            text = unicodedata.normalize("NFC", text)
        else:
            from tokenizers import normalizers

            text = normalizers.NFC().normalize_str(text)
        return text.replace("Σ", "σ").translate(self.lower).lower()

    def remember(self, text: str, found: Entry) -> Entry:
        if len(text) < 100:
            if len(self.pieces_seen) >= self.most:
                self.older, self.pieces_seen = self.pieces_seen, {}
            self.pieces_seen[text] = found
        return found

    def piece(self, piece: str) -> Entry:
        """The entry of a piece of the split pattern."""
        found = self.older.get(piece)
        if found is None:
            spelled = piece if _PLAIN.fullmatch(piece) else "".join([self.letters[b] for b in piece.encode("utf-8")])
            tokens = list(self.transducer.encode(spelled))
            ids, numbers = self.vocabulary.ids, self.numbers
            # No byte is pending where a piece ends, so the decoder may start anew.
            found = Entry(len(tokens), " ".join([numbers[t] for t in tokens]), self.spelled.feed([ids[t] for t in tokens]) + self.spelled.close())
        return self.remember(piece, found)

    def entry(self, word: str) -> Entry:
        """The entry of a text without white space."""
        if word.isalpha():
            return self.piece(word)
        last = word[-1:]
        if last in _MARKS and word[:-1].isalpha():
            body = word[:-1]
            a, b = self.pieces_seen.get(body) or self.piece(body), self.pieces_seen.get(last) or self.piece(last)
            return Entry(a[0] + b[0], f"{a[1]} {b[1]}", f"{a[2]} {b[2]}")
        parts = [self.pieces_seen.get(p) or self.piece(p) for p in self.split(word)]
        if len(parts) == 1:
            return parts[0]
        return self.remember(word, Entry(sum([e[0] for e in parts]), " ".join([e[1] for e in parts]), " ".join([e[2] for e in parts])))

    def entries(self, text: str) -> Iterator[list[Entry]]:
        """The entries of a text's words and special tokens, in order, some thousands at once."""
        special = self.vocabulary.special
        for part in self.specials.split(text) if any(t in text for t in special) else (text,):
            if part in special:
                i = special[part]
                yield [Entry(1, str(i), self.token_of[i])]
                continue
            flat = self.folded(part)
            if not _TIED.search(flat):  # set single marks apart: they are pieces of their own, as the words before them
                flat = flat.replace(", ", " , ").replace(". ", " . ").replace(",\n", " ,\n").replace(".\n", " .\n")
            words = self.split(flat) if _ODD_SPACE.search(flat) else flat.split()
            for at in range(0, len(words), _BLOCK):
                seen, entry = self.pieces_seen.get, self.entry  # the table of the block's beginning
                yield [seen(w) or entry(w) for w in words[at : at + _BLOCK]]

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for block in self.entries(text or "") for e in block for i in e.ids.split()]

    def decode(self, ids: Iterable[int], plain: bool = False) -> str:
        """The text of some ids, through the state machine."""
        decoder = Decoder(self, plain)
        return decoder.feed(ids) + decoder.close()

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """(tokens, sha256 of the ids joined by a space, sha256 of the decoded text)."""
        n, one, two = 0, hashlib.sha256(), hashlib.sha256()
        for block in self.entries(text or ""):
            lead = " " if n else ""
            counts, ids, decoded = zip(*block, strict=True)
            one.update((lead + " ".join(ids)).encode())
            two.update((lead + " ".join(decoded)).encode())
            n += sum(counts)
        return n, one.hexdigest(), two.hexdigest()


class Decoder:
    """Ids to text as they come: a state machine over bytes.

    Its state is the bytes of an unfinished character, and whether a space is due
    before the next token. Spelled (the default), tokens are joined by a space;
    plain, byte letters turn into their bytes and an end mark into a space, and a
    broken sequence becomes U+FFFD.
    """

    def __init__(self, codec: Codec, plain: bool = False) -> None:
        self._codec, self._plain = codec, plain
        self._byte = {c: b for b, c in enumerate(codec.letters)} if plain else {}
        self._text = codecs.getincrementaldecoder("utf-8")("replace")
        self._due = b""

    def feed(self, ids: Iterable[int]) -> str:
        """The text that some more ids complete."""
        if not self._plain:
            spelled = [self._codec.spellings[i] for i in ids]
            if not spelled:
                return ""
            lead, self._due = self._due, b" "
            return self._text.decode(lead + b" ".join(spelled))
        return "".join(map(self._plainly, ids))

    def _plainly(self, i: int) -> str:
        token, lead = self._codec.token_of[i], self._due
        if token in self._codec.vocabulary.special:
            self._due = b" "
            return self._text.decode(b"", True) + self._text.decode(lead + self._codec.spellings[i])
        ends = token.endswith(END) and token != END
        self._due = b" " if ends else b""
        raw = bytes(self._byte[c] for c in (token[: -len(END)] if ends else token))
        return self._text.decode(lead + raw, ends)

    def close(self) -> str:
        """What is pending at the end, the rest of a broken character; the next text starts anew."""
        self._due = b""
        return self._text.decode(b"", True)


def _mapped(docs: DataFrame, vocabulary: str | None, schema: str, words: int, make: Callable[[Codec, str | None], tuple], types: list[pa.DataType]) -> DataFrame:
    """doc_id and what ``make`` gives for the text of every row."""
    held, script = Vocabulary.read(vocabulary or default_vocabulary()), library_script()

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(held, script, words)
        names = ["doc_id", *(x.split()[0] for x in schema.split(", "))]
        before, result = None, make(codec, None)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = []
                for text in part.column(1):
                    text = text.as_py()
                    if text != before:
                        before, result = text, make(codec, text)
                    rows.append(result)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))], names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + schema)


def token_digests(docs: DataFrame, vocabulary: str | None = None, words: int = _WORDS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    return _mapped(docs, vocabulary, "n_tokens long, ids_sha256 string, decoded_sha256 string", words, Codec.digests, [pa.int64(), pa.string(), pa.string()])


def encoded_documents(docs: DataFrame, vocabulary: str | None = None, words: int = _WORDS // 4) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every row: the ids, and a digest of what they decode to.

    The lists of ids take memory beside the codec, so it remembers fewer pieces here.
    """

    def make(codec: Codec, text: str | None) -> tuple:
        ids = codec.encode(text)
        return len(ids), ids, hashlib.sha256(codec.decode(ids).encode()).hexdigest()

    return _mapped(docs, vocabulary, "n_tokens long, ids array<int>, decoded_sha256 string", words, make, [pa.int64(), pa.list_(pa.int32()), pa.string()])


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


QUERIES = {"op7_bpe": op7_bpe}
ORACLES: dict[str, str] = {}

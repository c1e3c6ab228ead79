import hashlib
import itertools
import json
from collections import Counter

import pytest

from brooklet.llm import alignment

ODD = [
    "", None, " ", "   ", "a  b", "a\n  b", "a \nb", "  x", "x  ", "\n", "a <|endoftext|> b", "a▁b", "a▁ b", "ﬁ ½ Å", "x y  z",
    "a \x1c b", "\x00a", "日本語 テスト \U0001f600", "it's  we'll  ''s", "<0x41> <s> </s>", " ​", "a\r\n\r\n b\t\tc \t d", "x" * 700, "don 't 's", "a　b\u0085 d",
]
PLAIN = ["The quick brown fox, it said, jumps!", "over 1,234 lazy dogs...", "The quick brown fox, it said, jumps!", "naïve café the the the"]


@pytest.fixture(scope="module")
def files():
    return alignment._files(None, None)


@pytest.fixture(scope="module")
def aligner(files):
    return alignment.Aligner(*files)


@pytest.fixture(scope="module")
def library(files):
    """Token ids and bytes of a spaced text by the libraries, by the plain definition."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(files[0].decode())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=files[1])
    letters = alignment.byte_letters()
    tokens = {i: t for t, i in json.loads(files[0])["model"]["vocab"].items()}

    def of_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def tokenized(text):
        if not text:
            return None
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        spelled = [bytes(letters[c] for c in tokens[i]) for i in ids[0]], [of_b(i) for i in ids[1]]
        return (*ids, *spelled) if all(b"".join(s) == (" " + text).encode() for s in spelled) else None

    return tokenized


def brute(found):
    """(n_a, n_b, groups text, pairs of ids of all links)."""
    if found is None:
        return 0, 0, "", []
    a, b, of_a, of_b = found
    ends_a, ends_b = ([0, *itertools.accumulate(map(len, x))] for x in (of_a, of_b))
    cuts = sorted(set(ends_a) & set(ends_b))
    groups = [
        ",".join(str(i) for i, e in zip(a, ends_a[1:], strict=True) if lo < e <= hi) + "|" + ",".join(str(i) for i, e in zip(b, ends_b[1:], strict=True) if lo < e <= hi)
        for lo, hi in itertools.pairwise(cuts)
    ]
    pairs = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if ends_a[i] < ends_b[j + 1] and ends_b[j] < ends_a[i + 1]]
    return len(a), len(b), ";".join(groups), pairs


def packed(pairs):
    return [x << 32 | y for x, y in pairs]


@pytest.mark.parametrize("chunk", [1, 40, 1 << 16])
def test_alignments_equal_the_libraries(aligner, library, monkeypatch, chunk):
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    words = alignment.Words(aligner, most=12)  # forgets all the time
    texts = [*PLAIN, *ODD, "\n".join(PLAIN), " ".join(PLAIN * 3)]
    for text, facts in [(t, f) for k in range(0, len(texts), 5) for t, f in zip(texts[k : k + 5], words.facts(texts[k : k + 5]), strict=True)]:
        n_a, n_b, groups, pairs = brute(library(text))
        x = aligner.align(text)
        if not n_a:
            assert facts is None and x is None
            continue
        assert (facts.n_a, facts.n_b, facts.n_groups, facts.n_links, facts.groups) == (n_a, n_b, groups.count(";") + 1, len(pairs), groups), text
        assert facts.pairs.tolist() == packed(pairs) == x.pairs().tolist() and aligner.groups_text(x) == groups


def test_report_equals_brute_force(spark, docs, library):
    rows = list(enumerate([*PLAIN, *ODD, *PLAIN[:2]])) + [(None, "The lazy dogs"), (3, "another text of id 3"), (3, "another text of id 3")]
    found = [(i, brute(library(t))) for i, t in rows]
    held = Counter(p for _, x in found for p in set(x[3]))
    top = {}
    for (a, _), n in held.items():
        top[a] = max(top.get(a, 0), n)
    want = [
        (i, n_a, n_b, g.count(";") + 1 if n_a else 0, len(p), sum(held[x] == top[x[0]] for x in p), sum(held[x] for x in p), hashlib.sha256(g.encode()).hexdigest() if n_a else "")
        for i, (n_a, n_b, g, p) in found
    ]
    frame = docs(rows, extra=["pairs", "block", "found", "A.b"]).repartition(3)
    for size in (1, 300, alignment.BLOCK):
        got = alignment.alignment_report(frame, size=size).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)), size


def test_documents_carry_their_tokens(spark, docs, library):
    got = {r.doc_id: r for r in alignment.aligned_documents(docs(list(enumerate([*PLAIN, *ODD])))).collect()}
    for i, text in enumerate([*PLAIN, *ODD]):
        found, r = library(text), got[i]
        assert (r.a_ids, r.b_ids) == ((found[0], found[1]) if found else ([], []))
        assert [(r.a_ids[x], r.b_ids[y]) for x, y in zip(r.link_a, r.link_b, strict=True)] == brute(found)[3]


def test_empty_table(spark, docs):
    assert alignment.alignment_report(docs([])).collect() == []


def test_blocks_are_written_in_small_row_groups(spark, docs, monkeypatch):
    """A task that writes or reads blocks holds a row group of them: many blocks of one task need many groups."""
    from pathlib import Path

    import pyarrow.parquet as pq

    made, plain = {}, alignment.written
    monkeypatch.setattr(alignment, "written", lambda df, name, *more: made.setdefault(name, plain(df, name, *more)))
    monkeypatch.setattr(alignment, "GROUP", 1 << 14, raising=False)
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(400))) for i in range(40)]
    alignment.alignment_report(docs(rows).coalesce(1), size=2048).count()
    (file,) = Path(made["blocks"].scratch_path).glob("*.parquet")
    held = pq.ParquetFile(file).metadata
    assert held.num_rows == 40 and held.num_row_groups > 5

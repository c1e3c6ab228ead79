import hashlib
import random

import pytest

from brooklet.llm import bpe

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.Vocabulary.read(bpe.default_vocabulary()), bpe.library_script())


TEXTS = [
    "", " ", "it's we'll I'd 're don't'd'", "<|endoftext|>abc <|startoftext|>", "a<|endoftext|", "ΑΣ Σ ΟΔΟΣ", "İstanbul ǅ", "a\x1cb \x85c\xa0d​e",
    "é é", "a" * 3000, "ab" * 1500, "!" * 1500, "1234 ٣²Ⅷ", "日本語 テスト", "👩‍👩‍👧 x", "<|ENDOFTEXT|>", "x" * 100 + "</w>", "\n\t a　b",
]


def want(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", TEXTS)
def test_equals_the_library(library, codec, text):
    ids, decoded = want(library, text)
    assert codec.encode(text) == ids and codec.decode(ids) == decoded
    assert codec.digests(text) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_random_texts(library, codec):
    rng = random.Random(1)
    parts = ["abcdefghij", "  \n\t'stdrevm", "ABC ÉßıİΣσς", "0123٣²", "!?.,-_'\"", "日本語ﬁ한글", "àéîöüñ çœ"]
    for _ in range(800):
        text = "".join(rng.choice(rng.choice(parts)) for _ in range(rng.choice([3, 8, 40])))
        assert codec.encode(text) == want(library, text)[0], repr(text)


def test_every_code_point(library, codec):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 4096):
        text = " ".join(f"a{chr(c)}{chr(c)}" for c in points[at : at + 4096])
        ids = library.encode(text, add_special_tokens=False).ids
        if codec.encode(text) != ids:
            for c in points[at : at + 4096]:
                assert codec.encode(f"a{chr(c)}{chr(c)}") == want(library, f"a{chr(c)}{chr(c)}")[0], hex(c)


def test_composition_of_later_characters(library, codec):
    rng = random.Random(3)
    later = [c for c in codec.later if library.normalizer.normalize_str("x" + c + "\u0334") != "x" + c + "\u0334"] + rng.sample(sorted(codec.later), 200)
    for _ in range(500):
        text = "".join(rng.choice([rng.choice(later), rng.choice("ab \u0300\u0334É")]) for _ in range(12))
        assert codec.encode(text) == want(library, text)[0], ascii(text)


def test_the_transducer_agrees_with_merging(codec, monkeypatch):
    rng, t = random.Random(2), codec.transducer
    for window in (2, 4):
        monkeypatch.setattr(bpe, "WINDOW", window)
        for n in (1, 2, 5, 30, 63, 64, 65, 129, 200, 700):
            for alphabet in ("ab", "aeinrst", "abcdefghijklmnopqrstuvwxyz", "a"):
                word = "".join(rng.choice(alphabet) for _ in range(n))
                assert list(t.encode(word)) == bpe.merge(bpe.symbols(word + bpe.END), codec.vocabulary.ranks)


def test_the_lookahead_comes_from_the_merges(codec):
    ranks = {("a", "b"): 0, ("c", "d</w>"): 1, ("ab", "ab"): 2, ("abab", "cd</w>"): 3}
    assert bpe.sufficient_lookahead(ranks) == 6 and bpe.sufficient_lookahead({}) == 1
    assert codec.transducer.lookahead == max(len(bpe.symbols(a + b)) for a, b in codec.vocabulary.ranks)


def test_the_transducer_keeps_a_bounded_window(codec):
    t = codec.transducer
    tokens = t.encode("abracadabra" * 300)
    seen = 0
    for token in tokens:  # tokens come out long before the word ends
        seen += len(token)
        held = tokens.gi_frame.f_locals
        assert held["stop"] - held["base"] <= (bpe.WINDOW + 2) * t.lookahead and held["stop"] - seen <= (bpe.WINDOW + 2) * t.lookahead


def test_plain_text_of_ids(codec):
    ids = codec.encode("Héllo wörld, 日本 😀!<|endoftext|>x")
    decoder = bpe.Decoder(codec, plain=True)
    assert "".join(decoder.feed([i]) for i in ids) + decoder.close() == codec.decode(ids, plain=True) == "héllo wörld , 日本 😀! <|endoftext|> x"


def test_decoding_in_any_portions(library, codec):
    rng = random.Random(5)
    ids = codec.encode("Héllo wörld, 日本 😀! " * 9)
    for _ in range(20):
        decoder, out, at = bpe.Decoder(codec), "", 0
        while at < len(ids):
            size = rng.randrange(0, 9)
            out, at = out + decoder.feed(ids[at : at + size]), at + size
        assert out + decoder.close() == library.decode(ids, skip_special_tokens=False)


def test_a_broken_character_becomes_a_mark(codec):
    half = codec.vocabulary.ids[codec.letters["é".encode()[0]]]
    assert codec.decode([half], plain=True) == "\ufffd"


def test_caches_are_bounded(codec):
    small = bpe.Codec(codec.vocabulary, bpe.library_script(), words=10)
    text = " ".join(f"word{k}x" for k in range(100)) * 2
    assert small.encode(text) == codec.encode(text) and len(small.pieces_seen) <= 11 and len(small.transducer._known) <= 20


def test_rows(spark, docs, library):
    rows = [(1, None), (2, ""), (3, "Hello there"), (3, "Hello there"), (None, "x" * 50_000), (4, "a b " * 20_000)]
    out = bpe.token_digests(docs(rows, extra=["ids", "n_tokens"])).collect()
    assert len(out) == 6
    by = {(r.doc_id, r.n_tokens) for r in out}
    assert by == {(i, len(want(library, t or "")[0])) for i, t in rows}
    full = bpe.encoded_documents(docs(rows)).where("doc_id = 3").first()
    assert list(full.ids) == want(library, "Hello there")[0]
    assert bpe.token_digests(docs([])).count() == 0

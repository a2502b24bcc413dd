import hashlib

import pytest

from aerolith.llm import bpe as B

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")
TEXTS = ["", "   ", "aaaa aaaaaaa aaaaaaaaaaaaaaaa", "ΣΑΣ Σ ΟΔΟΣ. İstanbul", "Don't I'LL we've <|endoftext|> x<|startoftext|>y <|endoftext|", "日本語 テキスト 😀😀 é ﬁ ① ½ x\x1cy a\x85b ​", "1234 !!!??? 'sss 're'", "\x00\x01 \x1d\x1e", "ǅ ß ẞ Ⅷ ᾼ", "é café", "word " * 20_000, "x" * 5000]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_as_the_library_does(library, small):
    ours = B.WordBPE(PATH)
    texts = TEXTS + [t for _, t, _, _ in small]
    for text, (n, ids, decoded) in zip(texts, ours.digests(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)), text[:80]
        assert n == len(want) and decoded == library.decode(want, skip_special_tokens=False)


def test_encode_and_decode(library):
    ours = B.WordBPE(PATH)
    assert ours.encode("Hello there") == library.encode("Hello there", add_special_tokens=False).ids
    assert ours.decode(ours.encode("Hello there")) == library.decode(ours.encode("Hello there"), skip_special_tokens=False)


def test_forgetting_changes_nothing(monkeypatch):
    ours = B.WordBPE(PATH)
    want = list(ours.digests(TEXTS))
    monkeypatch.setattr(B, "CACHE_WORDS", 1)
    assert [next(iter(ours.digests([t]))) for t in TEXTS] == want


def test_operator(docs, with_clashes):
    df = with_clashes(docs((1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "c")))
    rows = B.encode_digests(df, PATH).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == 5 and {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows if r.doc_id in (2, 3)} == {(0, empty, empty)}
    full = {r.doc_id: r for r in B.encode(df, PATH).collect()}
    assert full[1].decoded == "a</w> b</w>" and full[2].ids == []
    assert B.encode_digests(df.limit(0), PATH).count() == 0

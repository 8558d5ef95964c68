"""The codec against the sentencepiece library, token for token."""

import hashlib
import random

import pytest

sentencepiece = pytest.importorskip("sentencepiece")

from sparkrec.llm import sentencepiece_bpe as M  # noqa: E402
from sparkrec.llm.queries import piece_model  # noqa: E402


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


@pytest.fixture(scope="module")
def codec():
    return M.Codec(M.load_pieces(piece_model()))


HARD = ["", " ", "  a  b ", "a\n b\t\tc", "ﬁ é é １", " ▁x", "　x", "x\0y", "<s> </s> <unk> <0x0A>", "퟿😀", "\r\n", "tail   ",
        "². m². x²y 3rd", "word" * 3000, " " * 3000, "\n" * 2000, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaab" * 50, "ЖЖ中文 mixed 123,456.78"]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(codec, library, text):
    ids = library.encode(text)
    assert codec.encode(text) == ids
    assert codec.decode(ids) == library.decode(ids)
    n, joined, back = codec.digest(text)
    assert (n, joined, back) == (len(ids), ",".join(map(str, ids)), library.decode(ids))


def test_random_texts_and_ids(codec, library):
    r = random.Random(5)
    alphabet = [" ", "▁", "\n", "\t", "a", "b", "é", "😀", "́", "中", ".", "0", "<", "the", " the", "    ", "ing", "퟿", "\r", "(){", "=", "\0", "�", "²"]
    for _ in range(3000):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 30)))
        ids = library.encode(text)
        assert codec.encode(text) == ids, text
        assert codec.digest(text)[2] == library.decode(ids), text
    for _ in range(3000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), 259]) for _ in range(r.randint(0, 8))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_pairs_decide_the_sequence(codec):
    """Every neighbouring pair of a result is compatible, and the whole equals plain merging."""
    for word in ("▁unbelievable", "▁▁▁▁▁▁▁internationalization", "▁thonndonererthst"):
        t = codec.tokens(word)
        assert t == codec.merged(word)
        assert all(codec.compatible(a, b) for a, b in zip(["", *t], t))


def test_query_rows(spark, make_docs, library):
    rows = [(3, None), (4, ""), (5, "Hello  world.\nfoo"), (5, "Hello  world.\nfoo"), (None, "x" * 5000), (7, "é" * 100_000)]
    got = sorted(M.round_trip(make_docs(rows), piece_model()).collect(), key=str)
    want = []
    for d, t in rows:
        ids = library.encode(t or "")
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str(tuple(x)) for x in got)
    assert M.round_trip(make_docs([]), piece_model()).count() == 0


def test_tables_round_trip(make_docs):
    texts = ["one two", " lead", "", None, "ünï\ncode 😀"]
    docs = make_docs(texts)
    back = M.decode_documents(M.encode_documents(docs, piece_model()), piece_model())
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_vocabularies_that_differ_in_one_score_have_codecs_of_their_own():
    vocab = M.load_pieces(piece_model())
    at = len(vocab["scores"]) // 2
    other = {**vocab, "scores": [x - (i == at) for i, x in enumerate(vocab["scores"])]}
    assert M.codec(vocab) is M.codec(vocab) and M.codec(other) is not M.codec(vocab)

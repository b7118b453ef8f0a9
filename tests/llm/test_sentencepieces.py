import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from convoloom.llm import sentencepieces as P
from convoloom.llm.queries import tokenizer_file

from .helpers import EDGES, edge_docs, empty_docs

spm = pytest.importorskip("sentencepiece")
FILE = tokenizer_file("piece_bpe_32k.model")
LIBRARY, OURS = spm.SentencePieceProcessor(model_file=FILE), P.PieceCoder(FILE)


def test_cases():
    texts = ["", " ", "Hello  world \n  x ", " a", "a\tb\r\n", "é　x\xa0y ﬁ ①", "▁ab", "<s> hi <unk>", "a" * 500, "日本語 😀", "    x", "\x00 z"]
    ids = OURS.encode_batch(texts)
    assert ids == [LIBRARY.encode(t) for t in texts]
    assert [OURS.decode(x) for x in ids] == [LIBRARY.decode(x) for x in ids]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.text(alphabet="abcdeinorst é", max_size=60)), max_size=10))
def test_random(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids = OURS.encode_batch(texts)
    assert ids == [LIBRARY.encode(t) for t in texts]
    assert all(OURS.decode(x) == t for x, t in zip(ids, texts, strict=True) if P.MARK not in t)


def test_unigram_forward_scores():
    """With unigram scores the shared-prefix pass finds the best segmentation of every word."""
    rng = random.Random(5)
    c = P.PieceCoder.__new__(P.PieceCoder)
    pieces = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(30)} | set("ab"))
    c.kind, c.ids, c.score, c.longest = P.UNIGRAM, {p: i for i, p in enumerate(pieces)}, [-rng.random() * 5 - 1 for _ in pieces], 4
    c.least, c.pairs, c.local, c.names = min(c.score) - P.UNKNOWN_PENALTY, {}, dict(c.ids), {i: p for p, i in c.ids.items()}
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 8))) for _ in range(200)})

    def total(parts):
        return sum(c.score[c.ids[p]] if p in c.ids else c.least for p in parts)

    for w, found in zip(words, c._forward(words), strict=True):
        got = [c.names[i] for i in found]
        assert "".join(got) == w
        best = max(total([w[a:b] for a, b in itertools.pairwise((0, *cut, len(w)))]) for k in range(len(w)) for cut in itertools.combinations(range(1, len(w)), k) if all(w[a:b] in c.ids or b - a == 1 for a, b in itertools.pairwise((0, *cut, len(w)))))
        assert abs(total(got) - best) < 1e-9


def test_edges(spark):
    got = P.encode_pieces(edge_docs(spark), FILE)
    rows = got.collect()
    assert sorted((str(r.doc_id), r.ids) for r in rows) == sorted((str(i), LIBRARY.encode(t or "")) for i, t, _ in EDGES)
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in rows)
    back = P.decode_pieces(got, FILE).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t, _ in EDGES)
    assert P.encode_pieces(empty_docs(spark), FILE).count() == 0

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from convoloom.llm.queries import tokenizer_file
from convoloom.llm.token_counts import RankMerger, count_tokens

from .helpers import EDGES, edge_docs, empty_docs

tokenizers = pytest.importorskip("tokenizers")
FILE = tokenizer_file("byte_bpe_50k.json")
LIBRARY, OURS = tokenizers.Tokenizer.from_file(FILE), RankMerger(FILE)


def library(t):
    return len(LIBRARY.encode(t or "", add_special_tokens=False).ids)


def test_cases():
    texts = ["", " ", "  a  b ", "it's we'll I'D", "a\n\n b\t\tc \r\n", "aaaaaaaaaaaaaaaaaaaaaaa", "x<|endoftext|>y <|endoftext|>", "日本語 😀　z\xa0q", "１２３ ⅷ ½", "\x00\x1c\x85 a", "ab" * 5000]
    assert OURS.count(texts) == [library(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="aeth 's\n\t1é<|>", max_size=60)), max_size=8))
def test_random(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert OURS.count(texts) == [library(t) for t in texts]


def test_edges(spark):
    got = count_tokens(edge_docs(spark), FILE).collect()
    want = sorted((str(i), len((t or "").encode()), library(t), library(t) > 1024) for i, t, _ in EDGES)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert count_tokens(empty_docs(spark), FILE).count() == 0

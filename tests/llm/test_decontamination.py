import random

from hypothesis import given, settings
from hypothesis import strategies as st

from convoloom.llm import decontamination as D

from .helpers import edge_docs, empty_docs


def distance(item, text):
    """Least edits of the item to any part of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc", min_size=1, max_size=40), st.text(alphabet="abc", max_size=80))
def test_myers(item, text):
    edits, end = D.myers(D.masks(item), len(item), text)
    assert edits == distance(item, text)
    assert distance(item, text[:end]) == edits


def edited(item, k, rng):
    x = list(item)
    for _ in range(k):
        at = rng.randrange(len(x))
        match rng.randrange(3):
            case 0:
                x[at] = "Q"
            case 1:
                x.insert(at, "Q")
            case _:
                del x[at]
    return "".join(x)


def test_nothing_missed():
    rng = random.Random(3)
    items = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(5, 120)))) for i in range(20)]
    m = D.Matcher(items)
    for n in range(150):
        parts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 60)))]
        for i in rng.sample(range(20), 2):
            parts += [edited(items[i][1], rng.randint(0, int(len(items[i][1]) * 0.1) + 1), rng), "".join(rng.choice("abcdefgh ") for _ in range(10))]
        text = "".join(parts)
        want = {i: distance(t, text) for i, t in items}
        assert {x[0]: x[1] for x in m.find(text)} == {i: d for i, d in want.items() if d <= int(len(items[i][1]) * D.EDIT_RATE)}, n


ITEM = "the quick brown fox jumps over the lazy dog and then it sleeps for a while in the sun"


def _items(spark):
    return spark.createDataFrame([(1, ITEM), (2, ITEM), (3, None), (4, ""), (None, "another benchmark item that is long enough to matter")], "item_id long, text string")


def test_blocks_and_edges(spark, monkeypatch):
    rows = [(1, "xx " + ITEM.replace("quick", "quack") + " yy", "en"), (2, "nothing", "en"), (3, None, "en"), (3, "another benchmark item that is long enough to matter", "en"), (3, "another benchmark item that is long enough to matter", "en")]
    docs = edge_docs(spark, rows)
    for size in (D.BLOCK_BYTES, 40):
        monkeypatch.setattr(D, "BLOCK_BYTES", size)
        got = sorted((r.doc_id, str(r.item_id), r.edits, r.start, r.end) for r in D.benchmark_matches(docs, _items(spark)).collect())
        assert got == [(1, "1", 1, 3, 3 + len(ITEM)), (1, "2", 1, 3, 3 + len(ITEM)), (3, "None", 0, 0, 52), (3, "None", 0, 0, 52)]
        kept = D.drop_contaminated(docs, _items(spark))
        assert kept.columns == docs.columns and sorted((r.doc_id, str(r.text)) for r in kept.collect()) == [(2, "nothing"), (3, "None")]
    assert D.benchmark_matches(empty_docs(spark), _items(spark)).count() == 0
    assert D.benchmark_matches(docs, _items(spark).limit(0)).count() == 0
    assert D.benchmark_matches(edge_docs(spark), _items(spark)).count() == 0
    assert D.drop_contaminated(edge_docs(spark), _items(spark).limit(0)).count() == edge_docs(spark).count()


def test_items_go_by_text_and_not_by_id(spark, monkeypatch):
    a, b = "the first benchmark item with quite some words in it", "a second one that says something entirely different now"
    docs = edge_docs(spark, [(1, f"x {a} y", "en"), (2, f"{b}!", "en"), (2, f"{b}!", "en")])
    for size in (D.BLOCK_BYTES, 40):
        monkeypatch.setattr(D, "BLOCK_BYTES", size)
        for ids, want in (((5, 5), [(1, "5"), (2, "5"), (2, "5")]), ((None, -1), [(1, "None"), (2, "-1"), (2, "-1")])):
            items = spark.createDataFrame([(ids[0], a), (ids[1], b), (ids[0], a)], "item_id long, text string")
            assert sorted((r.doc_id, str(r.item_id)) for r in D.benchmark_matches(docs, items).collect()) == want

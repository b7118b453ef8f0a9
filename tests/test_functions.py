import json
import math
import time

from pyspark.sql import functions as F

from convoloom.config import Params
from convoloom.functions import json_text as J
from convoloom.functions import text as T
from convoloom.functions import vectors as V


def one(spark, col, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'array<double>' if isinstance(v, list) else 'string'}" for k, v in values.items()))
    return df.select(col.alias("x")).first()["x"]


def test_cosines(spark):
    cases = [([1.0, 0.0], [1.0, 0.0], 1, 1, 1), ([1.0, 0.0], [-1.0, 0.0], -1, -1, 0), ([0.0, 0.0], [1.0, 0.0], 0, 0, 0), ([1.0], [1.0, 0.0], None, 0, 0), ([3.0, 4.0], [4.0, 3.0], 0.96, 0.96, 0.96)]
    for a, b, plain, graph, clamped in cases:
        for f, want in ((V.cosine_plain, plain), (V.cosine_graph, graph), (V.cosine_clamped, clamped)):
            got = one(spark, f("a", "b"), a=a, b=b)
            assert got is want if want is None else math.isclose(got, want, abs_tol=1e-12)
    assert one(spark, V.has_embedding("a"), a=[0.0]) and not one(spark, V.usable_embedding("a"), a=[0.0])
    assert not one(spark, V.has_embedding("a"), a=[])


def test_tool_call_predicate(spark):
    cases = {
        '{"name":"a","arguments":{}}': True, '{"name":"a"}': True, '{"name":" "}': False, '{"name":1}': False, '{"name":"a","arguments":"x"}': False,
        '{"name":"a","arguments":null}': False, "[1]": False, "x": False, "": False, '{"arguments":{}}': False,
    }
    for s, want in cases.items():
        assert one(spark, J.is_tool_call(F.col("s")), s=s) is want, s


def test_detect_and_extract(spark):
    call = '{"name":"a","arguments":{"x":1}}'
    fence, bare = f"t ```json\n{call}\n``` u", f"t ```\n{call}\n``` u"
    for s in (call, f"say {call} now", fence, bare, '{\n "name": "a"\n}'):
        assert one(spark, J.contains_tool_call(F.col("s")), s=s)
        assert [json.loads(c)["name"] for c in one(spark, J.extract_tool_calls(F.col("s")), s=s)] == ["a"], s
    for s in ("plain", "{broken", '{"name":"a","arguments":[1]}', None):
        assert not one(spark, J.contains_tool_call(F.col("s")), s=s)
    two = '```json\n[{"name":"a","arguments":{}},{"name":"b","arguments":{}}]\n``` and ```json\n{"name":"c"}\n```'
    assert [json.loads(c)["name"] for c in one(spark, J.extract_tool_calls(F.col("s")), s=two)] == ["a", "b", "c"]
    # Nesting over one level is found in a fence only.
    deep = '{"name":"a","arguments":{"x":{"y":{"z":1}}}}'
    assert not one(spark, J.contains_tool_call(F.col("s")), s=f"say {deep} now") and one(spark, J.contains_tool_call(F.col("s")), s=f"```json {deep} ```")


def test_parse_llm_json(spark):
    f = J.parse_llm_json(F.col("s"))
    assert one(spark, f, s='{"a":1}') == '{"a":1}'
    assert one(spark, f, s='x ```json\n{"a":1}\n``` y') == '{"a":1}'
    assert one(spark, f, s='x ```\n[1]\n``` y') == "[1]"
    assert one(spark, f, s='x ```json\n{"a":1} y') is None and one(spark, f, s="prose") is None


def test_one_json():
    assert J.one_json('x {"a":"}"} y') == '{"a":"}"}'
    assert J.one_json(r'x {"a":"\"}"} y') == r'{"a":"\"}"}'
    assert J.one_json('x {"a":1} {"name":"b"} y') == '{"name":"b"}'
    assert J.one_json('} {"a":1}') == '{"a":1}' and J.one_json('it"s {"a":1}') == '{"a":1}' and J.one_json('{x {"a":1}') == '{"a":1}'
    assert J.one_json("  none here ") == "none here" and J.one_json("") == "" and J.one_json(None) is None
    assert J.one_json('```json\n{bad}\n``` ```\n{"a":1}\n```') == '{"a":1}'
    assert J.one_json('{"a": {"b": {"c": 1}}} tail') == '{"a": {"b": {"c": 1}}}'


def test_content_id(spark):
    import hashlib

    fields = {"b": 'é "q" \\', "a": "x"}
    want = "p_" + hashlib.md5(json.dumps(fields, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:8]
    assert one(spark, T.content_id("p", {"b": F.col("b"), "a": F.col("a")}), **fields) == want
    assert one(spark, T.content_id("", {"a": F.col("a"), "b": F.col("b")}), **fields) == want[2:]


def test_small_helpers(spark):
    assert T.byte_size("10MB") == 10 * 1024**2 and T.byte_size("5") == 5 and T.byte_size("1.5kb") == 1536
    assert one(spark, T.token_estimate(F.col("s")), s=" a  b\nc ") == 3 * 1.3 and one(spark, T.token_estimate(F.col("s")), s="") == 0
    assert one(spark, J.strip(F.col("s")), s="　 a b \xa0\n") == "a b"
    assert one(spark, T.text_similarity("a", "b"), a="ABC", b="abc") == 1.0 and one(spark, T.text_similarity("a", "b"), a="", b="abc") == 0.0
    assert one(spark, T.checkpoint_tools(F.array(F.col("a"), F.col("b"))), a=" find (x)", b="no call") == ["find"]


def test_params(monkeypatch):
    monkeypatch.setenv("CONVOLOOM_MAX_TURNS", "3")
    p = Params.from_env()
    assert p.max_turns == 3 and p.updated(restart=0).restart == 0
    for bad in ({"nope": 1}, {"max_turns": "x"}):
        try:
            p.updated(**bad)
        except (KeyError, TypeError):
            continue
        raise AssertionError(bad)


def test_a_million_braces_take_little_time():
    for text in ("{" * 1_000_000, '{"a":' * 200_000, "{}" * 500_000, '{"a": {' * 100_000 + '"name": 1}', "}" * 1_000_000, '{"' * 500_000, "{" * 500_000 + "}" * 500_000):
        began = time.time()
        J.one_json(text)
        assert time.time() - began < 12, text[:9]


def test_braces_in_and_around_strings():
    assert J.one_json('say { then {"name": "x}", "v": {"w": 1}}') == '{"name": "x}", "v": {"w": 1}}'
    assert J.one_json('it is 5" wide: {"name": "a"} ok') == '{"name": "a"}'
    assert J.one_json('{"open {"name": "a"}') == '{"name": "a"}'
    assert J.one_json('{"x": "\\\\"}"} and {"name": 2}') == '{"name": 2}' and J.one_json('{"x": 1} {bad} {"y": 2}') == '{"x": 1}'
    assert J.one_json("} no { object") == "} no { object" and J.one_json("") == ""

from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from convoloom.config import Params
from convoloom.operators import conversation, filters, generation, graph, joins, provider, records, sampling, similarity, stats, training, walks
from convoloom.operators.components import connected_components


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_score_filters(spark):
    s = frame(spark, [(4.0,), (4.0001,), (None,), (float("nan"),), (3.0,)], "s double")
    assert [r[0] for r in s.select(filters.strict_score(F.col("s"))).collect()] == [False, True, False, False, False]
    assert [r[0] for r in s.select(filters.default_score(F.col("s"), 4.0)).collect()][:3] == [True, True, True]
    assert [r[0] for r in s.select(filters.valid_score(F.col("s"))).collect()] == [True, True, False, False, True]
    v = frame(spark, [("5",), ('"4.5"',), ("true",), ("4.5",), ("null",), ("x",)], "s string")
    assert [r[0] for r in v.select(filters.strict_variant_score(F.try_parse_json("s"), 0.5)).collect()] == [True, False, True, True, False, False]


def test_tool_filter_last_evaluation_wins(spark):
    tools = frame(spark, [(1,), (2,), (3,), (4,)], "id long")
    evals = frame(spark, [(1, 3.99, 0), (1, 4.0, 1), (2, 5.0, 0), (2, 1.0, 1), (3, None, 0)], "id long, overall_score double, pos long")
    assert sorted(r.id for r in filters.filter_tools_by_score(tools, evals, pos_col="pos").collect()) == [1, 3, 4]


def test_validation(spark):
    d = frame(spark, [("n", "123456789", "c"), ("n", "1234567890", "c"), ("n", "ééééééééöö", "c"), ("", "1234567890", "c"), (None, "1234567890", "c")], "n string, d string, c string")
    assert [r[0] for r in d.select(filters.valid_scenario(F.col("n"), F.col("d"), F.col("c"))).collect()] == [False, True, True, False, False]
    p = frame(spark, [("[]",), (None,), ('{"a":1}',), ('[{"name":"","type":"","description":""}]',), ('[{"name":"a","type":"b"}]',), ("[1]",), ("x",)], "p string")
    assert [r[0] for r in p.select(filters.valid_tool(F.lit("n"), F.lit("d"), F.col("p"))).collect()] == [True, True, False, True, False, False, False]


def test_arguments(spark):
    params = [("k", "integer", True), ("f", "number", False), ("s", "string", False)]
    cases = {
        '{"k":1}': None, '{"k":"7"}': None, '{"k":3.9}': None, '{"k":true}': None, '{"k":"3.5"}': "Parameter 'k' should be an integer", '{"k":null}': "Parameter 'k' should be an integer",
        "{}": "Missing required parameters: k", '{"k":1,"f":"2.5e3"}': None, '{"k":1,"f":"x"}': "Parameter 'f' should be a number", '{"k":1,"f":[1]}': "Parameter 'f' should be a number", "bad": "Missing required parameters: k",
    }
    df = frame(spark, list(cases.items()), "a string, want string")
    for r in df.select("a", "want", filters.check_arguments(F.col("a"), params).alias("got")).collect():
        assert r.got == r.want, r


def test_prefilter(spark):
    rows = [
        (1, 0, "user", "x"), (1, 1, "agent", "y"), (1, 2, "user", "FINISH Conversation"), (2, 0, "user", "finish conversation"), (3, 0, "user", "a"), (3, 1, "agent", "finish conversation"),
        (4, 0, "user", "finish conversation"), (4, 1, "agent", "b"), (4, 2, "user", "c"), (5, 0, "agent", None),
    ]
    got = filters.prefilter_conversations(frame(spark, rows, "conv_id long, turn long, speaker string, message string")).collect()
    assert {r.conv_id: r.passed for r in got} == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_known_tools_keep_order(spark):
    agents = frame(spark, [(1, ["c", "x", "a"]), (2, ["a", "x"]), (3, [])], "id long, tools array<string>")
    tools = frame(spark, [("a",), ("b",), ("c",)], "id string")
    assert [(r.id, r.tools) for r in filters.known_tools(agents, tools).collect()] == [(1, ["c", "a"])]


def brute_leaders(rows, t):
    out, leaders = {}, defaultdict(list)
    for i, g, v in rows:
        v = np.array(v, float)
        if not v.any():
            out[i] = (None, True)
            continue
        for j, w in leaders[g]:
            if len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= t:
                out[i] = (j, False)
                break
        else:
            leaders[g].append((i, v))
            out[i] = (i, True)
    return out


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 1000))
def test_leaders(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, ["a", "b", None][int(rng.integers(3))], (rng.standard_normal(4) if rng.random() > 0.05 else np.zeros(4)).tolist()) for i in range(60)]
    want = brute_leaders([(i, g or "no_scenario", v) for i, g, v in rows], 0.7)
    got = similarity.leader_clusters(frame(spark, rows, "id long, g string, v array<double>"), 0.7, "id", "id", "v", "g").collect()
    assert {r.id: (r.leader, r.kept) for r in got} == want


def test_leader_chain(spark):
    a, b, c = [1.0, 0.0], [0.8, 0.6], [0.28, 0.96]
    got = similarity.leader_clusters(frame(spark, [(1, "s", a), (2, "s", b), (3, "s", c)], "id long, g string, v array<double>"), 0.75, "id", "id", "v", "g").collect()
    assert {r.id: r.leader for r in got} == {1: 1, 2: 1, 3: 3}


@pytest.mark.parametrize(("cell", "block"), [(4096, 1024), (20, 8)])
def test_similar_pairs_cells(spark, monkeypatch, cell, block):
    monkeypatch.setattr(similarity, "SLICE_ROWS", cell)
    monkeypatch.setattr(similarity, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    v = rng.standard_normal((200, 5))
    v[150:] = v[:50] + 0.1 * rng.standard_normal((50, 5))
    n = v / np.linalg.norm(v, axis=1)[:, None]
    sim = n @ n.T
    for t in (0.5, 0.95):
        want = {(i, j) for i in range(200) for j in range(i + 1, 200) if sim[i, j] >= t}
        got = similarity.similar_pairs(frame(spark, [(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>"), t, "id", "id", "v").collect()
        assert len(got) == len(want) and {(r.src, r.dst) for r in got} == want


def test_edges_top_k_ties(spark):
    rows = [(0, [1.0, 0.0])] + [(i, [1.0, 0.1]) for i in range(1, 13)]
    got = similarity.graph_edges(frame(spark, rows, "id long, v array<double>"), 0.7, 10, "id", "id", "v").filter("src = 0").collect()
    assert sorted(r.dst for r in got) == list(range(1, 11))


def test_components_of_a_hub_without_broadcast(spark, monkeypatch):
    from convoloom.operators import components

    monkeypatch.setattr(components, "MOST_BROADCAST", 0)
    edges = [(0, i) for i in range(1, 3000)] + [(i, i + 5000) for i in range(1, 3000, 7)] + [(20000, 20001), (9, None)]
    got = connected_components(frame(spark, edges, "src long, dst long")).collect()
    assert len(got) == 3000 + 429 + 2
    assert all(r.component == (20000 if r.id >= 20000 else 0) for r in got)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=40))
def test_components(spark, edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = connected_components(frame(spark, edges, "src long, dst long")).collect()
    assert {r.id: r.component for r in got} == {x: find(x) for x in root}


def test_long_path_and_empty(spark):
    got = connected_components(frame(spark, [(i, i + 1) for i in range(200)], "src long, dst long")).collect()
    assert len(got) == 201 and {r.component for r in got} == {0}
    assert connected_components(frame(spark, [], "src long, dst long")).count() == 0


def brute_bfs(near, start, size):
    seen, queue, cluster = set(), [start], []
    while queue and len(cluster) < size:
        at = queue.pop(0)
        if at in seen:
            continue
        seen.add(at)
        cluster.append(at)
        for n in sorted(near[at]):
            if n not in seen and len(cluster) + len(queue) < size:
                queue.append(n)
    return cluster


def test_bfs_and_walks(spark):
    rng = np.random.default_rng(5)
    pairs = sorted({tuple(sorted(map(int, rng.integers(0, 30, 2)))) for _ in range(45)} - {(i, i) for i in range(30)})
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    edges = frame(spark, [(a, b, 0.5) for a, b in pairs], "src long, dst long, weight double")
    nodes = frame(spark, [(i,) for i in range(31)], "id long")
    for size in (1, 4, 6):
        got = {r.start: r.cluster for r in graph.bfs_clusters(nodes, edges, size).collect()}
        assert got == {i: brute_bfs(near, i, size) for i in range(31)}
    starts = nodes.withColumn("walk", F.col("id"))
    walk = lambda **k: {r.walk: r.nodes for r in walks.random_walks(starts, edges, F.lit(4), node_col="id", **k).collect()}
    one = walk()
    assert one == walk() and one[30] == [] and all(len(set(v)) == len(v) <= 3 and k not in v for k, v in one.items())
    assert all(v == [] for v in walk(restart=1.0).values())
    for k, v in walk(restart=0.0).items():
        reach, front = {k}, [k]
        while front:
            front = [n for f in front for n in near[f] if n not in reach and not reach.add(n)]
        assert set(v) <= reach


def test_graph_stats_and_empty(spark):
    nodes = frame(spark, [(i,) for i in range(5)], "id long")
    edges = frame(spark, [(0, 1, 0.9), (1, 2, 0.8)], "src long, dst long, weight double")
    r = graph.graph_stats(nodes, edges).first()
    assert (r.nodes, r.edges, r.components, r.largest_component, r.avg_degree, r.density, r.connectivity) == (5, 2, 3, 3, 0.8, 0.2, 0.6)
    assert {x.node: x.degree for x in graph.degrees(nodes, edges).collect()} == {0: 1, 1: 2, 2: 1, 3: 0, 4: 0}
    assert graph.graph_stats(nodes, edges.limit(0)).first().components == 5


def test_group_edges(spark):
    nodes = frame(spark, [(i, "g" if i < 10 else "h") for i in range(12)], "id long, c string")
    got = graph.group_edges(nodes, frame(spark, [], "src long, dst long"), "id", "c", 0.6, "category").collect()
    assert all(r.src < r.dst and (r.src < 10) == (r.dst < 10) and r.weight == 0.6 for r in got) and len({(r.src, r.dst) for r in got}) == len(got)
    some = frame(spark, [(r.src, r.dst) for r in got[:5]], "src long, dst long")
    assert graph.group_edges(nodes, some, "id", "c", 0.6, "category").count() == len(got) - 5


def test_match_tasks(spark):
    tasks = frame(spark, [(1, 10), (2, 10), (3, 99), (4, 11)], "task_id long, agent_id long")
    agents = frame(spark, [(10,), (11,)], "agent_id long")
    lines = frame(spark, [(1, 0, 5), (1, 1, 6), (2, 0, 5), (3, 0, 5), (3, 1, 6), (4, 0, 6), (4, 1, 7), (4, 2, 8)], "task_id long, pos long, tool_id long")
    tools = frame(spark, [(5, "a"), (6, "b"), (7, "b")], "tool_id long, name string")
    got = {r.task_id: (r.n_tools, r.names) for r in joins.match_tasks(tasks, agents, lines, tools).collect()}
    assert got == {1: (2, ["a", "b"]), 4: (2, ["b"])}


def test_small_joins(spark):
    t = frame(spark, [(1,), (2,)], "k long")
    assert [r.k for r in joins.pending(t, frame(spark, [(1,), (1,), (None,)], "k long"), "k").collect()] == [2]
    old = frame(spark, [(1, "a", 1), (2, "b", 2)], "k long, x string, y long")
    new = frame(spark, [(2, "n", None), (3, "z", 3)], "k long, x string, y long")
    assert sorted(tuple(r) for r in joins.upsert(old, new, "k").collect()) == [(1, "a", 1), (2, "n", 2)]
    combos = frame(spark, [(0, ["b", "a"]), (1, ["a", "b"]), (2, ["a"])], "pos long, t array<string>")
    assert sorted(r.pos for r in joins.dedup_combinations(combos, "t", "pos").collect()) == [0, 2]
    assert joins.primary_scenario(frame(spark, [(["s", "t"],), ([],), (None,)], "scenario_ids array<string>")).collect()[0].scenario_id == "s"


def turns(spark, rows):
    return frame(spark, rows, "conv_id long, turn long, role string, recipient string, message string")


def test_training_rows(spark):
    call = '{"name":"a","arguments":{}}'
    rows = [
        (1, 0, "user", "agent", "hi"), (1, 1, "assistant", "execution", f"x {call}"), (1, 2, "execution", "agent", '[{"v":1,"metadata":{}},"t"]'), (1, 3, "assistant", "user", "done"), (1, 4, "user", "agent", "bye"), (1, 5, "user", "agent", "bye"),
        (2, 0, "user", "agent", "hi"), (2, 1, "assistant", "execution", '{"name":"a"}'), (3, 0, "system", None, "x"), (3, 1, "user", "agent", "y"), (4, 0, "assistant", None, None),
    ]
    got = {r.conv_id: [(m["from"], m["value"]) for m in r.conversations] for r in training.training_rows(turns(spark, rows)).collect()}
    assert got == {1: [("human", "hi"), ("function_call", call), ("observation", '{"v": 1}\nt'), ("gpt", "done"), ("human", "bye")], 4: [("gpt", "")]}
    c = training.conversion_counts(turns(spark, rows), training.training_rows(turns(spark, rows))).first()
    assert (c.total, c.converted, c.rejected, c.success_rate) == (4, 2, 2, 50.0)


def test_conversation(spark):
    rows = [(1, 0, "user", "agent", "a", "g"), (1, 1, "agent", "user", "Finish conversation", "g"), (1, 2, "other", None, "z", "g")]
    t = frame(spark, rows, "conv_id long, turn long, speaker string, recipient string, message string, agent_id string")
    assert conversation.history(t).first().history == "user: a\nagent: Finish conversation"
    assert [m.role for m in conversation.training_messages(t).first().messages] == ["user", "assistant"]
    s = conversation.sessions(t.filter("turn < 2")).first()
    assert s.ended and s.last_recipient == "user" and s.status == "completed" and s.session_id.startswith("session_")
    assert not conversation.sessions(t.filter("turn < 1")).first().ended and conversation.sessions(t.filter("turn < 1"), max_turns=1).first().ended


def test_stats(spark):
    s = frame(spark, [(3.0, None), (4.0, "keep"), (4.5, "keep"), (2.9, "fix"), (None, None)], "s double, r string")
    r = stats.evaluation_summary(s, F.col("s")).first()
    assert (r.total, r.scored, r.excellent, r.good, r.fair, r.poor, r.high_quality_ratio, r.needs_improvement_ratio) == (5, 4, 1, 1, 1, 1, 40.0, 20.0)
    assert stats.evaluation_summary(s.limit(0), F.col("s")).count() == 0
    assert {x.recommendation: x.n for x in stats.recommendation_counts(s, F.col("r")).collect()} == {"keep": 2, "fix": 1, stats.UNKNOWN: 2}
    d = frame(spark, [("simple",), ("odd",), ("simple",)], "difficulty string")
    assert {x.difficulty: x.n for x in stats.counts_over(d, "difficulty", ("simple", "medium", "complex")).collect()} == {"simple": 2, "medium": 0, "complex": 0}


def test_records(spark):
    one = spark.range(1)
    p = records.PERSONALITIES
    drawn = spark.range(2000).select(records.draw_persona(F.col("id")).alias("p")).select("p.*").groupBy("personality_type").count().collect()
    assert {r.personality_type for r in drawn} == set(p) and all(400 < r["count"] < 600 for r in drawn)
    assert one.select(records.fill("{a}-{b}", a=F.lit("x"), b=F.lit(None))).first()[0] == "x-"
    outcomes = {r.o: r["count"] for r in spark.range(4000).select(sampling.outcome(F.col("id")).alias("o")).groupBy("o").count().collect()}
    assert 3300 < outcomes["success"] < 3500 and 330 < outcomes["partial_success"] < 470
    assert one.select(sampling.quota(10, 0)).first()[0] == 0 and one.select(sampling.quota(10, 3)).first()[0] == 3
    a = sampling.hash_sample(spark.range(100), 10, F.col("id"))
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in sampling.hash_sample(spark.range(100).repartition(7), 10, F.col("id")).collect())


def test_provider(spark):
    p = frame(spark, [(1, "ask"), (2, "FAIL now"), (3, None)], "k long, prompt string")
    got = {r.k: (r.content, r.error) for r in provider.complete(p, "k", "prompt").collect()}
    assert got[1][0].startswith("answer") and got[2] == (None, "provider failed") and got[3][1] is None
    e = provider.embed(p, "k", "prompt", 8).collect()
    assert all(len(r.embedding) == 8 and r.error is None for r in e)

    def fn(b):
        if (b["k"] == 2).any():
            raise ValueError("bad chunk")
        return b[["k"]]

    m = provider.map_batches(p.coalesce(1), fn, "k long", 1).collect()
    assert sorted((r.k, r.error) for r in m if r.k) == [(1, None), (3, None)] and [r.error for r in m if r.error] == ["bad chunk"]


def test_sessions_end(spark):
    tasks = frame(spark, [(i, i % 3, ["a", "b"] if i % 2 else []) for i in range(20)], "task_id long, agent_id long, tools array<string>")
    t = provider.run_sessions(tasks, Params(max_turns=7)).collect()
    by = defaultdict(list)
    for r in sorted(t, key=lambda r: r.turn):
        by[r.task_id].append(r)
    assert len(by) == 20
    for own in by.values():
        assert len(own) <= 7 and own[0].speaker == "user" and (len(own) == 7 or "finish conversation" in own[-1].message)
        assert all(a.recipient == b.speaker for a, b in zip(own, own[1:], strict=False))
    assert provider.execute_call('{"name":"zz"}', {"a": []}, Params(), "k")["error_type"] == "tool_not_found"
    assert provider.execute_call('{"name":"a","arguments":{}}', {"a": [("q", "string", True)]}, Params(), "k")["error_type"] == "parameter_error"
    assert provider.execute_call("nope", {}, Params(), "k")["error_type"] == "invalid_call"


def test_generation(spark):
    s = generation.generate_scenarios(spark, ["law", "care"], 7, batch=2)
    got = s.collect()
    assert len(got) == 6 and {r.domain for r in got} == {"law", "care"} and len({r.id for r in got}) == 6
    assert generation.generate_scenarios(spark, [], 7).count() == 0 and generation.generate_scenarios(spark, ["law FAIL", "x"], 4).count() == 2
    tools = generation.generate_tools(s, 3)
    assert tools.count() == 18 and all(r.parameters[0].required for r in tools.collect())
    named = tools.withColumn("id", F.when(F.col("id") == tools.first().id, "FAIL").otherwise(F.col("id")))
    e = {r.id: r for r in generation.evaluate_tools(named).collect()}
    assert e["FAIL"].failed and e["FAIL"].overall_score == 3.0 and sum(r.failed for r in e.values()) == 1
    assert sorted(r.name for r in generation.refine_tools(named).collect()) == sorted(r.name for r in named.collect())
    req = frame(spark, [(str(i), "simple", ["search"]) for i in range(40)], "key string, difficulty string, tools array<string>")
    t = generation.generate_tasks(req).collect()
    assert 20 <= len(t) < 40 and all(r.expected_tools == ["search"] and r.difficulty == "simple" for r in t)
    p = frame(spark, [(i, "t", "r") for i in range(40)] + [(None, "t", "r")], "conv_id long, turns string, tool_results string")
    j = generation.judge(p, "conv_id").collect()
    assert len(j) == 41 and all(r.passed == (r.score is not None and r.score >= 4) and r.is_high_quality == (r.score is not None and r.score >= 4.5) for r in j)
    assert any(r.score is None for r in j if r.conv_id is not None)


def test_observations_read_as_python_prints_them(spark):
    assert training.observation('[{"v":1,"metadata":{}},"t",true,null,1.50,["a",1],{"k":"é","n":[1,{"metadata":2}]}]') == '{"v": 1}\nt\nTrue\nNone\n1.5\n[\'a\', 1]\n{"k": "é", "n": [1, {"metadata": 2}]}'
    assert training.observation("[not json") == "[not json" and training.observation("") == "" and training.observation('{"a": 1}') == '{"a": 1}'


def test_training_table(spark):
    call = '{"name":"a","arguments":{}}'
    rows = [(1, 0, "user", "agent", "hi"), (1, 1, "assistant", "execution", call), (2, 0, "user", "agent", "x"), (2, 1, "assistant", "user", "y"), (3, 0, "user", "agent", "alone"), (None, 0, "assistant", None, "z")]
    tools = frame(spark, [(1, "[1]"), (1, "[2]"), (9, "[3]")], "conv_id long, tools string")
    got = {r.conv_id: ([tuple(m) for m in r.conversations], r.tools) for r in training.training_table(turns(spark, rows), tools).collect()}
    assert got == {1: ([("human", "hi"), ("function_call", call)], "[2]"), 2: ([("human", "x"), ("gpt", "y")], "[]"), None: ([("gpt", "z")], "[]")}
    assert training.training_table(turns(spark, []), tools).count() == 0


def test_repeated_keys_count_once(spark):
    tools = frame(spark, [(1,), (2,), (3,), (None,)], "id long")
    evals = frame(spark, [(1, 5.0, 0), (1, 2.0, 1), (2, 1.0, 0), (2, 4.5, 3), (None, 9.0, 0)], "id long, overall_score double, pos int")
    assert sorted(str(r.id) for r in filters.filter_tools_by_score(tools, evals, pos_col="pos").collect()) == ["2", "3", "None"]
    assert sorted(str(r.id) for r in filters.filter_tools_by_score(tools, evals.drop("pos")).collect()) == ["1", "2", "3", "None"]
    assert filters.tool_filter_counts(tools, evals, pos_col="pos").first().total == 4
    assert stats.merge_evaluations(tools, evals, pos_col="pos").count() == 4
    old = frame(spark, [(1, "a"), (2, "b"), (None, "c")], "k long, x string")
    new = frame(spark, [(1, "n", 2), (1, "m", 1), (None, "q", 0)], "k long, x string, pos int")
    assert sorted((str(r.k), r.x) for r in joins.upsert(old, new, "k", "pos").collect()) == [("1", "n"), ("2", "b"), ("None", "c")]


def test_calls_of_different_tools(spark):
    kind = "id long, args string, params array<struct<name:string,type:string,required:boolean>>"
    a = [("n", "integer", None), ("x", "number", False), ("s", "string", False)]
    rows = [
        (1, '{"n":"7","x":"1e2","s":5}', a), (2, '{"n":3.9,"x":true}', a), (3, '{"n":-3.9}', a), (4, '{"x":1}', a), (5, '{"n":"3.5"}', a), (6, '{"n":1,"x":"q"}', a), (7, None, a), (8, "broken", [("o", "object", False)]),
        (9, '{"o":{"k":[1]}}', [("o", "object", True)]), (10, '{"z":1}', None), (11, '{"n":null}', a),
    ]
    got = {r.id: (r.c.fault, r.c["values"]) for r in frame(spark, rows, kind).select("id", filters.check_call(F.col("args"), F.col("params")).alias("c")).collect()}
    assert got[1] == (None, {"n": "7", "x": "100.0", "s": "5"}) and got[2] == (None, {"n": "3", "x": "1.0"}) and got[3] == (None, {"n": "-3"})
    assert got[4][0] == got[7][0] == "Missing required parameters: n" and got[5][0] == got[11][0] == "Parameter 'n' should be an integer" and got[6][0] == "Parameter 'x' should be a number"
    assert got[8] == (None, {}) and got[9] == (None, {"o": '{"k":[1]}'}) and got[10] == (None, {"z": "1"}) and got[5][1] is None


def test_leaders_of_a_long_chain(spark):
    """Neighbours on an arc resemble each other, others do not: every second one leads."""
    n = 1000
    angle = np.arange(n) * 0.006
    rows = [(i, [float(np.cos(a)), float(np.sin(a))], "g") for i, a in enumerate(angle)]
    got = similarity.leader_clusters(frame(spark, rows, "id long, v array<double>, g string"), float(np.cos(0.0065)), "id", "id", "v", "g").collect()
    assert {r.id for r in got if r.kept} == set(range(0, n, 2)) and all(r.leader == r.id - r.id % 2 for r in got)


def test_pairs_at_one_position(spark):
    rows = [(2, 0, [1.0, 0.0]), (1, 0, [1.0, 0.1]), (3, 1, [0.0, 1.0])]
    got = similarity.similar_pairs(frame(spark, rows, "id long, pos long, v array<double>"), 0.9, "id", "pos", "v").collect()
    assert [(r.src, r.dst) for r in got] == [(1, 2)]


def test_agent_records(spark):
    kind = "id string, name string, description string, parameters array<struct<name:string,type:string,description:string,required:boolean,enum:array<string>>>"
    tools = frame(spark, [("t", "n", None, [(None, None, None, None, None)]), ("t", "m", "d", None), ("u", "o", "e", [])], kind)
    combos = frame(spark, [("1", ["u", "t", "x"]), ("2", []), ("3", None), ("4", ["x"])], "id string, tool_ids array<string>")
    got = {len(r.tools): r for r in records.agent_records(combos, tools, "<{tools_list}>").collect()}
    assert set(got) == {3, 1} and got[1].system_prompt == "<>" and got[3].id != got[1].id
    assert got[3].system_prompt.startswith('<{"name":"o"') and '\n\n{"name":"n","description":"","parameters":{"type":"object","properties":{"":{"type":"string","description":""}},"required":[]}}' in got[3].system_prompt
    assert records.agent_records(combos.limit(0), tools, "x").count() == 0


def test_combination_distributions(spark):
    combos = frame(spark, [(["a", "b"], "w", "s"), (["a"], None, "s"), (None, "w", None), ([], "w", "r")], "tool_ids array<string>, generation_method string, scenario_id string")
    got = {(r.kind, r.value): r.n for r in stats.combination_distributions(combos, top=2).collect()}
    assert got == {("size", "2"): 1, ("size", "1"): 1, ("size", "0"): 1, ("method", "w"): 3, ("method", ""): 1, ("scenario", "s"): 2, ("scenario", ""): 1}
    one = stats.agent_stats(combos.filter("size(tool_ids) > 1"), "tool_ids", combos).first()
    assert one.success_rate == 0.25 and stats.agent_stats(combos.limit(0), "tool_ids", combos.limit(0)).first().success_rate == 0.0


def test_entities_from_json(spark):
    from convoloom.operators import entities

    rows = frame(spark, [
        ('{"id": "1", "agent_id": "a", "difficulty": "simple", "rubric": {"checkpoints": ["x (y)"]}, "created_at": "2024-01-02T03:04:05", "more": 1}',), ('{"id": "2", "agent_id": "a", "created_at": "2024-01-02T03:04:05.000006"}',),
        ('{"id": "3"}',), ('{"id": "4", "agent_id": "a", "task_type": "endless"}',), ("[1]",), ("{bad",), (None,), ('{"id": "1", "agent_id": "a", "expected_tools": 5}',),
    ], "j string")
    good, bad = entities.entities_from_json(rows, "j", "task")
    got = {(r.id, r.difficulty, str(r.created_at)) for r in good.collect()}
    assert got == {("1", "simple", "2024-01-02 03:04:05"), ("2", None, "2024-01-02 03:04:05.000006"), ("1", None, "None")}
    assert sorted(r.error for r in bad.collect()) == ["no agent_id", "no object", "no object", "no object", "unknown task_type"]
    assert good.filter("rubric is not null").first().rubric.checkpoints == ["x (y)"]
    again, none = entities.entities_from_json(good.select(entities.to_entity_json(*good.columns).alias("j")), "j", "task")
    assert sorted(map(str, again.collect())) == sorted(map(str, good.collect())) and none.count() == 0

"""Generation stages: requests as rows, a provider's answers, parsing, normalising, validation.

Every stage is requests -> ``provider.complete`` -> X2 -> ``from_json`` -> its rules, keyed throughout. A request that fails or
does not parse gives no record, or the stage's fallback; nothing loops until a count is reached.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.json_text import parse_llm_json
from ..prompts import PROMPTS
from .filters import valid_scenario, valid_score, valid_task
from .provider import Provider, complete
from .records import expected_tools, fill, function_schema, normalize_scenario, normalize_tool

SCENARIO_ANSWER = "array<struct<name:string,description:string,context:string,target_users:array<string>>>"
TOOL_ANSWER = "array<struct<name:string,description:string,parameters:array<struct<name:string,type:string,description:string,required:boolean,enum:array<string>>>,return_type:string>>"
EVALUATION_ANSWER = "struct<overall_score:double,suggestions:array<string>,recommendation:string>"
TASK_ANSWER = "struct<task:struct<title:string,description:string,difficulty:string>,rubric:struct<checkpoints:array<string>,success_criteria:array<string>>>"


def stub_json_provider(prompt: str) -> str:
    """Repeatable well-formed answers for every kind of request; a key that holds FAIL fails."""
    head = dict(line.split(": ", 1) for line in prompt.split("\n")[:3])
    kind, key, count = head["KIND"], head["KEY"], int(head["COUNT"])
    if "FAIL" in key:
        raise RuntimeError("provider failed")
    h = int(hashlib.md5(f"{kind}:{key}".encode()).hexdigest()[:8], 16)
    param = {"name": "input", "type": "string", "description": "what to work on", "required": True, "enum": []}
    if kind == "scenarios":
        body: object = [{"name": f"{key} scenario {i}", "description": f"a longer description of scenario {i} for {key}", "context": "an office", "target_users": ["staff"]} for i in range(count)]
    elif kind == "tools":
        body = [{"name": f"tool_{h % 1000}_{i}", "description": f"does step {i} of {key}", "parameters": [param], "return_type": "object"} for i in range(count)]
    elif kind == "evaluate":
        body = {"overall_score": round(2 + h % 31 / 10, 1), "suggestions": ["shorter"], "recommendation": "keep" if h % 3 else "improve"}
    elif kind == "task":
        body = {"task": {"title": f"task {key}", "description": "do it", "difficulty": "medium"}, "rubric": {"checkpoints": ["search(input)"] if h % 4 else ["unknown_tool(x)"], "success_criteria": ["done"]}}
    elif kind == "judge":
        body = {"overall_score": round(h % 61 / 10, 1)}
    else:
        body = {"answer": h}
    return f"Here it is:\n```json\n{json.dumps(body)}\n```"


def _once(c: Column) -> Column:
    """``c`` as a generated column. Catalyst copies a computed column into every filter and field that uses it, and an answer would be
    parsed again for each; it copies nothing out of a generator."""
    return F.explode(F.array(c))


def _ask(requests: DataFrame, key: str, kind: str, count: Column | int, provider: Provider, schema: str | None = None, **values: Column) -> DataFrame:
    """(key, json): the parsed answers as JSON text, or by ``schema``; failed ones are null. Each answer is parsed once."""
    n = F.lit(count) if isinstance(count, int) else count
    prompt = fill(PROMPTS[kind], kind=F.lit(kind), key=F.col(key), count=n, **values)
    text = parse_llm_json(F.col("content"))
    return complete(requests.select(key, prompt.alias("prompt")), key, "prompt", provider).select(key, _once(F.from_json(text, schema) if schema else text).alias("json"))


def generate_scenarios(spark: SparkSession, domains: list[str], target: int, batch: int = 10, provider: Provider = stub_json_provider) -> DataFrame:
    """``target // len(domains)`` valid scenarios a domain at most, from batches of requests."""
    quota = target // len(domains) if domains else 0
    batches = -(-quota // batch)
    rows = spark.range(1).select(F.explode(F.array(*[F.lit(d) for d in domains])).alias("domain")).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(max(batches, 1))))) if domains else spark.createDataFrame([], "domain string, i int")
    rows = rows.withColumn("key", F.concat_ws("/", "domain", "i"))
    got = _ask(rows, "key", "scenarios", batch, provider, SCENARIO_ANSWER, domain=F.split("key", "/")[0]).join(rows, "key")
    items = got.select("domain", "i", F.posexplode("json").alias("pos", "s"))
    made = items.select("domain", "i", "pos", normalize_scenario(F.col("s.name"), F.col("s.description"), F.col("domain"), F.col("s.context"), F.col("s.target_users")).alias("r"))
    valid = made.filter(valid_scenario(F.col("r.name"), F.col("r.description"), F.col("r.context")))
    rank = F.row_number().over(Window.partitionBy("domain").orderBy("i", "pos"))
    return valid.withColumn("n", rank).filter(F.col("n") <= quota).select("r.*")


def generate_tools(scenarios: DataFrame, each: int = 10, provider: Provider = stub_json_provider) -> DataFrame:
    """M5: up to ``each`` normalised tools for every scenario (id, name, description)."""
    s = scenarios.select("id", "name", "description")
    prompt_rows = _ask(s, "id", "tools", each, provider, TOOL_ANSWER, name=F.col("name"), description=F.col("description"))
    items = prompt_rows.select(F.col("id").alias("scenario_id"), F.posexplode(F.slice("json", 1, each)).alias("pos", "t"))
    tool = normalize_tool(F.col("t.name"), F.col("t.description"), F.col("t.parameters"), F.col("t.return_type"), F.col("scenario_id"))
    return items.select(tool.alias("r")).select("r.*").filter((F.length("name") > 0) & (F.length("description") > 0))


def evaluate_tools(tools: DataFrame, provider: Provider = stub_json_provider, default: float = 3.0) -> DataFrame:
    """(id, overall_score, recommendation, failed); a failed or senseless answer scores ``default``."""
    e = _ask(tools, "id", "evaluate", 1, provider, EVALUATION_ANSWER, tool=function_schema(F.col("name"), F.col("description"), F.col("parameters"))).withColumnRenamed("json", "e")
    fine = valid_score(F.col("e.overall_score"))
    return e.select("id", F.when(fine, F.col("e.overall_score")).otherwise(default).alias("overall_score"), "e.recommendation", (~fine).alias("failed"))


def refine_tools(tools: DataFrame, provider: Provider = stub_json_provider) -> DataFrame:
    """M6: (id, name, description) with the answer's texts where it has some, else the tool's own."""
    schema = function_schema(F.col("name"), F.col("description"), F.col("parameters"))
    a = _ask(tools, "id", "refine", 1, provider, "struct<name:string,description:string>", tool=schema, suggestions=F.lit("")).select(F.col("id").alias("__id"), F.col("json").alias("a"))
    return tools.join(a, tools["id"] == F.col("__id"), "left").select("id", F.coalesce("a.name", "name").alias("name"), F.coalesce("a.description", "description").alias("description"))


def generate_tasks(requests: DataFrame, provider: Provider = stub_json_provider) -> DataFrame:
    """(key, title, description, difficulty, expected_tools) for requests (key, difficulty, tools) whose answers are valid."""
    a = _ask(requests, "key", "task", 1, provider, TASK_ANSWER, difficulty=F.col("difficulty"), tools=F.array_join("tools", "\n")).withColumnRenamed("json", "a").join(requests, "key")
    ok = valid_task(F.col("a.task.title"), F.col("a.task.description"), F.col("a.task.difficulty"), F.col("a.rubric.checkpoints"), F.col("a.rubric.success_criteria"), F.col("tools"))
    return a.filter(ok).select("key", "a.task.title", "a.task.description", "difficulty", expected_tools(F.col("a.rubric.checkpoints")).alias("expected_tools"))


def judge(payloads: DataFrame, key: str, provider: Provider = stub_json_provider, criteria: Column | None = None, threshold: float = 4.0, high: float = 4.5) -> DataFrame:
    """(key, score, passed, is_high_quality, quality_tags) for payloads (key, turns, tool_results); an answer without a valid score is null and not passed."""
    rows = payloads.withColumn("__k", F.col(key).cast("string"))
    asked = _ask(rows, "__k", "judge", 1, provider, turns=F.col("turns"), results=F.col("tool_results"), criteria=criteria if criteria is not None else F.lit(""))
    s = F.get_json_object("json", "$.overall_score").try_cast("double")
    scored = asked.select("__k", F.when(valid_score(s), s).alias("score"))
    good = F.coalesce(F.col("score") >= high, F.lit(False))
    tags = F.when(good, F.array(F.lit("high_quality"))).when(F.col("score") >= threshold, F.array(F.lit("passed"))).otherwise(F.array().cast("array<string>"))
    return rows.select(key, "__k").join(scored, "__k", "left").select(key, "score", F.coalesce(F.col("score") >= threshold, F.lit(False)).alias("passed"), good.alias("is_high_quality"), tags.alias("quality_tags"))

"""Model calls behind a provider, and the session loop that uses them.

A provider answers prompts; the stub here is a pure function of the prompt, so all runs repeat without a network. Calls run in
``mapInPandas``, keyed: a failed call keeps its row with an ``error``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Params
from ..functions.json_text import one_json
from ..schemas import FINISH_MARK

Provider = Callable[[str], str]


def stub_provider(prompt: str) -> str:
    """A repeatable answer to any prompt; prompts that ask for failure fail."""
    if "FAIL" in prompt:
        raise RuntimeError("provider failed")
    return "answer " + hashlib.md5(prompt.encode()).hexdigest()[:12]


def stub_embedding(text: str, width: int) -> list[float]:
    """A repeatable unit vector for a text."""
    seed = int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "big")
    v = np.random.default_rng(seed).standard_normal(width)
    return (v / np.linalg.norm(v)).tolist()


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` evenly over the shuffle's partitions. A call costs far more than its row, so a small file that Spark reads in one task
    may not leave all its calls to that task; with a number given, partitions are not joined again."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *rows.columns)


def complete(df: DataFrame, key: str, prompt: str, provider: Provider = stub_provider, tries: int = 2) -> DataFrame:
    """M1, M2, M4-M8: (key, content, error) for every prompt; each is tried ``tries`` times at most and no row is dropped."""
    rows = _dealt(df.select(F.col(key), F.col(prompt).alias("prompt")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def ask(p: str | None) -> tuple[str | None, str | None]:
            error = None
            for _ in range(tries):
                try:
                    return provider(p or ""), None
                except Exception as e:  # noqa: BLE001  any provider error becomes a value
                    error = str(e)
            return None, error

        for b in batches:
            got = [ask(p) for p in b["prompt"]]
            yield pd.DataFrame({key: b[key], "content": [g[0] for g in got], "error": [g[1] for g in got]})

    return rows.mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, content string, error string")


def embed(df: DataFrame, key: str, text: str, width: int = 256, model: Callable[[str, int], list[float]] = stub_embedding) -> DataFrame:
    """M3, M9: (key, embedding, error); a failed text has a null vector."""
    rows = _dealt(df.select(F.col(key), F.col(text).alias("text")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            vectors, errors = [], []
            for t in b["text"]:
                try:
                    vectors.append(model(t or "", width))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001
                    vectors.append(None)
                    errors.append(str(e))
            yield pd.DataFrame({key: b[key], "embedding": vectors, "error": errors})

    return rows.mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, embedding array<double>, error string")


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, rows_a_batch: int = 100) -> DataFrame:
    """``fn`` over chunks of rows; a chunk that fails gives no rows but its error is kept in ``error``. ``schema`` is that of
    the result, to which ``error`` is added."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), rows_a_batch):
                part = b.iloc[at : at + rows_a_batch]
                try:
                    yield fn(part).assign(error=None)
                except Exception as e:  # noqa: BLE001
                    yield pd.DataFrame({"error": [str(e)] * len(part)})

    names = [f.split()[0] for f in schema.split(",")]

    def shaped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in run(batches):
            yield b.reindex(columns=[*names, "error"])

    return df.mapInPandas(shaped, schema + ", error string")


def _draw(*key: Any) -> float:
    return int(hashlib.md5(":".join(map(str, key)).encode()).hexdigest()[:13], 16) / (1 << 52)


def execute_call(call: str, tools: dict[str, list[tuple[str, str, bool]]], params: Params, key: str) -> dict[str, Any]:
    """The result of one call: an error row for bad JSON, an unknown tool or missing arguments, else a drawn outcome."""

    def result(status: str, value: str | None, message: str, name: str, kind: str | None = None, error: str | None = None) -> dict[str, Any]:
        seconds = 0.0 if status == "failure" else round(0.1 + 1.9 * _draw(params.seed, key, "time"), 2)
        return {"status": status, "result": value, "message": message, "tool_name": name, "execution_type": kind, "error_type": error, "execution_time": seconds}

    try:
        parsed = json.loads(call)
        name, args = parsed["name"], parsed.get("arguments", {})
    except (ValueError, KeyError, TypeError, AttributeError):
        return result("failure", None, "not a tool call", "", error="invalid_call")
    if name not in tools:
        return result("failure", None, f"no tool named {name}", name, error="tool_not_found")
    lost = [n for n, _, needed in tools[name] if needed and n not in args]
    if lost:
        return result("failure", None, "Missing required parameters: " + ", ".join(lost), name, error="parameter_error")
    u = _draw(params.seed, key)
    if u < params.success_rate:
        return result("success", f"{name} finished", "Operation completed successfully", name, "success")
    if u < params.success_rate + params.partial_rate:
        return result("success", f"{name} finished in part", "Operation completed with warnings", name, "partial_success")
    return result("failure", None, f"{name} failed", name, "failure", "execution_error")


def run_sessions(tasks: DataFrame, params: Params | None = None, provider: Provider = stub_provider) -> DataFrame:
    """T1-T8, U7, U8 for every task (task_id, agent_id, tools): the turns of its simulated session in long form.

    The user opens, the agent calls one of its tools and then answers, the user goes on or finishes; a session ends with the
    finish mark or at the turn limit. One session is one task's loop inside a partition, so nothing is exchanged between turns
    and a lost executor only repeats its sessions.
    """
    params = params or Params()
    rows = tasks.select(F.col("task_id").cast("string"), F.col("agent_id").cast("string"), "tools")

    def session(task: str, agent: str, tools: list[str]) -> list[tuple]:
        known: dict[str, list[tuple[str, str, bool]]] = {t: [("input", "string", True)] for t in tools}
        names, turns = sorted(known), []

        def say(speaker: str, recipient: str, message: str) -> None:
            turns.append((task, agent, len(turns), speaker, recipient, message))

        say("user", "agent", provider(f"user {task} opens"))
        while len(turns) < params.max_turns and FINISH_MARK not in turns[-1][5].lower():
            _, _, at, speaker, recipient, message = turns[-1]
            if recipient == "agent":
                if speaker == "user" and known:
                    name = names[int(_draw(params.seed, task, at) * len(names))]
                    say("agent", "execution", json.dumps({"name": name, "arguments": {"input": message[:20]}}))
                else:
                    say("agent", "user", provider(f"agent {agent} after {message}"))
            elif recipient == "execution":
                out = execute_call(one_json(message) or "", known, params, f"{task}:{at}")
                say("execution", "agent", json.dumps(out))
            elif _draw(params.seed, task, at, "end") < 0.5:
                say("user", "agent", FINISH_MARK)
            else:
                say("user", "agent", provider(f"user {task} after {message}"))
        return turns

    names_out, kinds = ["task_id", "agent_id", "turn", "speaker", "recipient", "message"], [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [t for task, agent, tools in zip(*(c.to_pylist() for c in b.columns), strict=True) for t in session(task, agent, tools or [])]
            columns = zip(*out, strict=True) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names_out)

    return _dealt(rows).mapInArrow(run, "task_id string, agent_id string, turn long, speaker string, recipient string, message string")

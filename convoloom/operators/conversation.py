"""Conversations as long tables of turns: roles, history, sessions, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_id
from ..schemas import FINISH_MARK, ROLES_BY_SPEAKER, SPEAKERS_BY_ROLE


def _map(c: Column, table: dict[str, str], keep_unknown: bool) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(c) if keep_unknown else out


def role_of(speaker: Column) -> Column:
    """The message role of a speaker; null for speakers that are dropped."""
    return _map(speaker, ROLES_BY_SPEAKER, False)


def speaker_of(role: Column, speaker: Column | None = None) -> Column:
    """The speaker of a role; an own ``speaker`` value wins, unknown roles pass through."""
    got = _map(role, SPEAKERS_BY_ROLE, True)
    return got if speaker is None else F.coalesce(speaker, got)


def training_messages(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv_id, messages) with messages of known speakers in order."""
    rows = turns.withColumn("role", role_of(F.col("speaker"))).filter(F.col("role").isNotNull())
    items = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), "role", F.col("message").alias("content"), "recipient")))
    return rows.groupBy(conv).agg(F.transform(items, lambda m: F.struct(m["role"], m["content"], m["recipient"])).alias("messages"))


def history(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Each conversation as ``speaker: message`` lines in order; other speakers are left out."""
    rows = turns.filter(F.col("speaker").isin(*ROLES_BY_SPEAKER)).withColumn("line", F.concat(F.col("speaker"), F.lit(": "), F.coalesce("message", F.lit(""))))
    return rows.groupBy(conv).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(turn, "line"))), lambda x: x["line"]), "\n").alias("history"))


def evaluation_payload(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """All turns and the tool results of each conversation, in order."""
    line = F.struct(F.col(turn).alias("t"), F.col("speaker").alias("s"), F.col("message").alias("m"))
    whole = turns.groupBy(conv).agg(F.array_sort(F.collect_list(line)).alias("x"))
    text = lambda a: F.array_join(F.transform(a, lambda r: F.concat_ws(": ", r["s"], r["m"])), "\n")
    return whole.select(conv, F.size("x").cast("long").alias("n_turns"), text(F.col("x")).alias("turns"), text(F.filter("x", lambda r: r["s"] == "execution")).alias("tool_results"))


def sessions(turns: DataFrame, max_turns: int = 20, conv: str = "conv_id", turn: str = "turn", agent: str = "agent_id") -> DataFrame:
    """One row a conversation: session id from task and agent, turns, last speaker, recipient and message,
    whether it has ended (turn limit or finish mark) and its trajectory id."""
    g = turns.groupBy(conv).agg(
        F.count("*").alias("n_turns"), F.max_by(F.struct("speaker", "recipient", "message"), turn).alias("last"), F.max(agent).alias(agent)
    )
    text = F.coalesce("last.message", F.lit(""))
    ended = (F.col("n_turns") >= max_turns) | F.lower(text).contains(FINISH_MARK)
    sid = content_id("session", {"task_id": F.col(conv).cast("string"), "agent_id": F.col(agent)})
    tid = content_id("trajectory", {"session_id": F.col("session_id"), "task_id": F.col(conv).cast("string"), "agent_id": F.col(agent)})
    out = g.select(conv, agent, sid.alias("session_id"), "n_turns", F.col("last.speaker").alias("last_speaker"), F.col("last.recipient").alias("last_recipient"), ended.alias("ended"))
    return out.withColumns({"trajectory_id": tid, "status": F.when(F.col("ended"), "completed").otherwise("active")})


def next_speaker(last_recipient: Column) -> Column:
    """Who speaks next; a session without turns begins with the user, an unknown recipient too."""
    return F.when(last_recipient.isin("user", "agent", "execution"), last_recipient).otherwise("user")

"""Prompt templates. Each begins with its kind and the facts that an offline provider needs; ``{name}`` places are filled by columns."""

from __future__ import annotations

_HEAD = "KIND: {kind}\nKEY: {key}\nCOUNT: {count}\n"


def _prompt(text: str) -> str:
    return _HEAD + text


PROMPTS: dict[str, str] = {
    "scenarios": _prompt("Describe {count} workplace scenarios from the domain {domain}. Answer with a JSON list of objects with name, description, context and target_users."),
    "tools": _prompt("Design {count} tools that someone in this scenario would call: {name}. {description} Answer with a JSON list of objects with name, description, parameters and return_type."),
    "refine": _prompt("Improve this tool without changing its purpose: {tool} Consider: {suggestions} Answer with one JSON object of the same shape."),
    "evaluate": _prompt("Rate this tool from 0 to 5 for clarity, usefulness and soundness: {tool} Answer with a JSON object with overall_score, suggestions and recommendation."),
    "agent_system": _prompt("You are an assistant with these tools:\n{tools}\nCall a tool with one JSON object that has name and arguments; otherwise answer in plain words."),
    "agent_reply": _prompt("Conversation so far:\n{history}\nWrite the assistant's next message."),
    "task": _prompt("Write one {difficulty} task for an assistant with these tools:\n{tools}\nAnswer with a JSON object with task (title, description, difficulty) and rubric (checkpoints, success_criteria)."),
    "user_system": _prompt("You play a {personality} user who writes in a {style} manner and wants: {task}"),
    "user_opening": _prompt("Open the conversation about: {task}"),
    "user_reply": _prompt("Conversation so far:\n{history}\nWrite the user's next message, or the finish mark if the task is done."),
    "persona": _prompt("Describe a {personality} user with a {style} style in two sentences."),
    "execute": _prompt("Give the {outcome} result of calling {tool} with {arguments} as a JSON object with status, result and message."),
    "execute_check": _prompt("Say whether this result of {tool} is plausible: {result} Answer with a JSON object with plausible."),
    "judge_system": _prompt("You judge conversations between users and assistants that call tools."),
    "judge": _prompt("Judge this conversation against its criteria.\n{turns}\nTool results:\n{results}\nCriteria:\n{criteria}\nAnswer with a JSON object with overall_score from 0 to 5."),
}

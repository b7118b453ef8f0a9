"""Schemas of the entity tables, and the allowed values of their enumerations."""

from __future__ import annotations

# The enumerations.
DIFFICULTIES = ("simple", "medium", "complex")
TASK_TYPES = ("single_turn", "multi_turn")
SPEAKERS = ("user", "agent", "execution")
ROLES_BY_SPEAKER = {"user": "user", "agent": "assistant", "execution": "execution"}
SPEAKERS_BY_ROLE = {"user": "user", "assistant": "agent", "execution": "execution"}
FINISH_MARK = "finish conversation"
PARAMETER_TYPES = ("string", "integer", "float", "boolean", "array", "object")


# Schemas are DDL text: readers and from_json take it, and it needs no session.
PARAMETER = "struct<name:string,type:string,description:string,required:boolean,default:string,enum:array<string>>"
SCENARIO = "id string, name string, description string, domain string, context string, target_users array<string>, metadata struct<generated_at:string>"
TOOL = (
    f"id string, name string, description string, return_type string, scenario_ids array<string>, parameters array<{PARAMETER}>, examples array<string>, "
    "metadata struct<generated_at:string,scenario_name:string,domain:string,embedding:array<double>,embedding_model:string,embedding_updated_at:string>"
)
EVALUATION = "id string, name string, overall_score double, suggestions array<string>, recommendation string, error string"
AGENT = "id string, system_prompt string, tools array<string>, created_at timestamp"
RUBRIC = "struct<success_criteria:array<string>,tool_usage_expectations:array<string>,checkpoints:array<string>>"
TASK = f"id string, agent_id string, title string, description string, difficulty string, task_type string, expected_tools array<string>, rubric {RUBRIC}, metadata map<string,string>, created_at timestamp"
TRAJECTORY = (
    "trajectory_id string, task_id string, agent_id string, messages array<struct<role:string,content:string,recipient:string>>, score double, "
    "metadata struct<quality_tags:array<string>,is_high_quality:boolean>"
)
COMBINATION = "id string, scenario_id string, tool_ids array<string>, generation_method string, start_tool string, tool_count int"
TRAINING_ROW = "conversations array<struct<from:string,value:string>>, tools string"
TURN = "conv_id string, turn long, speaker string, recipient string, message string"

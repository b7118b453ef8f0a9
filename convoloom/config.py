"""Job parameters with the defaults of the pipeline; the environment can override them."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Params:
    """All thresholds and sizes in one place."""

    tool_score: float = 4.0
    trajectory_score: float = 4.0
    high_quality_score: float = 4.5
    default_score: float = 5.0
    duplicate_cosine: float = 0.85
    similar_cosine: float = 0.9
    edge_cosine: float = 0.7
    edges_a_node: int = 10
    min_tools: int = 3
    max_tools: int = 6
    walk_length: int = 6
    restart: float = 0.15
    max_turns: int = 20
    success_rate: float = 0.85
    partial_rate: float = 0.10
    batch_rows: int = 100
    embedding_batch: int = 10
    embedding_width: int = 256
    seed: int = 7

    @classmethod
    def from_env(cls, prefix: str = "CONVOLOOM_") -> Params:
        """Values of ``PREFIX + NAME`` variables, read as the type of the default."""
        got = {}
        for f in fields(cls):
            text = os.environ.get(prefix + f.name.upper())
            if text is not None:
                got[f.name] = type(f.default)(text)
        return cls(**got)

    def updated(self, **values: float) -> Params:
        """A copy with other values; unknown names and wrong types are errors."""
        known = {f.name: type(f.default) for f in fields(self)}
        for k, v in values.items():
            if k not in known:
                raise KeyError(k)
            if not isinstance(v, (known[k], int) if known[k] is float else known[k]):
                raise TypeError(f"{k} has to be {known[k].__name__}")
        return replace(self, **values)

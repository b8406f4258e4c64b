"""Named table transforms applied in order."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from trajspark.functions.columns import c

# The columns each scope covers, as exact names or prefixes.
SCOPES = {
    "observation": ("observation.",),
    "action": ("action",),
    "reward": ("next.reward", "reward"),
    "done": ("next.done", "done"),
    "truncated": ("next.truncated", "truncated"),
    "info": ("info.",),
    "complementary": ("task", "subtask", "index", "task_index", "episode_index"),
}


@dataclass(frozen=True)
class Step:
    """``fn`` maps a DataFrame to a DataFrame; with a ``scope`` it may only change the columns of that scope."""

    name: str
    fn: Callable[[DataFrame], DataFrame]
    scope: str | None = None


def in_scope(name: str, scope: str) -> bool:
    if scope == "complementary" and name.endswith("_is_pad"):
        return True
    return any(name.startswith(p) if p.endswith(".") else name == p or name.startswith(p + ".") for p in SCOPES[scope])


def apply_step(df: DataFrame, step: Step) -> DataFrame:
    out = step.fn(df)
    if step.scope is None:
        return out
    lost = [n for n in df.columns if n not in out.columns and not in_scope(n, step.scope)]
    made = [n for n in out.columns if n not in df.columns and not in_scope(n, step.scope)]
    if lost or made:
        raise ValueError(f"step {step.name} of scope {step.scope} must not touch {lost + made}")
    return out.select(*[c(n) for n in out.columns])


def step_through(df: DataFrame, steps: Sequence[Step]) -> Iterator[tuple[str, DataFrame]]:
    """The input and the table after every step; all are lazy."""
    yield "input", df
    for step in steps:
        df = apply_step(df, step)
        yield step.name, df


def run_steps(
    df: DataFrame,
    steps: Sequence[Step],
    before: Sequence[Callable[[int, DataFrame], None]] = (),
    after: Sequence[Callable[[int, DataFrame], None]] = (),
) -> DataFrame:
    """Apply all steps; hooks see the step number and the table around it. The same steps work on a stream."""
    for i, step in enumerate(steps):
        for hook in before:
            hook(i, df)
        df = apply_step(df, step)
        for hook in after:
            hook(i, df)
    return df


def output_schema(df: DataFrame, steps: Sequence[Step]) -> dict[str, str]:
    """Schema after the steps, without running anything."""
    return dict(run_steps(df.limit(0), steps).dtypes)

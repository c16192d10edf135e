"""Runs of many tasks (O-4 to O-6, O-11): stages, each with bounded concurrency; a later stage waits for whole success."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

#: Task types by stage; the second stage needs the first.
CORE = ["schools", "majors", "score_lines", "timelines"]
ASSOCIATIONS = [
    "school_majors", "major_strength_signals", "score_segments", "enrollment_plans", "major_admission_results", "dxsbb_admission_results", "charters", "special",
    "school_satisfaction", "major_satisfaction", "interpretations", "provincial_announcements",
]


@dataclass(frozen=True)
class Outcome:
    """O-11: tasks in all and failed, and the stages that did not start."""

    total: int = 0
    failed: int = 0
    skipped: tuple[int, ...] = ()
    errors: tuple[str, ...] = ()

    @property
    def successful(self) -> bool:
        return not self.failed and not self.skipped


def run_stages(stages: list[list[str]], task: Callable[[str], int], most: int = 3) -> Outcome:
    """task(name) returns how many of its items failed. At most `most` run at a time; Spark jobs of different threads share the
    executors. A task that raises has failed; the message names its error's type, never its values."""
    total, failed, errors = 0, 0, []
    for k, names in enumerate(stages):

        def one(name: str) -> str | None:
            try:
                n = task(name)
            except Exception as e:  # noqa: BLE001  one task's error must not end the others
                return f"{name}: {type(e).__name__}"
            return f"{name}: {n} failed" if n else None

        with ThreadPoolExecutor(most) as pool:
            bad = [e for e in pool.map(one, names) if e]
        total, failed = total + len(names), failed + len(bad)
        errors += bad
        if bad:
            return Outcome(total, failed, tuple(range(k + 1, len(stages))), tuple(errors))
    return Outcome(total, failed)

"""The steps of a whole run, what each one reads and writes, and a check before the first one starts."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass


@dataclass(frozen=True)
class Step:
    name: str
    reads: tuple[str, ...]
    writes: tuple[str, ...]
    may_read: tuple[str, ...] = ()
    settings: tuple[str, ...] = ()


#: In the order of a run. Names of files and tables are those that the readers and writers are given.
STEPS = (
    Step("crawl", ("brands",), ("contexts",), settings=("fetch provider",)),
    Step("generate", ("brands",), ("keywords",), may_read=("contexts",), settings=("model provider",)),
    Step("match", ("keywords", "addresses"), ("matches",)),
    Step("resolve", ("matches", "target_dump"), ("targets",)),
    Step("traffic", ("targets",), ("traffic",), settings=("traffic provider",)),
    Step("report", ("matches", "traffic"), ("client_report", "internal_report")),
)


def in_order(names: Iterable[str], steps: tuple[Step, ...] = STEPS) -> list[Step]:
    """The named steps, once each, in the order of a run; an unknown name is an error."""
    wanted = set(names)
    unknown = wanted - {s.name for s in steps}
    if unknown:
        raise ValueError(f"unknown steps {sorted(unknown)}; known are {[s.name for s in steps]}")
    return [s for s in steps if s.name in wanted]


def preflight(names: Iterable[str], exists: Callable[[str], bool], has_setting: Callable[[str], bool] = lambda _: True) -> list[str]:
    """What is missing for a run of the named steps; empty if it may start.

    An input counts as there if it exists or an earlier step of this run writes it.
    """
    made: set[str] = set()
    faults = []
    for s in in_order(names):
        faults += [f"{s.name}: no {x}" for x in s.reads if x not in made and not exists(x)]
        faults += [f"{s.name}: no {x}" for x in s.settings if not has_setting(x)]
        made |= set(s.writes)
    return faults


def degraded(names: Iterable[str], exists: Callable[[str], bool]) -> list[str]:
    """Optional inputs that a run would do without."""
    made: set[str] = set()
    out = []
    for s in in_order(names):
        out += [f"{s.name}: {x}" for x in s.may_read if x not in made and not exists(x)]
        made |= set(s.writes)
    return out

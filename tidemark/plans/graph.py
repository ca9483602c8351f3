"""A graph of models: each is built from others, and what several of them need is made once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.session import write_through


@dataclass(frozen=True)
class Model:
    """``build`` gets the DataFrames of ``parents``, in their order."""

    name: str
    parents: tuple[str, ...]
    build: Callable[..., DataFrame]


def run_graph(
    models: Iterable[Model],
    sources: Mapping[str, DataFrame],
    wanted: Iterable[str],
    keep: Callable[[str, DataFrame], DataFrame] | None = None,
    always: Iterable[str] = (),
    at_once: int = 4,
) -> dict[str, DataFrame]:
    """The wanted models, and all that they are made from.

    A source or model that several others are built from, or that is both wanted and
    built from, is written once and read back; what one other needs becomes part of its
    plan. Models whose parents are there are made at the same time, ``at_once`` of them.
    ``keep`` says how a name is written, to the shared folder by default; names in
    ``always`` are written however few need them.
    """
    by_name = {m.name: m for m in models}
    wanted = list(dict.fromkeys(wanted))
    keep = keep or (lambda name, df: write_through(df, name))
    needed, open_names = set(), list(wanted)
    while open_names:
        name = open_names.pop()
        if name in needed:
            continue
        if name not in by_name and name not in sources:
            raise KeyError(f"no model and no source is called {name!r}")
        needed.add(name)
        open_names += by_name[name].parents if name in by_name else ()
    uses = Counter(p for name in needed if name in by_name for p in dict.fromkeys(by_name[name].parents))
    uses.update(wanted)
    always = set(always)

    def make(name: str) -> DataFrame:
        model = by_name.get(name)
        df = sources[name] if model is None else model.build(*[done[p] for p in model.parents])
        return keep(name, df) if uses[name] > 1 or name in always else df

    done: dict[str, DataFrame] = {}
    with ThreadPoolExecutor(at_once) as pool:
        running = {}
        while len(done) < len(needed):
            ready = [
                n for n in sorted(needed - set(done) - set(running.values()))
                if all(p in done for p in (by_name[n].parents if n in by_name else ()))
            ]
            running.update({pool.submit(make, n): n for n in ready})
            if not running:
                raise ValueError(f"these models wait for each other: {sorted(needed - set(done))}")
            finished, _ = wait(running, return_when=FIRST_COMPLETED)
            for job in finished:
                done[running.pop(job)] = job.result()
    return done

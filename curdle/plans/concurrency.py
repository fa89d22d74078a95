"""Run independent Spark jobs concurrently from a small driver thread pool.

Independent models (e.g. the 12 silver models, or the marts) share no data, so
their jobs can run side by side; Spark schedules their stages together and
cores stay busy while any one job waits on a stage boundary. Four workers, like
the reference's model threads.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

K = TypeVar("K")
V = TypeVar("V")

DEFAULT_WORKERS = 4


def run_all(tasks: Iterable[tuple[K, Callable[[], V]]], workers: int = DEFAULT_WORKERS) -> dict[K, V]:
    """Run ``(key, thunk)`` pairs concurrently; results keyed like the input, first error re-raised."""
    tasks = list(tasks)
    if workers <= 1 or len(tasks) <= 1:
        return {k: fn() for k, fn in tasks}
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = [(k, pool.submit(fn)) for k, fn in tasks]
        return {k: f.result() for k, f in futures}

"""Side-by-side Spark actions."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

T = TypeVar("T")

AT_ONCE = 4


def together(calls: Iterable[Callable[[], T]]) -> list[T]:
    """Run independent actions side by side, so that small ones do not leave the cluster idle.

    Results keep the order of the calls. All calls are finished when the first failure,
    if any, is raised.
    """
    with ThreadPoolExecutor(max_workers=AT_ONCE) as pool:
        running = [pool.submit(call) for call in calls]
    return [done.result() for done in running]

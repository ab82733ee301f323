"""Concurrent submission of independent Spark jobs.

Tables of one layer do not depend on each other, so their jobs are submitted
from a small thread pool (the scheduler interleaves their stages on the
executors).  This is job-level concurrency only; each job is a normal
distributed plan."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

T = TypeVar("T")

DEFAULT_THREADS = 8


def run_all(tasks: dict[str, Callable[[], T]], threads: int = DEFAULT_THREADS) -> dict[str, T]:
    if threads <= 1 or len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(threads, len(tasks))) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}

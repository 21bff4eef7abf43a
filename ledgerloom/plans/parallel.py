"""Submit independent Spark jobs concurrently (like a model runner's ``threads`` setting).

Each callable triggers one action (a table write). DataFrames are built on
the calling thread first; worker threads only submit actions, which Spark's
scheduler runs side by side, so small jobs do not queue behind each other.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Callable


def run_concurrently(tasks: dict[str, Callable[[], object]], threads: int = 4) -> dict[str, object]:
    """Run ``tasks`` with at most ``threads`` in flight; re-raise the first
    failure (by submission order) after all have finished."""
    if threads <= 1 or len(tasks) <= 1:
        return {name: fn() for name, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=threads) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        results, first_error = {}, None
        for name, fut in futures.items():
            try:
                results[name] = fut.result()
            except Exception as e:  # noqa: BLE001 - re-raised below
                first_error = first_error or e
        if first_error is not None:
            raise first_error
        return results

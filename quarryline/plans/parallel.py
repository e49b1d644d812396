"""Independent steps side by side: each begins when those it needs are done, in a scheduler pool of its own."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from graphlib import TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

DONE, FAILED, SKIPPED = "done", "failed", "skipped"


def run_graph(spark: SparkSession, steps: Mapping[str, Callable[[], object]], needs: Mapping[str, set[str]], at_once: int = 4) -> dict[str, tuple[str, str]]:
    """(outcome, detail) of every step. A step that fails cuts off those that need it, and no others.

    Spark runs the jobs of the threads together; with spark.scheduler.mode=FAIR each pool gets its share of the executors, so
    that a short build is not held up by a long one.
    """
    order = TopologicalSorter({name: needs.get(name, set()) & steps.keys() for name in steps})
    order.prepare()
    out: dict[str, tuple[str, str]] = {}

    def run(name: str) -> str:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        spark.sparkContext.setJobDescription(name)
        return str(steps[name]() or "")

    running: dict[Future, str] = {}
    with ThreadPoolExecutor(at_once) as pool:
        while order.is_active():
            for name in order.get_ready():
                lost = sorted(n for n in needs.get(name, set()) & steps.keys() if out[n][0] != DONE)
                if lost:
                    out[name] = (SKIPPED, f"needs {', '.join(lost)}")
                    order.done(name)
                else:
                    running[pool.submit(inheritable_thread_target(spark)(run), name)] = name
            if running:
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    name = running.pop(future)
                    error = future.exception()
                    out[name] = (DONE, future.result()) if error is None else (FAILED, f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}")
                    order.done(name)
    return out

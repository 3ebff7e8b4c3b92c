"""Jobs in the order of what they read."""

from __future__ import annotations

from collections.abc import Callable, Collection, Hashable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from graphlib import TopologicalSorter
from typing import TypeVar

Node = TypeVar("Node", bound=Hashable)
Result = TypeVar("Result")


def with_upstream(reads: Mapping[Node, Collection[Node]], wanted: Iterable[Node]) -> set[Node]:
    """The wanted nodes and all that they read, directly or not."""
    found, open_ = set(), list(wanted)
    while open_:
        node = open_.pop()
        if node not in found:
            found.add(node)
            open_.extend(reads[node])
    return found


def run_in_order(
    reads: Mapping[Node, Collection[Node]], job: Callable[[Node, dict[Node, Result]], Result]
) -> dict[Node, Result]:
    """One job per node, as soon as those that it reads are done; independent ones run side by side.

    A job gets the results of the nodes that it reads. A failure stops what depends on it, lets the
    rest finish, and is raised. A cycle is a ValueError, before anything runs.
    """
    order = list(TopologicalSorter(reads).static_order())
    if not order:
        return {}
    with ThreadPoolExecutor(len(order)) as pool:
        running = {}

        def run(node: Node) -> Result:
            return job(node, {n: running[n].result() for n in reads[node]})

        for node in order:
            running[node] = pool.submit(run, node)
    return {node: future.result() for node, future in running.items()}

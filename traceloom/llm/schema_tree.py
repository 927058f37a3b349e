"""Edit distance between nested schemas.

A schema is a tree: inner nodes are objects, leaves are fields. Children have no
order, so the distance is the constrained one: the children of two matched nodes
are matched by a minimum-cost assignment, whose pair costs are the distances of
their subtrees. What the assignment leaves over is deleted or added; a deleted
leaf whose values reappear under another parent is a move.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

#: Cost of adding or deleting a leaf, of a rename, and of keeping a name whose
#: values all belong to others; the least share of equal values for a rename.
EDGE, RENAME, ESTRANGED, LEAST = 1.0, 0.3, 0.9, 0.5
NEVER = 1e6


@dataclass
class Node:
    name: str
    path: str
    children: list["Node"] = field(default_factory=list)

    def leaves(self) -> list["Node"]:
        return [self] if not self.children else [x for c in self.children for x in c.leaves()]


def build(paths: list[str]) -> Node:
    """Tree of the dotted field paths."""
    root = Node("", "")
    for path in sorted(paths):
        at, sofar = root, ""
        for part in path.split("\x1f"):
            sofar = f"{sofar}\x1f{part}" if sofar else part
            nxt = next((c for c in at.children if c.name == part), None)
            if nxt is None:
                nxt = Node(part, sofar)
                at.children.append(nxt)
            at = nxt
    return root


def assignment(cost: list[list[float]]) -> list[int]:
    """Column of each row in a square minimum-cost assignment (shortest paths)."""
    n = len(cost)
    inf = float("inf")
    u, v, match, way = [0.0] * (n + 1), [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, used = [inf] * (n + 1), [False] * (n + 1)
        while True:
            used[j0] = True
            i0, delta, j1 = match[j0], inf, 0
            for j in range(1, n + 1):
                if not used[j]:
                    c = cost[i0 - 1][j - 1] - u[i0] - v[j]
                    if c < least[j]:
                        least[j], way[j] = c, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(n + 1):
                if used[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    out = [0] * n
    for j in range(1, n + 1):
        out[match[j] - 1] = j - 1
    return out


Affinity = Callable[[str, str], "float | None"]


def distance(a: Node, b: Node, affinity: Affinity) -> tuple[float, list[tuple[str, str]]]:
    """(cost, matched leaf paths) of the cheapest constrained edit script."""
    if not a.children and not b.children:
        agree = affinity(a.path, b.path)
        if a.name == b.name:
            return (ESTRANGED if agree is not None and agree < LEAST else 0.0), [(a.path, b.path)]
        if agree is None or agree < LEAST:
            return NEVER, []
        return RENAME + (1 - agree), [(a.path, b.path)]
    if not a.children or not b.children:
        return NEVER, []
    n, m = len(a.children), len(b.children)
    below = [[distance(x, y, affinity) for y in b.children] for x in a.children]
    size = n + m
    cost = [[0.0] * size for _ in range(size)]
    for i in range(size):
        for j in range(size):
            if i < n and j < m:
                same = a.children[i].name == b.children[j].name or not a.children[i].children
                cost[i][j] = below[i][j][0] + (0.0 if same else RENAME)
            elif i < n:
                cost[i][j] = EDGE * len(a.children[i].leaves())
            elif j < m:
                cost[i][j] = EDGE * len(b.children[j].leaves())
    chosen = assignment(cost)
    total, pairs = 0.0, []
    for i in range(size):
        total += cost[i][chosen[i]]
        if i < n and chosen[i] < m and cost[i][chosen[i]] < NEVER:
            pairs += below[i][chosen[i]][1]
    return total, pairs


def script(before: list[str], after: list[str], affinity: Affinity) -> list[tuple[str, str, str]]:
    """(kind, before, after) with kind kept, renamed, moved, removed or added."""
    _, pairs = distance(build(before), build(after), affinity) if before and after else (0.0, [])
    gone = sorted(set(before) - {x for x, _ in pairs})
    new = sorted(set(after) - {y for _, y in pairs})
    parent = lambda p: p.rpartition("\x1f")[0]
    out = [("kept" if x == y else "renamed", x, y) for x, y in pairs]
    candidates = sorted(
        ((-(affinity(x, y) or 0.0), x, y) for x in gone for y in new if parent(x) != parent(y) and (affinity(x, y) or 0.0) >= LEAST)
    )
    moved_from, moved_to = set(), set()
    for _, x, y in candidates:
        if x not in moved_from and y not in moved_to:
            moved_from.add(x)
            moved_to.add(y)
            out.append(("moved", x, y))
    out += [("removed", x, "") for x in gone if x not in moved_from]
    return out + [("added", "", y) for y in new if y not in moved_to]

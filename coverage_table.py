"""Writes COVERAGE.md anew: which queries reach the function of each operator, by the calls in the package's source.

The operators, their functions and names are read from COVERAGE.md itself; the
last column is found: the queries with SQL whose calls lead to every function
of the operator, then those that have no SQL.
"""

from __future__ import annotations

import ast
import os
import re
import sys
from pathlib import Path

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE))
PARTS = ("functions", "operators", "sources", "streaming", "plans")


def calls() -> dict[str, set[str]]:
    """For each function of the package, as ``part.module.name``, the names of the package that it mentions."""
    out: dict[str, set[str]] = {}
    for part in PARTS:
        for path in sorted((HERE / "lectern" / part).glob("*.py")):
            module = f"{part}.{path.stem}"
            tree = ast.parse(path.read_text())
            known: dict[str, str] = {}
            for node in ast.walk(tree):
                if isinstance(node, ast.ImportFrom) and (node.module or "").startswith("lectern"):
                    base = ".".join((node.module or "").split(".")[1:])
                    for a in node.names:
                        known[a.asname or a.name] = f"{base}.{a.name}" if base else a.name
            own = {n.name for n in tree.body if isinstance(n, ast.FunctionDef)} | {t.id for n in tree.body if isinstance(n, ast.Assign) for t in n.targets if isinstance(t, ast.Name)}
            for node in tree.body:
                names = [node.name] if isinstance(node, ast.FunctionDef) else [t.id for t in node.targets if isinstance(t, ast.Name)] if isinstance(node, ast.Assign) else []
                for name in names:
                    found = out.setdefault(f"{module}.{name}", set())
                    for x in ast.walk(node):
                        if isinstance(x, ast.Attribute) and isinstance(x.value, ast.Name) and x.value.id in known:
                            found.add(f"{known[x.value.id]}.{x.attr}")
                        elif isinstance(x, ast.Name) and x.id in known:
                            found.add(known[x.id])
                        elif isinstance(x, ast.Name) and x.id in own and x.id != name:
                            found.add(f"{module}.{x.id}")
    return out


def reached(start: str, graph: dict[str, set[str]]) -> set[str]:
    seen, todo = set(), [start]
    while todo:
        at = todo.pop()
        if at not in seen:
            seen.add(at)
            todo += graph.get(at, ())
    return seen


def main() -> None:
    from lectern.plans import catalog

    graph = calls()
    module = {name: f"plans.{f.__module__.rsplit('.', 1)[1]}.{name}" for name, f in catalog.QUERIES.items()}
    reach = {name: reached(at, graph) for name, at in module.items()}
    lines = (HERE / "COVERAGE.md").read_text().split("\n")
    out, proven, rows = [], 0, 0
    for line in lines:
        m = re.match(r"\| ([A-J]\d+) \| `([^`]*)` \| (.*?) \| [^|]* \|$", line)
        if not m:
            out.append(line)
            continue
        rows += 1
        wanted = [w.strip() for w in m[2].split(",")]
        lost = [w for w in wanted if w not in graph]
        if lost:
            print("no such function:", m[1], *lost)
        with_sql = sorted(n for n in reach if n in catalog.ORACLES and all(w in reach[n] for w in wanted))
        if not with_sql:  # each of its functions by a query of its own
            each = [sorted(n for n in reach if n in catalog.ORACLES and w in reach[n]) for w in wanted]
            with_sql = sorted({e[0] for e in each}) if all(each) else []
        others = sorted(n for n in reach if n not in catalog.ORACLES and all(w in reach[n] for w in wanted))
        proven += bool(with_sql)
        shown = with_sql[:4] + [f"({n}: no SQL)" for n in others[:2]]
        out.append(f"| {m[1]} | `{m[2]}` | {m[3]} | {', '.join(shown) or 'none (unit test)'} |")
    text = "\n".join(out)
    text = re.sub(r"(?m)^Of \d+ operators .*$", f"Of {rows} operators {proven} are reached by a query whose rows equal its SQL.", text)
    (HERE / "COVERAGE.md").write_text(text)
    print(rows, proven)


if __name__ == "__main__":
    os.chdir(HERE)
    main()

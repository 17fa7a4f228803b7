"""Plain-SQL statements of the registered queries, for comparison with another engine on the same tables.

They restate each query in the most direct form (plain windows, recursion for sequential rules), apart from
the Spark operators.
"""

from __future__ import annotations

import re

from timelane.sources.derived import PROJECTIONS, SEQUENCED_SQL


def _plain(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", text).replace(" AS STRING)", " AS VARCHAR)")


# name -> SQL of a named step; steps may use each other.
STEPS: dict[str, str] = {**{k: _plain(v) for k, v in PROJECTIONS.items()}, **SEQUENCED_SQL}


def with_steps(query: str) -> str:
    """Prefix ``query`` with every step it uses, directly or not, in dependency order."""
    ordered: list[str] = []

    def visit(text: str, open_steps: tuple[str, ...]) -> None:
        for name in STEPS:
            if name in open_steps or name in ordered:
                continue
            if re.search(rf"\b{name}\b", text):
                visit(STEPS[name], (*open_steps, name))
                ordered.append(name)

    visit(query, ())
    if not ordered:
        return query
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({STEPS[name]})" for name in ordered) + "\n" + query

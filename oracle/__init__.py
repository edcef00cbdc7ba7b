"""DuckDB oracle SQL for the correctness gate.

Composable CTE fragments: each fragment names the fragments it reads; `sql()`
emits them in dependency order in one WITH clause. The fixture and the
engineered table are derived from the driver's `customer` and `orders`
views exactly as `retentio.sources.fixture` derives them in Spark.
"""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = (deps, body)


def sql(body: str, *needed: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    if not order:
        return body
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body


from . import fragments  # noqa: E402,F401  (registers CTEs)

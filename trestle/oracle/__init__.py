"""Independent DuckDB SQL for every registered query.

Each query lives in ``sql/<key>.sql``.  Analogs referenced as ``fx_*`` are prepended as CTEs from
``trestle.oracle.fixtures`` (plus the extra analogs defined in ``extra_fixtures``), in dependency order.
"""

from __future__ import annotations

import re
from pathlib import Path

from trestle.oracle.fixtures import FIXTURE_DEPS, FIXTURE_SQL

SQL_DIR = Path(__file__).parent / "sql"
#: Analogs that are large next to their base table and joined with themselves: made once, so joins see plain columns.
MATERIALIZED = {"fx_task"}
_FX = re.compile(r"\bfx_\w+\b")


def _all_fixtures() -> dict[str, str]:
    from trestle.oracle.extra_fixtures import EXTRA_DEPS, EXTRA_SQL

    deps = {**FIXTURE_DEPS, **EXTRA_DEPS}
    return {**FIXTURE_SQL, **EXTRA_SQL}, deps


def _order(names, deps):
    order = []

    def visit(n):
        for d in deps.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return order


_Q = re.compile(r"\bq_(\w+)\b")


def compose(body: str) -> str:
    """Prefix ``body`` with the analog CTEs it references (``fx_*``) and with other oracle queries it reads as
    ``q_<key>`` (each composed on its own, so the CTE nests its own analogs)."""
    sqls, deps = _all_fixtures()
    used = sorted({m for m in _FX.findall(body) if m in sqls})
    queries = sorted({m for m in _Q.findall(body) if (SQL_DIR / f"{m}.sql").exists()})
    if not used and not queries:
        return body.strip()
    parts = [f"{n} AS {'MATERIALIZED ' if n in MATERIALIZED else ''}({sqls[n].strip()})" for n in _order(used, deps)]
    parts += [f"q_{m} AS ({compose((SQL_DIR / f'{m}.sql').read_text())})" for m in queries]
    ctes = ",\n".join(parts)
    stripped = body.lstrip()
    if stripped[:4].lower() == "with":
        return f"WITH {ctes},\n{stripped[4:].lstrip()}"
    return f"WITH {ctes}\n{stripped}"


def oracle_queries() -> dict[str, str]:
    return {p.stem: compose(p.read_text()) for p in sorted(SQL_DIR.glob("*.sql"))}

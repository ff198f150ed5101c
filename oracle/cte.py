"""Tiny helper to compose oracle SQL from named CTEs.

Each CTE is registered with its body; ``sql(final, *names)`` emits a WITH
clause holding the named CTEs and everything they reference (found by name
in the body), in dependency order.  This is string assembly only.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def _deps(body: str) -> list[str]:
    found = []
    for name in CTES:
        if re.search(rf"\b{re.escape(name)}\b", body):
            found.append(name)
    return found


def chain(*roots: str) -> list[str]:
    """CTE names needed by the roots, in dependency order."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for dep in _deps(CTES[name]):
            if dep != name:
                visit(dep)
        order.append(name)

    for r in roots:
        visit(r)
    return order


def snapshot_ctes(root: str, suffix: str, table_subst: dict[str, str]) -> list[tuple[str, str]]:
    """Copies of root's CTE chain renamed with ``suffix`` and reading other
    base tables (e.g. orders → orders_s), for a second state of the sources."""
    names = chain(root)
    out = []
    for n in names:
        body = CTES[n]
        for m in sorted(names, key=len, reverse=True):
            body = re.sub(rf"\b{re.escape(m)}\b", m + suffix, body)
        for a, b in table_subst.items():
            body = re.sub(rf"\b{re.escape(a)}\b", b, body)
        out.append((n + suffix, body))
    return out


def sql_with(extra: list[tuple[str, str]], final: str, *roots: str) -> str:
    """Like sql(), plus extra (name, body) CTEs placed first."""
    base = sql(final, *roots)
    head = ",\n".join(f"{n} AS (\n{b}\n)" for n, b in extra)
    if base.startswith("WITH "):
        return f"WITH {head},\n{base[5:]}"
    return f"WITH {head}\n{base}"


def sql(final: str, *roots: str) -> str:
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str, stack: tuple[str, ...] = ()) -> None:
        if name in seen:
            return
        if name in stack:
            raise ValueError(f"cycle through {name}")
        for dep in _deps(CTES[name]):
            if dep != name:
                visit(dep, stack + (name,))
        seen.add(name)
        order.append(name)

    for root in list(roots) + [n for n in _deps(final)]:
        visit(root)
    if not order:
        return final.strip()
    parts = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order)
    return f"WITH {parts}\n{final.strip()}"


# ---- expression helpers (integer-exact rounding; DuckDB divides decimals in
# double precision, so every rounded quotient is computed on integers) ------


def rdiv(num: str, den: str, scale: int, precision: int = 38) -> str:
    """round_half_away_from_zero(num / den, scale) as DECIMAL(precision, scale);
    null when den is 0 or null.  num and den must be integer expressions."""
    f = 10**scale
    q = (
        f"(sign({num}) * sign({den}) * ((2 * abs(CAST({num} AS HUGEINT)) * {f} + abs(CAST({den} AS HUGEINT)))"
        f" // (2 * abs(CAST({den} AS HUGEINT)))))"
    )
    unit = f"CAST({1 / f if scale else 1} AS DECIMAL({scale + 1},{scale}))" if scale else "1"
    val = f"(CAST({q} AS DECIMAL(38,0)) * {unit})"
    return f"(CASE WHEN {den} <> 0 THEN CAST({val} AS DECIMAL({precision},{scale})) END)"


def cents(x: str, scale: int = 2) -> str:
    """Exact integer of a decimal scaled by 10**scale."""
    return f"CAST(({x}) * {10**scale} AS HUGEINT)"

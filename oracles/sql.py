"""Text helpers for the check queries, and the assembly of their common table expressions."""

from __future__ import annotations

import re


def quo(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0))"


def dec(x: str, places: int) -> str:
    """Half-up rounding kept as a decimal."""
    return f"round(CAST({x} AS DECIMAL(28,10)), {places})"


def rnd(x: str, places: int) -> str:
    return f"CAST({dec(x, places)} AS DOUBLE)"


def pct(n: str, d: str, places: int) -> str:
    return rnd(f"{quo(n, d)} * 100", places)


def rat(n: str, d: str, places: int) -> str:
    return rnd(quo(n, d), places)


def avg(x: str) -> str:
    return quo(f"sum({x})", f"count({x})")


def dbl(*names: str) -> str:
    """Named columns as doubles."""
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def f8(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def money(x: str) -> str:
    return f"CAST({dec(x, 2)} AS DECIMAL(18,4))"


def cents(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def hours(a: str, b: str) -> str:
    return f"CAST((epoch_us({b}) - epoch_us({a})) / 3.6e9 AS DECIMAL(18,8))"


def days(a: str, b: str) -> str:
    return f"CAST((epoch_us({b}) - epoch_us({a})) / 8.64e10 AS DECIMAL(18,8))"


def clock(ts: str) -> str:
    return f"(hour({ts}) * 3600 + minute({ts}) * 60 + second({ts}))"


def pick(values: list[str], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[CAST(({index}) % {len(values)} AS BIGINT) + 1]"


def choose(column: str, mapping: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {arms} END"


def with_tables(query: str, tables: dict[str, str]) -> str:
    """Prefix the query with the tables it uses, inputs first."""
    needed: dict[str, str] = {}

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b(?:b|t)_[a-z_0-9]+\b", text)):
            if name in tables and name not in needed:
                visit(tables[name])
                needed[name] = tables[name]

    visit(query)
    if not needed:
        return query
    listed = ",\n".join(f"{name} AS ({text.strip()})" for name, text in needed.items())
    return f"WITH {listed}\n{query.strip()}"

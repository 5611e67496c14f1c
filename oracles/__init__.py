"""DuckDB SQL for the registered queries, written apart from the library's plans."""

from __future__ import annotations


def all_oracles() -> dict[str, str]:
    from oracles import cleaning, governance, learning, profiling, warehouse

    out: dict[str, str] = {}
    for part in (cleaning, warehouse, profiling, governance, learning):
        out |= part.ORACLES
    return out

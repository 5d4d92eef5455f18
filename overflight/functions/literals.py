"""Python values as SQL text."""

from __future__ import annotations

from datetime import date


def sql_literal(value: str | float | bool | date | None) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, date):
        return f"DATE'{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)

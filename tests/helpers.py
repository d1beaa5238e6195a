"""Small readers of plans and results."""

from __future__ import annotations

import contextlib
import io


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def exchanged_columns(df) -> list[str]:
    """The Input lines of all exchanges of a formatted plan."""
    lines, found = plan_of(df).splitlines(), []
    for i, line in enumerate(lines):
        if line.startswith("(") and "Exchange" in line and i + 1 < len(lines):
            found.append(lines[i + 1])
    return found


def tuples(df, *cols) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)

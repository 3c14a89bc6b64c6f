"""Plain SQL for every query that SQL can express.

The statements are written against the raw tables on their own, not derived
from the Spark code. ``statements`` puts the shared ``WITH`` parts a statement
names in front of it.
"""

from __future__ import annotations

import re

from oracle.kpis import KPIS
from oracle.parts import PARTS
from oracle.rows import ROWS


def _needed(text: str) -> list[str]:
    """Shared parts that ``text`` uses, each after the ones it builds on."""
    out: list[str] = []
    for name in PARTS:
        if re.search(rf"\b{name}\b", text):
            for part in [*_needed(PARTS[name]), name]:
                if part not in out:
                    out.append(part)
    return out


def statements() -> dict[str, str]:
    out = {}
    for key, body in {**ROWS, **KPIS}.items():
        body = body.strip()
        parts = [f"{name} AS ({PARTS[name].strip()})" for name in _needed(body)]
        if body.startswith("WITH "):
            # The statement has parts of its own; they follow the shared ones.
            own, body = body[len("WITH ") :], ""
            parts.append(own)
        out[key] = ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
    return out

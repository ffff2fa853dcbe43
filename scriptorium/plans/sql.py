"""Helpers to state the same constants in DuckDB SQL (the oracle side)."""

from __future__ import annotations


def lit(s: str) -> str:
    """A DuckDB string expression equal to ``s``.

    Printable characters go into a quoted literal; control characters and
    the Unicode line/space separators become ``chr(n)`` so the SQL text stays
    one line and no escape rules differ between engines.
    """
    parts: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if run:
            parts.append("'" + "".join(run).replace("'", "''") + "'")
            run.clear()

    for ch in s:
        cp = ord(ch)
        if cp < 0x20 or 0x7F <= cp <= 0xA0 or ch.isspace() and ch != " " or cp in (0x2028, 0x2029, 0xFEFF):
            flush()
            parts.append(f"chr({cp})")
        else:
            run.append(ch)
    flush()
    if not parts:
        return "''"
    return parts[0] if len(parts) == 1 else "(" + " || ".join(parts) + ")"


def regex(pattern: str) -> str:
    """A regex pattern as a plain literal (patterns here are printable ASCII)."""
    assert all(0x20 <= ord(c) < 0x7F for c in pattern), pattern
    return "'" + pattern.replace("'", "''") + "'"

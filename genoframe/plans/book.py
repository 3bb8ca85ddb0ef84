"""The book of queries: name -> (function, SQL)."""

from __future__ import annotations

from collections.abc import Callable

BOOK: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Enter a function of (spark, sf_dir) into the book, with the SQL that gives the same rows."""

    def enter(f: Callable) -> Callable:
        BOOK[name] = f, sql
        return f

    return enter

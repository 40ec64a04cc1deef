"""The engine's calls as coroutines: each runs in a thread, so many can be under way on one session."""

from __future__ import annotations

import asyncio
from typing import Any

from .engine import Engine


class AsyncEngine:
    def __init__(self, *args: Any, **kw: Any):
        self.engine = Engine(*args, **kw)

    async def __aenter__(self) -> AsyncEngine:
        return self

    async def __aexit__(self, *exc) -> None:
        await self.close()

    async def close(self) -> None:
        await asyncio.to_thread(self.engine.close)

    def __getattr__(self, name: str):
        if name not in ("is_alive", "execute", "fetch", "fetchrow", "fetchone", "fetchval", "insert_file"):
            raise AttributeError(name)
        return lambda *args, **kw: asyncio.to_thread(getattr(self.engine, name), *args, **kw)

    async def iterate(self, query: str, *args: Any, **kw: Any):
        rows, end = self.engine.iterate(query, *args, **kw), object()
        while (row := await asyncio.to_thread(next, rows, end)) is not end:
            yield row

    cursor = iterate

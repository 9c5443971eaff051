"""What a Python worker remembers from task to task.

Workers are used again by later stages and by other operators. So a task says whose memory it uses, and what the
others have left is emptied first; results do not depend on it.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

_owners: dict[str, list[Callable[[], None]]] = {}
_current: str | None = None


def remembers(owner: str, clear: Callable[[], None]) -> None:
    """`clear` empties something that `owner` keeps in this worker."""
    _owners.setdefault(owner, []).append(clear)


def begin(owner: str) -> None:
    """A task of `owner` starts."""
    global _current
    if owner != _current:
        for other, clears in _owners.items():
            if other != owner:
                for clear in clears:
                    clear()
        _current = owner
        release()


def release() -> None:
    """What Arrow holds free goes back to the system; it would keep tens of MB for each worker."""
    pa.default_memory_pool().release_unused()

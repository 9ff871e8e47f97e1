"""A bounded cache for values that a text gives."""

from __future__ import annotations

from collections.abc import Callable


class Cache(dict):
    """Text -> what ``make`` gives for it, in two generations.

    When the young generation holds ``most`` entries it becomes the old one, and
    the old one goes; what is looked up again in the old one is young again.
    Texts of over ``longest`` characters are not kept.
    """

    def __init__(self, make: Callable[[str], bytes], most: int = 300_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest
        self.old: dict[str, bytes] = {}

    def put(self, key: str, made: bytes) -> None:
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = made

    def __missing__(self, key: str) -> bytes:
        made = self.old.get(key)
        if made is None:
            made = self.make(key)
        self.put(key, made)
        return made

"""Bounded memories of computed values, for one worker."""

from __future__ import annotations

from collections.abc import Callable, Hashable


class Recent:
    """Values by key in two generations of at most `most` keys (and one batch) each.

    When the younger one is full it becomes the older one, and keys that are asked for again move over;
    so what is used often stays, and memory is bounded whatever the input.
    """

    def __init__(self, most: int):
        self.most = most
        self.now: dict = {}
        self.before: dict = {}

    def lacking(self, keys: set) -> list:
        """Keys without a value. After they are set in `now`, it holds all `keys`."""
        new = [k for k in keys if k not in self.now]  # a difference with the keys view would walk all of them
        if new and len(self.now) + len(new) > self.most:
            self.before, self.now = self.now, {}
            new = keys
        out = []
        for k in new:
            v = self.before.get(k)
            if v is None:
                out.append(k)
            else:
                self.now[k] = v
        return out


class Computed(dict):
    """A memory that computes a value when its key is first looked up, in two generations of at most `most` keys each."""

    def __init__(self, most: int, compute: Callable[[Hashable], object]):
        super().__init__()
        self.most, self.compute, self.before = most, compute, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value

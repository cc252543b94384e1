"""A bounded memory of results for words, filled for many words at a time, and groups of texts to fill it for."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator


class Memory:
    """Two generations of remembered results; the older goes when the younger is full, so frequent words stay.

    Both have at most ``most`` results, and if ``most_bytes`` is given about that many bytes of strings each.
    """

    #: What Python needs for an entry besides the characters of a word and the bytes of its result.
    ENTRY_BYTES = 180

    def __init__(self, make: Callable[[list], Iterable], most: int = 250_000, most_bytes: int | None = None):
        self.make, self.most, self.most_bytes = make, most, most_bytes
        self.now: dict = {}
        self.old: dict = {}
        self.bytes = 0

    def fill(self, keys: set) -> Callable:
        """The lookup of ``keys``; what isn't remembered is made in one call."""
        if len(self.now) >= self.most or (self.most_bytes and self.bytes >= self.most_bytes):
            self.old, self.now, self.bytes = self.now, {}, 0
        fresh = keys.difference(self.now)
        known = list(filter(self.old.__contains__, fresh))  # intersection() would walk through a whole dict
        missing = list(fresh.difference(known))
        for some, values in ((known, list(map(self.old.__getitem__, known))), (missing, list(self.make(missing)) if missing else [])):
            self.now.update(zip(some, values))
            if self.most_bytes:
                self.bytes += sum(map(len, some)) + sum(map(len, values)) + self.ENTRY_BYTES * len(some)
        return self.now.__getitem__


def groups_of(rows: Iterable[tuple], characters: int = 2_000_000) -> Iterator[list[tuple]]:
    """Rows (anything, text) in lists of about so many characters, a longer text in a list of its own."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1]) + 100
        if size >= characters:
            yield held
            held, size = [], 0
    if held:
        yield held

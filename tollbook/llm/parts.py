"""Texts put together from what their parts between spaces give, each distinct part worked out once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts that a memory holds, and as many again of those that were met before them.
WORDS = 600_000
#: Parts of a text that are put together at a time.
BLOCK = 1 << 17


class Memory:
    """Bytes of parts: of the last WORDS that were met and of as many before them; what is met again stays."""

    def __init__(self):
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, part: str) -> bytes | None:
        held = self.new.get(part)
        if held is None and (held := self.old.get(part)) is not None:
            self.new[part] = held
        return held

    def values(self, parts: list[str], learn: Callable[[list[str]], list[bytes | None]]) -> list[bytes | None]:
        """What is held of the parts; what is not is what `learn` gives for them, remembered unless it is None."""
        if len(self.new) > WORDS:
            self.new, self.old = {}, self.new
        found = list(map(self.new.get, parts))
        at = [i for i, x in enumerate(found) if x is None]
        missing = [parts[i] for i in at]
        met = list(map(self.old.get, missing))
        fresh = iter(learn([part for part, x in zip(missing, met) if x is None]))
        for i, part, x in zip(at, missing, met):
            if x is None:
                x = next(fresh)
            if x is not None:
                found[i] = self.new[part] = x
        return found


def put_together(texts: list[str], values: Callable[[list[str]], list[bytes | None]],
                 mark_first: bool = False) -> list[bytes | None]:
    """What the parts of each text give, one after the other; None for a text with a part that gives None.

    `values` is given parts, few of them twice, and gives four bytes for each of their numbers. With `mark_first` the first part
    of a text is given to it with a space in front; no other part holds a space.
    """
    if not texts:
        return []
    first: list[str] = []
    rest: list[str | None] = list(texts)
    if mark_first:
        cut = [text.partition(" ") for text in texts]
        first = [" " + head for head, _, _ in cut]
        rest = [tail if space else None for _, space, tail in cut]
    lists = pc.split_pattern(pa.array(rest, pa.large_string()), " ")
    parts = lists.flatten().dictionary_encode()
    found = values(parts.dictionary.to_numpy(zero_copy_only=False).tolist() + first)
    odd = np.array([x is None for x in found])
    held = [x or b"" for x in found]
    size = np.fromiter(map(len, held), np.int64, len(held)) >> 2
    numbers = np.frombuffer(b"".join(held), np.uint32)
    place = np.cumsum(size) - size
    ends, part = lists.offsets.to_numpy()[1:].astype(np.int64), parts.indices.to_numpy()
    if mark_first:
        ends = ends + np.arange(1, len(texts) + 1)
        begins = np.concatenate([[0], ends[:-1]])
        every = np.empty(ends[-1], np.int32)
        other = np.ones(ends[-1], bool)
        other[begins] = False
        every[begins], every[other] = len(parts.dictionary) + np.arange(len(texts)), part
        part = every
    stops = np.concatenate([[0], np.cumsum(size[part])])
    out = np.empty(stops[-1], np.uint32)
    for a in range(0, len(part), BLOCK):
        own = part[a : a + BLOCK]
        n, lo = size[own], stops[a]
        hi = stops[a + len(own)]
        out[lo:hi] = numbers[np.repeat(place[own] - stops[a : a + len(own)], n) + np.arange(lo, hi)]
    stop = stops[ends].tolist()
    whole = [out[a:b].tobytes() for a, b in zip([0, *stop], stop)]
    if odd.any():
        missed = np.concatenate([[0], np.cumsum(odd[part])])[np.concatenate([[0], ends])]
        whole = [None if a < b else x for x, a, b in zip(whole, missed.tolist(), missed[1:].tolist())]
    return whole

"""Which items of a group spoil it, found by halving."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TypeVar

T = TypeVar("T")


def spoilers(
    items: Sequence[T],
    spoiled: Callable[[Sequence[T]], bool],
    told: Callable[[Sequence[T]], Sequence[T]] = lambda group: (),
) -> list[T]:
    """Items that make ``spoiled`` true for every group that holds them; the whole group is.

    The first spoiler is met by halving a group that is known to hold one, then the rest
    is tried as a whole, and so on: about ``log2(n) + 1`` tries for each of a few spoilers
    among n items. Where so many are found that trying each item costs less, the rest is
    tried one by one, so there are never more than about 2 n tries. Without any spoiler
    (the group failed for another reason) the result is empty.

    ``told`` gives those of a group that its last failure told of. They are tried alone, then
    the rest as a whole, before anything is halved: two tries for each spoiler told of.
    """
    found: list[T] = []
    left = list(items)
    seen = False  # a try has failed on what is left, not only the caller's
    while left:
        depth = max(1, (len(left) - 1).bit_length())
        if found and len(found) * (depth + 1) > len(items):
            return found + [item for item in left if spoiled([item])]
        if named := [item for item in told(left) if spoiled([item])]:
            found += named
            left = [item for item in left if item not in named]
            if left and not (seen := spoiled(left)):
                break
            continue
        suspects, rest = left, []
        while len(suspects) > 1:
            middle = len(suspects) // 2
            head, tail = suspects[:middle], suspects[middle:]
            if spoiled(head):
                suspects, rest, seen = head, tail + rest, True
            else:
                suspects = tail
        if not seen and not spoiled(suspects):
            return found
        found += suspects
        left = rest
        if left and not (seen := spoiled(left)):
            break
    return found

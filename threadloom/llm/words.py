"""Words of a text, and how many of them two texts share in order."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

#: Above so many words, common words are counted before they are put in order.
COUNTED = 120
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased words; case, punctuation and blanks do not count."""
    return _WORD.findall(text.lower()) if text else []


def common_in_order(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, with a bit for each word of ``a``."""
    at: dict[str, int] = defaultdict(int)
    for k, word in enumerate(a):
        at[word] |= 1 << k
    full = (1 << len(a)) - 1
    free = full
    for word in b:
        hit = free & at.get(word, 0)
        if hit:
            free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


def near_same(a: list[str], b: list[str], share: float, counts: tuple[Counter, Counter] | None = None) -> bool:
    """Whether ``share`` of the longer one's words stand in the other in the same order.

    ``counts`` are those of their words, where they are at hand.
    """
    if len(b) < share * len(a) - 1e-9 or len(a) < share * len(b) - 1e-9:
        return False
    if max(len(a), len(b)) > COUNTED:  # common words in any order are quickly counted
        one, other = counts or (Counter(a), Counter(b))
        if sum(min(n, other[w]) for w, n in one.items() if w in other) < share * max(len(a), len(b)) - 1e-9:
            return False
    if len(a) < len(b):
        a, b = b, a
    # ends that agree need no table
    head = 0
    while head < len(b) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < len(b) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    need = share * len(a) - 1e-9 - head - tail
    if need <= 0:
        return True
    return common_in_order(b[head : len(b) - tail], a[head : len(a) - tail]) >= need

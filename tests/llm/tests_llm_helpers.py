"""Brute-force versions shared by the tests."""

import re

from test_near_duplicates import slow_fingerprint  # noqa: F401


def slow_classes(fps, distance):
    """Least reachable member of each number, by a search from every number."""
    label, left = {}, set(fps)
    for f in sorted(fps):
        if f in left:
            left.discard(f)
            front = [f]
            while front:
                a = front.pop()
                label[a] = f
                near = {b for b in left if (a ^ b).bit_count() <= distance}
                left -= near
                front.extend(near)
    return label


def slow_hit(text, items, window=10):
    """Whether a window of any item occurs, by search in the text as a line of words."""
    line = " " + " ".join(words(text)) + " "
    for _, item in items:
        own = words(item)
        size = min(window, len(own))
        if own and any(f" {' '.join(own[k : k + size])} " in line for k in range(len(own) - size + 1)):
            return True
    return False


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

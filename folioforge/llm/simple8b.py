"""Simple-8b coding of unsigned ids in 64-bit words, by numpy.

A word's upper four bits select how many ids share its other sixty. Selector 15
is an escape: the next whole word is one id of more than sixty bits. A block's
payload holds, after a header of five unsigned 32-bit integers (magic, ids,
words, escapes, stride), the word positions of its escapes, then the index of
the first id at every ``STRIDE``-th coded word, then the words. All counts of ids
follow from the selectors at once, so decoding needs no loop over words.
"""

from __future__ import annotations

import numpy as np

#: Fixed values of the coding: ids in a word and bits of each id, by selector.
COUNT = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1], np.int64)
WIDTH = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 64], np.int64)
ESCAPE = 15
STRIDE = 64
MAGIC = 0x42385331


def _choose(ids: np.ndarray) -> np.ndarray:
    """For each position the selector that packs most ids from there."""
    n = len(ids)
    best = np.full(n, ESCAPE, np.int64)
    for s in range(ESCAPE - 1, 0, -1):
        count = int(COUNT[s])
        if count > n:
            break
        wide = ids >> np.uint64(WIDTH[s]) != 0
        total = np.zeros(n + 1, np.int32)
        np.cumsum(wide, out=total[1:])
        fits = total[count:] == total[: n + 1 - count]
        if not fits.any():
            break
        best[: n + 1 - count][fits] = s
    return best


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, positions of escape words, and the first id's index of each coded word."""
    ids = np.ascontiguousarray(ids, np.uint64)
    best = _choose(ids)
    ahead = (np.arange(len(ids)) + COUNT[best]).tolist()
    starts, at, n = [], 0, len(ids)
    while at < n:
        starts.append(at)
        at = ahead[at]
    first = np.array(starts, np.int64)
    chosen = best[first] if n else first
    place = np.arange(len(first)) + np.r_[0, np.cumsum(chosen == ESCAPE)[:-1]] if n else first
    words = np.zeros(len(first) + int((chosen == ESCAPE).sum()), np.uint64)
    for s in np.unique(chosen):
        here = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            words[place[here]] = np.uint64(ESCAPE) << np.uint64(60)
            words[place[here] + 1] = ids[first[here]]
            continue
        value = np.full(len(here), np.uint64(s) << np.uint64(60))
        for j in range(COUNT[s]):
            value |= ids[first[here] + j] << np.uint64(j * WIDTH[s])
        words[place[here]] = value
    return words, place[chosen == ESCAPE], first


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    coded = np.ones(len(words), bool)
    coded[escapes + 1] = False
    place = np.flatnonzero(coded)
    selector = (words[place] >> np.uint64(60)).astype(np.int64)
    count = COUNT[selector]
    first = np.cumsum(count) - count
    ids = np.empty(int(count.sum()), np.uint64)
    for s in np.unique(selector):
        here = np.flatnonzero(selector == s)
        if s == ESCAPE:
            ids[first[here]] = words[place[here] + 1]
            continue
        mask = np.uint64((1 << int(WIDTH[s])) - 1)
        value = words[place[here]]
        for j in range(COUNT[s]):
            ids[first[here] + j] = (value >> np.uint64(j * WIDTH[s])) & mask
    return ids


def to_bytes(ids: np.ndarray) -> bytes:
    words, escapes, first = pack(ids)
    head = np.array([MAGIC, len(ids), len(words), len(escapes), STRIDE], "<u4")
    return b"".join((head.tobytes(), escapes.astype("<u4").tobytes(), first[::STRIDE].astype("<u4").tobytes(), words.astype("<u8").tobytes()))


def _parts(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    head = np.frombuffer(payload, "<u4", 5)
    if head[0] != MAGIC:
        raise ValueError("not a Simple-8b block")
    n_words, n_escapes = int(head[2]), int(head[3])
    escapes = np.frombuffer(payload, "<u4", n_escapes, 20).astype(np.int64)
    n_marks = -(-(n_words - n_escapes) // int(head[4]))
    marks = np.frombuffer(payload, "<u4", n_marks, 20 + 4 * n_escapes)
    words = np.frombuffer(payload, "<u8", n_words, 20 + 4 * (n_escapes + n_marks))
    return head, escapes, marks, words


def from_bytes(payload: bytes) -> np.ndarray:
    head, escapes, _, words = _parts(payload)
    ids = unpack(words, escapes)
    if len(ids) != head[1]:
        raise ValueError("a Simple-8b block is damaged")
    return ids


def span(payload: bytes, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` of a block, decoding only the words between two marks."""
    head, escapes, marks, words = _parts(payload)
    start, end = max(0, start), min(int(head[1]), end)
    if start >= end:
        return np.zeros(0, np.uint64)
    low, high = int(np.searchsorted(marks, start, "right")) - 1, int(np.searchsorted(marks, end, "left"))

    def place(k: int) -> int:
        """Position of the k-th coded word: escapes before it take one word more each."""
        return k + int(np.searchsorted(escapes - np.arange(len(escapes)), k, "left"))

    p, q = place(low * STRIDE), place(high * STRIDE) if high < len(marks) else len(words)
    inside = escapes[(escapes >= p) & (escapes < q)] - p
    return unpack(words[p:q], inside)[start - int(marks[low]) : end - int(marks[low])]

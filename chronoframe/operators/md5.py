"""MD5 of many short texts at once: the numbers of :func:`split.hash_int` without a text for each.

The texts of a block differ only in the digits of one number.  All steps of MD5 run on arrays of 32-bit words, a block of
texts at a time, so that the words stay in the processor's cache.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np

_SHIFT = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_SINE = [int(abs(np.sin(i + 1)) * 2**32) & 0xFFFFFFFF for i in range(64)]
_WORD = [i if i < 16 else (5 * i + 1) % 16 if i < 32 else (3 * i + 5) % 16 if i < 48 else 7 * i % 16 for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def hasher():
    """``hash_ints``, made of functions that reach the workers by value: these need not have this package."""

    def digits_at(lo: int, hi: int, skip: int) -> Iterator[tuple[int, int, dict[int, np.ndarray]]]:
        """``(start, length, words)`` for the runs of numbers in ``[lo, hi)`` that have equally many digits: the words of a message in which the digits stand
        from byte ``skip`` on and all other bytes are 0; only the words that hold a digit."""
        at = lo
        while at < hi:
            length = len(str(at))
            end = min(hi, 10**length)
            words, left = {}, np.arange(at, end, dtype=np.int64)
            for k in range(length - 1, -1, -1):
                left, digit = left // 10, left % 10
                word, byte = divmod(skip + k, 4)
                digit = (digit + 48).astype(np.uint32) << np.uint32(8 * byte)
                words[word] = words[word] | digit if word in words else digit
            yield at, length, words
            at = end

    def md5_words(prefix: bytes, length: int, words: dict[int, np.ndarray], block: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
        """The first two words of the MD5 of ``prefix`` and ``length`` more bytes, which stand in ``words``; at most 55 bytes."""
        size = len(prefix) + length
        fixed = np.frombuffer((prefix + bytes(length) + b"\x80").ljust(56, b"\0") + (8 * size).to_bytes(8, "little"), dtype="<u4").tolist()
        n = len(next(iter(words.values())))
        first, second = np.empty(n, np.uint32), np.empty(n, np.uint32)
        room = [np.empty(min(block, n), np.uint32) for _ in range(6)]
        add, both, either, other, left, right = np.add, np.bitwise_and, np.bitwise_or, np.bitwise_xor, np.left_shift, np.right_shift
        plan = [((_SINE[i] + fixed[_WORD[i]]) & 0xFFFFFFFF, words.get(_WORD[i]), np.uint32(_SHIFT[i]), np.uint32(32 - _SHIFT[i])) for i in range(64)]
        plan = [(np.uint32(c), w, up, down) for c, w, up, down in plan]
        for lo in range(0, n, block):
            hi = min(lo + block, n)
            a, b, c, d, f, g = (x[: hi - lo] for x in room)
            for x, v in zip((a, b, c, d), _START):
                x.fill(v)
            for i, (constant, word, up, down) in enumerate(plan):
                if i < 16:
                    other(c, d, out=f), both(f, b, out=f), other(f, d, out=f)
                elif i < 32:
                    other(b, c, out=f), both(f, d, out=f), other(f, c, out=f)
                elif i < 48:
                    other(b, c, out=f), other(f, d, out=f)
                else:
                    np.invert(d, out=f), either(f, b, out=f), other(f, c, out=f)
                add(a, f, out=a), add(a, constant, out=a)
                if word is not None:
                    add(a, word[lo:hi], out=a)
                left(a, up, out=f), right(a, down, out=g), either(f, g, out=f), add(f, b, out=f)
                a, b, c, d, f = d, f, b, c, a
            add(a, np.uint32(_START[0]), out=first[lo:hi])
            add(b, np.uint32(_START[1]), out=second[lo:hi])
        return first, second

    def hash_ints(prefixes: Sequence[str], lo: int, hi: int) -> Iterator[np.ndarray]:
        """For each prefix the number of the first 12 hex digits of ``md5(prefix || j)`` for every ``j`` in ``[lo, hi)``, ``lo`` not negative.  Prefixes of one length
        share the words of the numbers' digits."""
        known: dict[int, list] = {}
        for prefix in prefixes:
            head = prefix.encode()
            if len(head) + len(str(hi)) > 55:           # more than one block
                yield np.array([int.from_bytes(hashlib.md5(head + b"%d" % j).digest()[:6], "big") for j in range(lo, hi)], dtype=np.uint64)
                continue
            if len(head) not in known:
                known = {len(head): list(digits_at(lo, hi, len(head)))}
            parts = []
            for _, length, words in known[len(head)]:
                first, second = md5_words(head, length, words)
                parts.append((first.byteswap().astype(np.uint64) << np.uint64(16)) | (second.byteswap() >> np.uint32(16)))
            yield np.concatenate(parts) if parts else np.empty(0, np.uint64)

    return hash_ints

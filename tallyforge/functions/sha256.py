"""SHA-256 that can be interrupted: its state is bytes, so one task can go on where another ended. (``hashlib`` keeps its own.)"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable

import numpy as np


def _roots(power: int, count: int) -> list[int]:
    """The first 32 bits of the fractional parts of the square or cube roots of the first primes."""
    primes = [p for p in range(2, 312) if all(p % q for q in range(2, p))][:count]
    out = []
    for p in primes:
        low, high = 0, p << 32  # the largest integer whose power is at most p * 2 ** (32 * power)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if mid**power <= p << (32 * power) else (low, mid - 1)
        out.append(low & 0xFFFFFFFF)
    return out


_K = _roots(3, 64)
#: The state before the first byte: eight words, the number of bytes so far, and those that do not fill a block yet.
START = b"".join(h.to_bytes(4, "big") for h in _roots(2, 8)) + bytes(8)


def _schedule(blocks: np.ndarray) -> np.ndarray:
    """The 64 words of each block with the round constants added, for all blocks at once."""
    w = np.zeros((64, len(blocks)), np.uint32)
    w[:16] = blocks.T
    turn = lambda x, n: (x >> np.uint32(n)) | (x << np.uint32(32 - n))
    for i in range(16, 64):
        a, b = w[i - 15], w[i - 2]
        w[i] = w[i - 16] + (turn(a, 7) ^ turn(a, 18) ^ (a >> np.uint32(3))) + w[i - 7] + (turn(b, 17) ^ turn(b, 19) ^ (b >> np.uint32(10)))
    return (w + np.array(_K, np.uint32)[:, None]).T


def _blocks_here(h: list[int], data: bytes, whole: int, step: int = 1 << 14) -> list[int]:
    """The same in Python, where there is no such library."""
    words = np.frombuffer(data, ">u4", whole * 16).astype(np.uint32).reshape(whole, 16)
    mask = 0xFFFFFFFF
    for first in range(0, whole, step):
        for block in _schedule(words[first : first + step]).tolist():
            a, b, c, d, e, f, g, k = h
            for w in block:
                ee, aa = e << 32 | e, a << 32 | a  # doubled, so that a shift turns
                t = k + (ee >> 6 ^ ee >> 11 ^ ee >> 25) + (g ^ e & (f ^ g)) + w & mask
                a, b, c, d, e, f, g, k = t + (aa >> 2 ^ aa >> 13 ^ aa >> 22) + (a & b | c & (a | b)) & mask, a, b, c, d + t & mask, e, f, g
            h = [x + y & mask for x, y in zip(h, (a, b, c, d, e, f, g, k), strict=True)]
    return h


class _Context(ctypes.Structure):
    """OpenSSL's ``SHA256_CTX``."""

    _fields_ = [("h", ctypes.c_uint32 * 8), ("bits", ctypes.c_uint32 * 2), ("data", ctypes.c_uint32 * 16), ("num", ctypes.c_uint), ("md_len", ctypes.c_uint)]


@functools.cache
def _openssl() -> ctypes.CDLL | None:
    """The library behind ``hashlib``, if it is OpenSSL and lets its state be set."""
    try:
        import _hashlib

        lib = ctypes.CDLL(_hashlib.__file__)
        lib.SHA256_Init, lib.SHA256_Update  # noqa: B018
    except (ImportError, OSError, AttributeError):
        return None
    lib.SHA256_Update.argtypes = [ctypes.POINTER(_Context), ctypes.c_char_p, ctypes.c_size_t]
    return lib


def _blocks(h: list[int], data: bytes, whole: int) -> list[int]:
    """The eight words after so many blocks, by OpenSSL; about 400 times as fast as ``_blocks_here``."""
    lib, ctx = _openssl(), _Context()
    if lib is None:
        return _blocks_here(h, data, whole)
    lib.SHA256_Init(ctypes.byref(ctx))
    ctx.h[:] = h
    lib.SHA256_Update(ctypes.byref(ctx), data, whole * 64)
    return list(ctx.h)


def absorb(state: bytes, data: bytes, blocks: Callable[[list[int], bytes, int], list[int]] = _blocks) -> bytes:
    """The state after more bytes."""
    h, size = [int.from_bytes(state[i : i + 4], "big") for i in range(0, 32, 4)], int.from_bytes(state[32:40], "big") + len(data)
    data = state[40:] + data
    whole = len(data) // 64
    h = blocks(h, data, whole)
    return b"".join(x.to_bytes(4, "big") for x in h) + size.to_bytes(8, "big") + data[whole * 64 :]


def absorber(state: bytes) -> Callable[[str], bytes]:
    """``absorb`` of a text, for a task."""
    return lambda text: absorb(state, text.encode())


def digest(state: bytes) -> str:
    """The hash of all bytes absorbed, in hex."""
    size = int.from_bytes(state[32:40], "big")
    return absorb(state, b"\x80" + bytes((55 - size) % 64) + (8 * size).to_bytes(8, "big"))[:32].hex()

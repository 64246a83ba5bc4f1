"""XXH64 of many parts of one buffer at once.

The hash is the public one (lanes of 8 bytes, stripes of 32); each step is taken for all parts that have it.
"""

from __future__ import annotations

# The five primes of XXH64.
P1, P2, P3, P4, P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
#: Longer parts are hashed one by one.
LONG = 4096


def _u(x: int):
    import numpy as np

    return np.uint64(x & (1 << 64) - 1)


def _turn(x, n: int):
    return (x << _u(n)) | (x >> _u(64 - n))


def _mixed(acc, lane):
    return _turn(acc + lane * _u(P2), 31) * _u(P1)


def _stripes(lanes, at, n_stripes, seed: int):
    """The state behind the stripes of parts that have some; parts come with the most stripes first."""
    import numpy as np

    v = [np.full(len(at), _u(seed + x)) for x in (P1 + P2, P2, 0, -P1)]
    for k in range(int(n_stripes[0])):
        m = int(np.searchsorted(-n_stripes, -k, side="left"))
        for j in range(4):
            v[j][:m] = _mixed(v[j][:m], lanes[at[:m] + 32 * k + 8 * j])
    acc = _turn(v[0], 1) + _turn(v[1], 7) + _turn(v[2], 12) + _turn(v[3], 18)
    for x in v:
        acc = (acc ^ _mixed(np.zeros_like(x), x)) * _u(P1) + _u(P4)
    return acc


def hashes(data, starts, lengths, seed: int = 0):
    """XXH64 of each part ``data[start : start + length]``, as unsigned 64-bit numbers; ``data`` is an array of bytes."""
    import numpy as np
    from xxhash import xxh64_intdigest

    n = len(starts)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    # Numbers that start at every byte; fancy indices copy from them, so they need not be aligned.
    lanes = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    halves = np.ndarray((len(data) + 1,), dtype="<u4", buffer=padded.data, strides=(1,))
    at, left = starts.astype(np.int64), lengths.astype(np.int64)
    h = np.full(n, _u(seed + P5))
    striped = np.flatnonzero((left >= 32) & (left <= LONG))
    if len(striped):
        striped = striped[np.argsort(-(left[striped] // 32), kind="stable")]
        n_stripes = left[striped] // 32
        h[striped] = _stripes(lanes, at[striped], n_stripes, seed)
        at[striped] += 32 * n_stripes
        left[striped] -= 32 * n_stripes
    h += lengths.astype(np.uint64)
    singly = np.flatnonzero(left > LONG)
    left[singly] = 0
    while len(m := np.flatnonzero(left >= 8)):
        h[m] = _turn(h[m] ^ _mixed(np.zeros(len(m), dtype=np.uint64), lanes[at[m]]), 27) * _u(P1) + _u(P4)
        at[m] += 8
        left[m] -= 8
    if len(m := np.flatnonzero(left >= 4)):
        h[m] = _turn(h[m] ^ (halves[at[m]].astype(np.uint64) * _u(P1)), 23) * _u(P2) + _u(P3)
        at[m] += 4
        left[m] -= 4
    while len(m := np.flatnonzero(left > 0)):
        h[m] = _turn(h[m] ^ (padded[at[m]].astype(np.uint64) * _u(P5)), 11) * _u(P1)
        at[m] += 1
        left[m] -= 1
    h = (h ^ (h >> _u(33))) * _u(P2)
    h = (h ^ (h >> _u(29))) * _u(P3)
    h = h ^ (h >> _u(32))
    for i in singly.tolist():
        h[i] = xxh64_intdigest(data[starts[i] : starts[i] + lengths[i]].tobytes(), seed)
    return h

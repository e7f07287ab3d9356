"""Keccak-256 of address texts: the one checksum that Spark has no expression for (the others: ``codecs.py``).

It runs on distinct addresses, Arrow-batched, and gets NULL for those that do not need it.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the permutation.
KECCAK_ROTATION = [[0, 36, 3, 41, 18], [1, 44, 10, 45, 2], [62, 6, 43, 15, 61], [28, 55, 25, 21, 56], [27, 20, 39, 8, 14]]
MASK64 = (1 << 64) - 1


def keccak256(data: bytes) -> bytes:
    """Keccak-256 with the original padding (not SHA3)."""
    rate = 136
    padded = bytearray(data) + b"\x01" + bytes(-(len(data) + 1) % rate)
    padded[-1] |= 0x80
    lanes = [[0] * 5 for _ in range(5)]
    for start in range(0, len(padded), rate):
        for i in range(rate // 8):
            lanes[i % 5][i // 5] ^= int.from_bytes(padded[start + 8 * i:start + 8 * i + 8], "little")
        lfsr = 1
        for _ in range(24):
            parity = [lanes[x][0] ^ lanes[x][1] ^ lanes[x][2] ^ lanes[x][3] ^ lanes[x][4] for x in range(5)]
            for x in range(5):
                right = parity[(x + 1) % 5]
                mix = parity[x - 1] ^ ((right << 1 | right >> 63) & MASK64)
                lanes[x] = [lane ^ mix for lane in lanes[x]]
            turned = [[0] * 5 for _ in range(5)]
            for x in range(5):
                for y in range(5):
                    n, lane = KECCAK_ROTATION[x][y], lanes[x][y]
                    turned[y][(2 * x + 3 * y) % 5] = (lane << n | lane >> (64 - n)) & MASK64 if n else lane
            lanes = [[turned[x][y] ^ (~turned[(x + 1) % 5][y] & turned[(x + 2) % 5][y]) for y in range(5)] for x in range(5)]
            for j in range(7):  # round constant bits come from the degree-8 shift register
                if lfsr & 1:
                    lanes[0][0] ^= 1 << ((1 << j) - 1)
                lfsr = (lfsr << 1) ^ (0x171 if lfsr & 0x80 else 0)
    return b"".join(lanes[i][0].to_bytes(8, "little") for i in range(4))


def _keccak256_hex(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None or pd.isna(t) else keccak256(bytes.fromhex(t)).hex())


keccak256_hex = F.pandas_udf(_keccak256_hex, T.StringType()).asNondeterministic()

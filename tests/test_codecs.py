"""The codec expressions against plain Python, on made addresses of every kind, broken ones and odd texts."""

import hashlib
import random

import address_codecs as A
from pyspark.sql import functions as F
from rosterline.functions import codecs as C
from rosterline.functions.addresses import keccak256


def _base58(raw: bytes, alphabet: str) -> str:
    number, text = int.from_bytes(raw, "big"), ""
    while number:
        number, place = divmod(number, 58)
        text = alphabet[place] + text
    return alphabet[0] * (len(raw) - len(raw.lstrip(b"\0"))) + text


def _checked(raw: bytes) -> bytes:
    return raw + hashlib.sha256(hashlib.sha256(raw).digest()).digest()[:4]


def _five_bits(raw: bytes) -> list[int]:
    bits = "".join(f"{b:08b}" for b in raw)
    bits += "0" * (-len(bits) % 5)
    return [int(bits[i:i + 5], 2) for i in range(0, len(bits), 5)]


def _sealed(prefix: list[int], digits: list[int], generator, width: int, n: int, final: int) -> str:
    state = A._residue(prefix + digits + [0] * n, generator, width) ^ final
    digits = digits + [state >> 5 * (n - 1 - i) & 31 for i in range(n)]
    return "".join(A.BECH32[d] for d in digits)


def _bech32(prefix: str, digits: list[int], final: int) -> str:
    spread = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix]
    return prefix + "1" + _sealed(spread, digits, A.BECH32_GENERATOR, 25, 6, final)


def _cash(raw: bytes) -> str:
    return "bitcoincash:" + _sealed([ord(c) & 31 for c in "bitcoincash"] + [0], _five_bits(raw), A.CASH_GENERATOR, 35, 8, 1)


def _monero(raw: bytes) -> str:
    raw += keccak256(raw)[:4]
    blocks = [(raw[i:i + 8], 11 if len(raw) - i >= 8 else 7) for i in range(0, len(raw), 8)]
    return "".join(_base58(b.lstrip(b"\0"), A.BASE58).rjust(n, "1") for b, n in blocks)


def _texts(rnd: random.Random) -> list[tuple[str, str]]:
    raw = rnd.randbytes
    rows = []
    for version in (b"\0", b"\5", b"\x41", b"\x1c\xb8", b"\0\0", b"\0\0\0"):
        for fill in (raw(20), bytes(20)):
            rows.append(("base58", _base58(_checked(version + fill), A.BASE58)))
            rows.append(("xrp", _base58(_checked(version + fill), A.BASE58_XRP)))
    rows += [("sol", _base58(raw(n), A.BASE58)) for n in (1, 31, 32, 33, 64, 200)] + [("sol", "1" * 32), ("sol", "1"), ("sol", "z" * 8), ("sol", "1" * 7 + "2")]
    for final in (1, 0x2BC830A3, 7):
        for version in (0, 1, 16, 17):
            for size in (1, 2, 20, 21, 32, 40, 41):
                rows.append(("segwit:bc", _bech32(rnd.choice(["bc", "bc", "ltc", "b1c"]), [version] + _five_bits(raw(size)), final)))
        rows += [("segwit:bc", _bech32("bc", digits, final)) for digits in ([], [0], [0, 1], [0, 0, 1])]
        rows += [("beacon", _bech32(prefix, _five_bits(raw(size)), final)) for prefix in ("bnb", "bn") for size in (19, 20, 21)]
    for kind in (0, 1, 2, 16, 17, 128):
        for code, size in enumerate(A.CASH_SIZES):
            rows += [("cashaddr", _cash(bytes([(kind & 15) << 3 & 127 | code | kind & 128]) + raw(size + more))) for more in (0, 1)]
    rows += [("cashaddr", _cash(b"")), ("cashaddr", _cash(b"\0"))]
    rows += [("monero", _monero(bytes([head]) + raw(size))) for head in (18, 19, 42, 53) for size in (64, 72)] + [("monero", "z" * 95), ("monero", "1" * 95), ("monero", "1" * 106)]
    for _ in range(6):
        digits = raw(20).hex()
        nibbles = keccak256(digits.encode()).hex()
        rows.append(("eip55", "0x" + "".join(c.upper() if int(n, 16) > 7 else c for c, n in zip(digits, nibbles))))
    broken = []
    for route, text in rows:
        at = rnd.randrange(len(text))
        near = rnd.choice(A.BECH32 if route[:3] in ("seg", "bea", "cas") else "abcdefABCDEF123456789")
        broken += [(route, text[:at] + near + text[at + 1:]), (route, text.upper()), (route, text.capitalize()), (route, text[:-1]), (route, text.rpartition(":")[2])]
    odd = [(route, text) for route in ("base58", "xrp", "sol", "segwit:bc", "beacon", "cashaddr", "monero")
           for text in ("", "1", "0", "é", "\U0001f600" * 3, ":", "1q", "bc1", "q" * 300, "bitcoincash:", "bc1qqqqqq\n", "K1qqqqqqq", "a b")]
    # EIP-55 is only asked of 40 hex digits
    return [r for r in rows + broken if r[0] != "eip55" or len(r[1]) == 42 and r[1].startswith("0x")] + odd


def test_codecs_equal_plain_python(spark):
    rows = _texts(random.Random(11))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)] + [(len(rows), None, "1")], "id long, asked string, address string")
    got = {r["id"]: r for r in C.with_checksum_facts(df, "asked", "address").collect()}
    found = set()
    for i, (route, text) in enumerate(rows):
        want = A.facts(route, text)
        if route == "xrp":  # the plain alphabet is not asked of this route
            want |= {"version": "", "size": got[i]["size"]}
        assert {k: got[i][k] for k in want} == want, (route, text)
        found.add((route, want["codec"]))
    assert got[len(rows)]["codec"] is None and got[len(rows)]["size"] is None and got[len(rows)]["version"] is None
    assert {("xrp", "XRP_BASE58"), ("segwit:bc", "BECH32"), ("segwit:bc", "BECH32M"), ("segwit:bc", "!BECH32M"), ("segwit:bc", "!!BECH32"),
            ("beacon", "BNB_BECH32"), ("cashaddr", "CASHADDR"), ("cashaddr", "OTHER_TYPE"), ("monero", "MONERO_BASE58"), ("eip55", "EIP55")} <= found


def test_keccak_is_the_only_python_of_a_validation(spark):
    df = spark.createDataFrame([("base58", "1")], "asked string, address string")
    plan = C.with_checksum_facts(df.withColumn("n", F.lit(1)), "asked", "address")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "keccak" in plan

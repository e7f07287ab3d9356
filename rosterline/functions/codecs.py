"""Base58, Bech32, CashAddr and Monero codecs as column expressions.

Big numbers are arrays of 16-bit limbs carried by ``aggregate``, checksums of polynomials a fold over 5-bit digits, double SHA-256 is
``sha2`` of ``unhex``.  Only Keccak, which Spark has no expression for, is a UDF (``addresses.keccak256_hex``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .addresses import keccak256_hex

# Fixed values of the address formats.
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BASE58_XRP = "rpshnaf39wBUDNEGHJKLM4PQRST7VWXYZ2bcdeCg65jkm8oFqi1tuvAxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_GENERATOR = [0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3]
BECH32_FINAL = {1: "BECH32", 0x2BC830A3: "BECH32M"}
CASH_PREFIX = "bitcoincash"
CASH_GENERATOR = [0x98F2BC8E61, 0x79B76D99E2, 0xF33E5FB3C4, 0xAE2EABE2A8, 0x1E4F43E470]
CASH_SIZES = [20, 24, 28, 32, 40, 48, 56, 64]
MONERO_BLOCK, MONERO_BYTES = 11, 8
MONERO_TAIL, MONERO_TAIL_BYTES = 7, 5
MONERO_SHAPES = {95: ["12", "2a"], 106: ["13"]}

GROUP = 8                 # characters that one step takes: 58^8 < 2^47, so limb * 58^8 + carry stays below 2^63
LIMB = 16
LOW = (1 << LIMB) - 1


def _big(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _digits(text: Column, alphabet: str) -> Column:
    """Places of the characters in ``alphabet``."""
    return F.transform(_chars(text), lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("bigint"))


def base58_number(text: str) -> str:
    """Hex text (whole bytes, no zero bytes in front) of the number that a Base58 text of any length writes; SQL over the SQL ``text``."""
    groups = f"int(ceil(length({text}) / {GROUP}))"
    part = f"""aggregate(filter(split(substr(lpad({text}, {groups} * {GROUP}, '{BASE58[0]}'), g * {GROUP} + 1, {GROUP}), ''), c -> c <> ''), 0L,
        (n, c) -> n * 58 + instr('{BASE58}', c) - 1)"""
    carry = f"""(s, limb) -> named_struct('over', shiftright(limb * {58**GROUP}L + s.over, {LIMB}),
        'limbs', concat(s.limbs, array((limb * {58**GROUP}L + s.over) & {LOW}L)))"""
    spread = "s -> concat(s.limbs, array({}))".format(", ".join(f"shiftright(s.over, {LIMB * k}) & {LOW}L" for k in range(3)))
    limbs = f"""aggregate(transform(sequence(0, {groups} - 1), g -> {part}), cast(array() AS array<bigint>),
        (limbs, part) -> aggregate(limbs, named_struct('over', part, 'limbs', cast(array() AS array<bigint>)), {carry}, {spread}))"""
    return f"regexp_replace(array_join(transform(reverse({limbs}), n -> lpad(lower(hex(n)), {LIMB // 4}, '0')), ''), '^(?:00)+', '')"


def is_base58(text: Column) -> Column:
    return text.rlike(rf"^[{BASE58}]+\z")


def base58_bytes(text: str) -> Column:
    """Hex text of the bytes that a Base58 text writes: every leading zero digit is a zero byte.  NULL for other texts."""
    zeros = F.length(text) - F.length(F.regexp_replace(text, f"^{BASE58[0]}+", ""))
    return F.when(is_base58(F.col(text)), F.concat(F.repeat(F.lit("00"), zeros), F.expr(base58_number(text))))


def checked_version(body: Column) -> Column:
    """Version bytes (hex) before a 20-byte payload with a good double SHA-256 checksum; empty when it fails."""
    size = F.length(body)
    once = F.sha2(F.unhex(F.substring(body, F.lit(1), size - 8)), 256)
    good = F.substring(F.sha2(F.unhex(once), 256), 1, 8) == F.substring(body, size - 7, F.lit(8))
    return F.when((size >= 50) & good, F.substring(body, F.lit(1), size - 48)).otherwise("")


def residue(values: str, generator: list[int], width: int) -> Column:
    """Remainder of the checksum polynomial over the 5-bit digits of the column ``values``."""
    words = " ^ ".join(f"if(shiftright(state, {width + bit}) & 1L = 1L, {word}L, 0L)" for bit, word in enumerate(generator))
    return F.expr(f"aggregate({values}, 1L, (state, digit) -> shiftleft(state & {(1 << width) - 1}L, 5) ^ digit ^ {words})")


def regrouped_size(digits: Column) -> Column:
    """Number of bytes that 5-bit digits fill; NULL unless fewer than five bits are left over and all of them zero."""
    bits = F.size(digits) * 5
    spare = bits % 8
    left = F.element_at(digits, -1) % F.when(spare == 1, 2).when(spare == 2, 4).when(spare == 3, 8).when(spare == 4, 16).otherwise(1)
    return F.when(bits == 0, 0).when((spare < 5) & (left == 0), F.floor(bits / 8).cast("int"))


def _one_case(text: Column) -> Column:
    return (text == F.lower(text)) | (text == F.upper(text))


def with_bech32(df: DataFrame, text: Column) -> DataFrame:
    """Adds ``bech_prefix``, ``bech_digits`` (without checksum) and ``bech_encoding``: NULL where the text is no Bech32 or Bech32m."""
    low = F.lower(text)
    shape = rf"^(.+)1([{BECH32}]{{6,}})\z"
    fits = _one_case(text) & text.rlike(r"^[!-~]{1,90}\z") & low.rlike(shape)
    df = df.withColumns({
        "bech_prefix": F.when(fits, F.regexp_extract(low, shape, 1)),
        "bech_all": F.when(fits, _digits(F.regexp_extract(low, shape, 2), BECH32))})
    codes = F.transform(_chars(F.col("bech_prefix")), lambda c: F.ascii(c).cast("bigint"))
    spread = F.concat(F.transform(codes, lambda n: F.shiftright(n, 5)), F.array(_big(0)), F.transform(codes, lambda n: n.bitwiseAND(_big(31))), F.col("bech_all"))
    df = df.withColumns({"bech_spread": spread, "bech_digits": F.when(F.col("bech_all").isNotNull(), F.slice("bech_all", F.lit(1), F.size("bech_all") - 6))})
    df = df.withColumn("bech_residue", residue("bech_spread", BECH32_GENERATOR, 25))
    encoding = F.lit(None).cast("string")
    for value, name in BECH32_FINAL.items():
        encoding = F.when(F.col("bech_residue") == value, name).otherwise(encoding)
    return df.withColumn("bech_encoding", encoding)


def segwit(prefix: Column) -> Column:
    """Encoding name of a valid witness address (over the columns of ``with_bech32``); with ``!`` when it breaks a rule, ``!!`` when
    the prefix is another."""
    encoding, digits = F.col("bech_encoding"), F.col("bech_digits")
    version = F.get(digits, F.lit(0))
    size = regrouped_size(F.slice(digits, 2, 90))
    fits = (version <= 16) & size.between(2, 40) & ((version > 0) | size.isin(20, 32)) & ((encoding == "BECH32") == (version == 0))
    return F.when(encoding.isNull(), "!BECH32").when(F.col("bech_prefix") != prefix, F.concat(F.lit("!!"), encoding)).when(
        fits, encoding).otherwise(F.concat(F.lit("!"), encoding))


def beacon() -> Column:
    good = (F.col("bech_prefix") == "bnb") & (F.col("bech_encoding") == "BECH32") & (regrouped_size(F.col("bech_digits")) == 20)
    return F.when(good, "BNB_BECH32").otherwise("")


def with_cashaddr(df: DataFrame, text: Column) -> DataFrame:
    """Adds ``cash``: CASHADDR, OTHER_TYPE for a valid address of another type, empty otherwise."""
    low = F.lower(text)
    shape = rf"^(?:{CASH_PREFIX}:)?([{BECH32}]{{9,}})\z"
    df = df.withColumn("cash_digits", F.when(_one_case(text) & low.rlike(shape), _digits(F.regexp_extract(low, shape, 1), BECH32)))
    head = F.array(*[_big(ord(ch) & 31) for ch in CASH_PREFIX], _big(0))
    digits = F.col("cash_digits")
    df = df.withColumns({
        "cash_spread": F.concat(head, digits), "cash_size": regrouped_size(F.slice(digits, F.lit(1), F.size(digits) - 8)),
        "cash_first": F.shiftleft(F.get(digits, F.lit(0)), 3).bitwiseOR(F.shiftright(F.get(digits, F.lit(1)), 2))})
    size, first = F.col("cash_size"), F.col("cash_first")
    payload = F.get(F.array(*[F.lit(n) for n in CASH_SIZES]), first.bitwiseAND(_big(7)).cast("int"))
    fits = (size > 0) & (first < 128) & (size - 1 == payload) & (residue("cash_spread", CASH_GENERATOR, 35) == 1)
    return df.withColumn("cash", F.when(fits, F.when(F.shiftright(first, 3) <= 1, "CASHADDR").otherwise("OTHER_TYPE")).otherwise(""))


def monero_bytes(text: str) -> Column:
    """Hex text of the bytes of a Monero address, block by block; an overflowing block gives ``!``.  NULL for other lengths and texts."""
    blocks = f"transform(sequence(0, length({text}) div {MONERO_BLOCK}), b -> substr({text}, b * {MONERO_BLOCK} + 1, {MONERO_BLOCK}))"
    width = f"if(length(block) = {MONERO_TAIL}, {2 * MONERO_TAIL_BYTES}, {2 * MONERO_BYTES})"
    number = f"transform(array({base58_number('block')}), h -> if(length(h) <= {width}, lpad(h, {width}, '0'), '!'))[0]"
    return F.when(F.length(text).isin(list(MONERO_SHAPES)) & is_base58(F.col(text)), F.expr(f"array_join(transform({blocks}, block -> {number}), '')"))


def with_checksum_facts(df: DataFrame, asked: str, address: str) -> DataFrame:
    """Adds ``size``, ``version`` and ``codec`` of the texts in ``address`` where a route is ``asked``; NULL elsewhere.

    ``size``: bytes of the Base58 text, -1 when it is not Base58.  ``version``: version bytes (hex) of a good Base58 checksum, else
    empty.  ``codec``: method or type that the asked codec finds, empty when it fails (Bech32: with marks, see ``segwit``).
    """
    route, kept = F.col(asked), list(df.columns)
    text = F.when(route.isNotNull(), F.col(address))
    bech = (route == "beacon") | F.startswith(route, F.lit("segwit:"))
    df = df.withColumns({
        "plain": F.when(route == "xrp", F.translate(text, BASE58_XRP, BASE58)).otherwise(text), "blocks": F.when(route == "monero", text)})
    df = df.withColumns({"body": base58_bytes("plain"), "raw": monero_bytes("blocks")})
    df = with_cashaddr(with_bech32(df, F.when(bech, text)), F.when(route == "cashaddr", text))
    df = df.withColumn("checked", F.when(F.col("body").isNotNull(), checked_version(F.col("body"))))
    lower_case = F.lower(F.substring(text, 3, 40))
    df = df.withColumn("keccak", keccak256_hex(F.when(route == "eip55", F.lower(F.hex(F.encode(lower_case, "UTF-8")))).when(
        F.col("raw").rlike(r"^[0-9a-f]+\z"), F.substring(F.col("raw"), F.lit(1), F.length("raw") - 8))))
    cased = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.when(
        F.substring(F.col("keccak"), i, F.lit(1)) >= "8", F.upper(F.substring(lower_case, i, F.lit(1)))).otherwise(F.substring(lower_case, i, F.lit(1)))), "")
    network = F.lit(False)
    for size, heads in MONERO_SHAPES.items():
        network = network | ((F.length(text) == size) & F.substring("raw", 1, 2).isin(heads))
    sealed = F.substring("keccak", 1, 8) == F.substring(F.col("raw"), F.length("raw") - 7, F.lit(8))
    codec = (
        F.when(F.startswith(route, F.lit("segwit:")), segwit(F.substring(route, F.lit(8), F.length(route))))
        .when(route == "cashaddr", F.col("cash")).when(route == "beacon", beacon())
        .when(route == "eip55", F.when(F.substring(text, 3, 40) == cased, "EIP55").otherwise(""))
        .when(route == "monero", F.when(network & sealed, "MONERO_BASE58").otherwise(""))
        .when(route == "xrp", F.when(F.col("checked") == "00", "XRP_BASE58").otherwise("")).otherwise(""))
    size = F.coalesce((F.length("body") / 2).cast("int"), F.lit(-1))
    version = F.when(route == "xrp", "").otherwise(F.coalesce("checked", F.lit("")))
    return df.select(*kept, *[F.when(route.isNotNull(), c).alias(n) for n, c in (("size", size), ("version", version), ("codec", codec))])

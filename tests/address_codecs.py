"""Checksum facts of address texts in plain Python: what the column expressions are tested against."""

from __future__ import annotations

import hashlib

from rosterline.functions.addresses import keccak256

# Fixed values of the address formats.
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BASE58_XRP = "rpshnaf39wBUDNEGHJKLM4PQRST7VWXYZ2bcdeCg65jkm8oFqi1tuvAxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_GENERATOR = [0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3]
BECH32_FINAL = {1: "BECH32", 0x2BC830A3: "BECH32M"}
CASH_GENERATOR = [0x98F2BC8E61, 0x79B76D99E2, 0xF33E5FB3C4, 0xAE2EABE2A8, 0x1E4F43E470]
CASH_SIZES = [20, 24, 28, 32, 40, 48, 56, 64]
MONERO_BLOCK = {2: 1, 3: 2, 5: 3, 6: 4, 7: 5, 9: 6, 10: 7, 11: 8}


def base58_bytes(text: str, alphabet: str) -> bytes | None:
    if not text or any(ch not in alphabet for ch in text):
        return None
    number = 0
    for ch in text:
        number = number * 58 + alphabet.index(ch)
    zeros = len(text) - len(text.lstrip(alphabet[0]))
    return bytes(zeros) + number.to_bytes((number.bit_length() + 7) // 8, "big")


def checked_version(body: bytes | None) -> str:
    if body is None or len(body) < 25:
        return ""
    good = hashlib.sha256(hashlib.sha256(body[:-4]).digest()).digest()[:4] == body[-4:]
    return body[:-24].hex() if good else ""


def _residue(values: list[int], generator: list[int], width: int) -> int:
    state, low = 1, (1 << width) - 1
    for value in values:
        top, state = state >> width, (state & low) << 5 ^ value
        for bit, word in enumerate(generator):
            if top >> bit & 1:
                state ^= word
    return state


def _eight_bits(digits: list[int]) -> bytes | None:
    """Regroup 5-bit digits into bytes; leftover bits must be fewer than five and zero."""
    total = 0
    for digit in digits:
        total = total << 5 | digit
    spare = 5 * len(digits) % 8
    if spare >= 5 or total & ((1 << spare) - 1):
        return None
    return (total >> spare).to_bytes(5 * len(digits) // 8, "big")


def bech32_parts(text: str) -> tuple[str, list[int], str] | None:
    """(prefix, digits, encoding) of a Bech32 or Bech32m text."""
    folded = text.lower()
    if text not in (folded, text.upper()) or any(not 33 <= ord(ch) <= 126 for ch in text) or len(text) > 90:
        return None
    prefix, mark, payload = folded.rpartition("1")
    if not mark or not prefix or len(payload) < 6 or any(ch not in BECH32 for ch in payload):
        return None
    digits = [BECH32.index(ch) for ch in payload]
    spread = [ord(ch) >> 5 for ch in prefix] + [0] + [ord(ch) & 31 for ch in prefix]
    encoding = BECH32_FINAL.get(_residue(spread + digits, BECH32_GENERATOR, 25))
    return (prefix, digits[:-6], encoding) if encoding else None


def segwit(text: str, prefix: str) -> str:
    """Encoding name of a valid witness address; with ``!`` when it breaks a rule, ``!!`` when the prefix is another."""
    parts = bech32_parts(text)
    if parts is None:
        return "!BECH32"
    found, digits, encoding = parts
    if found != prefix:
        return "!!" + encoding
    program = _eight_bits(digits[1:]) if digits and digits[0] <= 16 else None
    fits = program is not None and 2 <= len(program) <= 40 and (digits[0] > 0 or len(program) in (20, 32))
    return encoding if fits and (encoding == "BECH32") == (digits[0] == 0) else "!" + encoding


def cashaddr(text: str) -> str:
    if text not in (text.lower(), text.upper()):
        return ""
    prefix, mark, payload = text.lower().rpartition(":")
    prefix = prefix if mark else "bitcoincash"
    if prefix != "bitcoincash" or len(payload) <= 8 or any(ch not in BECH32 for ch in payload):
        return ""
    digits = [BECH32.index(ch) for ch in payload]
    raw = _eight_bits(digits[:-8])
    if not raw or raw[0] & 128 or _residue([ord(ch) & 31 for ch in prefix] + [0] + digits, CASH_GENERATOR, 35) != 1:
        return ""
    if len(raw) - 1 != CASH_SIZES[raw[0] & 7]:
        return ""
    return "CASHADDR" if raw[0] >> 3 & 15 in (0, 1) else "OTHER_TYPE"


def monero(text: str) -> str:
    blocks = [text[i:i + 11] for i in range(0, len(text), 11)]
    raw = b""
    for block in blocks:
        size, number = MONERO_BLOCK.get(len(block)), 0
        if size is None or any(ch not in BASE58 for ch in block):
            return ""
        for ch in block:
            number = number * 58 + BASE58.index(ch)
        if number >> (8 * size):
            return ""
        raw += number.to_bytes(size, "big")
    shape = (len(text), len(raw), raw[:1].hex()) in {(95, 69, "12"), (95, 69, "2a"), (106, 77, "13")}
    return "MONERO_BASE58" if shape and keccak256(raw[:-4])[:4] == raw[-4:] else ""


def eip55(text: str) -> str:
    digits = text[2:].lower()
    nibbles = keccak256(digits.encode()).hex()
    expected = "".join(ch.upper() if int(n, 16) >= 8 else ch for ch, n in zip(digits, nibbles))
    return "EIP55" if text[2:] == expected else ""


def beacon(text: str) -> str:
    parts = bech32_parts(text)
    raw = _eight_bits(parts[1]) if parts else None
    return "BNB_BECH32" if raw is not None and parts[0] == "bnb" and parts[2] == "BECH32" and len(raw) == 20 else ""


def xrp(text: str) -> str:
    return "XRP_BASE58" if checked_version(base58_bytes(text, BASE58_XRP)) == "00" else ""


CODECS = {"cashaddr": cashaddr, "monero": monero, "eip55": eip55, "beacon": beacon, "xrp": xrp}


def facts(route: str, text: str) -> dict:
    body = base58_bytes(text, BASE58)
    codec = segwit(text, route[7:]) if route.startswith("segwit:") else CODECS[route](text) if route in CODECS else ""
    return {"size": -1 if body is None else len(body), "version": checked_version(body), "codec": codec}

"""The plain rules for personal data: leftmost, non-overlapping matches of each kind, checked and not retried.

Every rule runs in time linear in the text. Offsets count code points, the end is exclusive.
"""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match can only start where a run of digits does: an earlier digit of the run would have matched first.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for place, char in enumerate(reversed(number)):
        value = int(char) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def card_number(text: str) -> bool:
    number = digits(text)
    return 13 <= len(number) <= 19 and luhn(number)


def address_parts(text: str) -> bool:
    # Leading zeros do not count, so a part of any length is compared by value.
    return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 if len(p) < 10 else False for p in _parts(text))


def _parts(text: str) -> list[str]:
    return [p.lstrip("0") or "0" for p in text.split(".")]


def phone_digits(text: str) -> bool:
    return 9 <= len(digits(text)) <= 15


def _emails(text: str):
    done = 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > done and text[start - 1] in _LOCAL_CHARS:
                start -= 1
        if start < at:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if "@" in text:
        found["email"] = list(_emails(text))
    for kind, rule, passes in (
        ("ip", _IP, address_parts),
        ("card", _CARD, card_number),
        ("phone", _PHONE, phone_digits),
    ):
        if kind != "phone" or "+" in text:
            found[kind] = [m.span() for m in rule.finditer(text) if passes(m[0])]
    return found

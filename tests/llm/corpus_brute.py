"""Helpers of the brute-force versions."""

from __future__ import annotations


def lower_ascii(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)

"""Spans found in one text: byte offsets to code points, and their one-line form."""

from __future__ import annotations

import hashlib

from stayscope.llm.common import ship

Span = tuple[str, int, int]


def in_code_points(raw: bytes, spans: list[Span]) -> list[Span]:
    """Spans with byte offsets of UTF-8 ``raw`` as spans with code point offsets."""
    if raw.isascii():
        return spans
    chars, seen, at = {}, 0, 0
    for offset in sorted({x for _, start, end in spans for x in (start, end)}):
        seen += len(raw[at:offset].decode("utf-8", "surrogatepass"))
        chars[offset], at = seen, offset
    return [(kind, chars[start], chars[end]) for kind, start, end in spans]


def written(spans: list[Span], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by start, then by the kinds' order, joined by commas."""
    order = {kind: i for i, kind in enumerate(kinds)}
    ordered = sorted(spans, key=lambda s: (s[1], order[s[0]], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


ship(__name__)

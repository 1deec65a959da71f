"""Secrets in text: an Aho-Corasick prefilter, anchored expressions near its hits, checksums.

One automaton holds the keywords of all kinds and runs once over the A-Z lower-cased bytes of the
text. A kind's expression is tried only where one of its keywords begins, so most text never
meets an expression. Every match of such a kind begins with a keyword, and hits are taken from
left to right past the end of the last match: the result is that of a scan with the expression.

Base kinds, leftmost and non-overlapping per kind; matches that fail their condition are
dropped without a retry:

* ``assign``: a credential-like name, ``:`` or ``=``, and a value of 12 characters or more;
* ``access``: ``AKIA`` and upper-case letters and digits, 18 characters or more;
* ``hex``: a run of 16 or more lower-case hexadecimal digits. It has no keyword; its prefilter
  looks for 16 bytes of the class in a row.

Added kinds carry their own proof: ``checksum`` tokens (a known prefix, 30 base-62 characters and
their CRC-32 in six base-62 digits) count only if the checksum holds, and ``wif`` keys (base-58,
51 or 52 characters) only if the double SHA-256 in their last four bytes does.

Edge cases: a null text is empty and has no secret; rows are scanned one by one, so repeated rows
give equal results; ids may be null; an empty table gives none. Other columns pass through,
clashing names are replaced.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import ahocorasick
from pyspark.sql import DataFrame

from stayscope.llm.common import map_text, ship
from stayscope.llm.spans import Span, in_code_points, sha256, written

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "checksum", "wif")
ASSIGN_VALUE, ACCESS_CHARS, HEX_CHARS = 12, 18, 16

# Prefixes of token formats whose last six characters are a checksum.
CHECKSUM_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
# The alphabets of both encodings.
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"

#: Kind, its keywords in lower case, its expression over bytes.
ANCHORED = (
    (
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(
            rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
        ),
    ),
    ("access", ("akia",), re.compile(rb"AKIA[A-Z0-9]+")),
    ("checksum", CHECKSUM_PREFIXES, re.compile(rb"(?:gh[opusr]|npm)_[A-Za-z0-9]+")),
)
HEX = re.compile(rb"[0-9a-f]{16,}")
WIF = re.compile(rb"(?<![A-Za-z0-9])[5KL][1-9A-HJ-NP-Za-km-z]{50,51}(?![A-Za-z0-9])")

LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
HEX_CLASS = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
HEX_RUN = b"h" * HEX_CHARS
WIF_CLASS = bytes(119 if b in BASE58 else 32 for b in range(256))
WIF_RUN = b"w" * 51


def checksum_holds(token: bytes) -> bool:
    """Whether the last six characters are the CRC-32 of the 30 before them, in base 62."""
    body = token[4:]
    if len(body) != 36:
        return False
    value = 0
    for c in body[30:]:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(body[:30])


def wif_holds(key: bytes) -> bool:
    """Whether a base-58 key decodes to 0x80, a payload and the payload's own checksum."""
    value = 0
    for c in key:
        value = value * 58 + BASE58.index(c)
    raw = value.to_bytes(64, "big").lstrip(b"\0")
    if len(raw) not in (37, 38) or raw[0] != 0x80:
        return False
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def _holds(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[1]) >= ASSIGN_VALUE
    if kind == "access":
        return len(match[0]) >= ACCESS_CHARS
    return checksum_holds(match[0])


def automaton() -> ahocorasick.Automaton:
    """Keyword to (kinds that it begins a match of, its length)."""
    owners: dict[str, list[int]] = {}
    for k, (_, keywords, _) in enumerate(ANCHORED):
        for word in keywords:
            owners.setdefault(word, []).append(k)
    made = ahocorasick.Automaton()
    for word, kinds in owners.items():
        made.add_word(word, (tuple(kinds), len(word)))
    made.make_automaton()
    return made


def find(text: str, keywords: ahocorasick.Automaton) -> list[Span]:
    """All spans of one text in code points."""
    raw = text.encode("utf-8", "surrogatepass")
    spans: list[Span] = []
    near: dict[int, list[int]] = {}
    # One character per byte, so that the automaton's offsets are byte offsets.
    for last, (kinds, length) in keywords.iter(raw.translate(LOWERED).decode("latin-1")):
        for k in kinds:
            near.setdefault(k, []).append(last + 1 - length)
    for k, starts in near.items():
        kind, _, expression = ANCHORED[k]
        free_from = 0
        for start in sorted(starts):
            if start >= free_from and (match := expression.match(raw, start)):
                free_from = match.end()
                if _holds(kind, match):
                    spans.append((kind, start, match.end()))
    if HEX_RUN in raw.translate(HEX_CLASS):
        spans += [("hex", m.start(), m.end()) for m in HEX.finditer(raw)]
    if WIF_RUN in raw.translate(WIF_CLASS):
        spans += [("wif", m.start(), m.end()) for m in WIF.finditer(raw) if wif_holds(m[0])]
    return in_code_points(raw, spans)


OUTPUTS = [
    ("n_assign", "bigint"),
    ("n_access", "bigint"),
    ("n_hex", "bigint"),
    ("base_sha256", "string"),
    ("spans", "string"),
]


def scan(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` plus counts per base kind, a digest of the base spans, and all spans."""

    def start():
        keywords = automaton()

        def kernel(texts):
            columns = [[], [], [], [], []]
            for text in texts:
                spans = find(text, keywords)
                counts = [sum(kind == s[0] for s in spans) for kind in BASE_KINDS]
                base = written([s for s in spans if s[0] in BASE_KINDS], KINDS)
                row = (*counts, sha256(base), written(spans, KINDS))
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            return columns

        return kernel

    return map_text(docs, text_col, OUTPUTS, start, keep_text)


ship(__name__)

"""Terms of whole texts: runs of ASCII letters (and digits, if asked) and all other non-ASCII.

Only A-Z are lower-cased.  Texts are bytes: separators are ASCII, so cutting UTF-8
bytes cuts code points as well.  A null text has no terms.
"""

from __future__ import annotations

from collections.abc import Callable


def splitter(digits: bool) -> Callable[[bytes | None], list[bytes]]:
    """Function from a text's bytes to its terms in order; ``digits`` counts 0-9 as letters."""
    table = bytearray(b" " * 128) + bytearray(range(128, 256))
    for k in range(26):
        table[65 + k] = table[97 + k] = 97 + k
    if digits:
        table[48:58] = b"0123456789"
    fixed = bytes(table)

    def split(text: bytes | None) -> list[bytes]:
        return text.translate(fixed).split() if text else []

    return split

"""Texts that every operator must stand."""

from __future__ import annotations

ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "x"),
    (5, "x"),
    (5, "x"),
    (None, "a text without a key"),
    (None, None),
    (6, "Ünï cødé 漢字 \U0001f916 ▁ </s> \x00 end"),
    (7, "word " * 30_000),
    (8, "unbroken" * 20_000),
    (9, "no-break space and line"),
]

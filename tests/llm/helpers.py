"""Plain versions the operator tests compare with."""

from __future__ import annotations

import re

SPACE_WORDS = re.compile("[^\x20\x09-\x0D]+")


def lower_az(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def words(t: str | None) -> list[str]:
    return SPACE_WORDS.findall(lower_az(t or ""))


def rows(df, *keys):
    return sorted((r.asDict() for r in df.collect()),
                  key=lambda r: tuple(str(r[k]) for k in keys))

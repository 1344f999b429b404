"""Brute-force readers shared by the operators' tests."""

from __future__ import annotations

import re
import zlib

SF = "/root/testdata/sf0.001"


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_ascii(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles_of(text: str | None) -> set[tuple[str, ...]]:
    words = words_of(lower_ascii(text))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def crc(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())


def rows_of(frame) -> list[tuple]:
    return [tuple(row) for row in frame.collect()]

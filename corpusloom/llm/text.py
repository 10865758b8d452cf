"""Patterns and small helpers that several operators share."""

from __future__ import annotations

import re

#: ASCII white space: space, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
WORD_BYTES = re.compile(WORD.encode())

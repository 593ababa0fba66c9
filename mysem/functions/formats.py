"""``%`` date formats compiled to Spark datetime patterns."""

from __future__ import annotations

import re

# Format specifier -> Spark pattern.
SPECIFIERS = {
    "Y": "yyyy", "y": "yy", "m": "MM", "c": "M",
    "M": "MMMM", "b": "MMM", "d": "dd", "e": "d",
    "H": "HH", "h": "hh", "I": "hh",
    "i": "mm", "s": "ss", "S": "ss", "p": "a",
    "W": "EEEE", "a": "EEE", "j": "DDD", "f": "SSSSSS",
    "T": "HH:mm:ss", "r": "hh:mm:ss a",
}

# Week number has no Spark pattern letter; it is computed apart.
WEEK = "V"

# Specifiers that name a day only together with other fields.
NOT_PARSED = {"V", "W", "a", "j"}

# When parsing, a number may be written without its leading zero.
LENIENT = {"MM": "M", "dd": "d", "HH": "H", "hh": "h", "mm": "m", "ss": "s"}

_TOKEN = re.compile(r"%(.)|([^%]+)|%", re.DOTALL)


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def tokens(fmt: str) -> list[tuple[str, str]]:
    """Split a format into ``("spec", letter)`` and ``("text", literal)`` parts."""
    out = []
    for m in _TOKEN.finditer(fmt):
        spec, text = m.groups()
        if spec == "%":
            out.append(("text", "%"))
        elif spec is not None:
            if spec not in SPECIFIERS and spec != WEEK:
                raise ValueError(f"unsupported date format specifier %{spec} in {fmt!r}")
            out.append(("spec", spec))
        elif text is not None:
            out.append(("text", text))
        else:
            raise ValueError(f"date format ends in a lone %: {fmt!r}")
    return out


def output_pieces(fmt: str) -> list[tuple[str, str]]:
    """Runs of ``("pattern", spark_pattern)``, ``("text", literal)`` and ``("week", "")``."""
    out: list[tuple[str, str]] = []
    for kind, v in tokens(fmt):
        if kind == "spec" and v == WEEK:
            out.append(("week", ""))
            continue
        pattern = SPECIFIERS[v] if kind == "spec" else _quote(v)
        if out and out[-1][0] == "pattern":
            prev = out[-1][1]
            # Two quoted runs side by side would read as an escaped quote.
            joined = prev[:-1] + pattern[1:] if prev.endswith("'") and pattern.startswith("'") else prev + pattern
            out[-1] = ("pattern", joined)
        else:
            out.append(("pattern", pattern))
    return out


def parse_pattern(fmt: str) -> str:
    """One Spark pattern that parses texts written with ``fmt``."""
    parts = tokens(fmt)
    out = ""
    for i, (kind, v) in enumerate(parts):
        if kind == "text":
            q = _quote(v)
            out = out[:-1] + q[1:] if out.endswith("'") else out + q
            continue
        if v in NOT_PARSED:
            raise ValueError(f"cannot parse dates by %{v}")
        pattern = SPECIFIERS[v]
        beside_number = any(
            0 <= j < len(parts) and parts[j][0] == "spec" and parts[j][1] != "p" for j in (i - 1, i + 1)
        )
        if not beside_number:
            pattern = re.sub("MMM+|[A-Za-z]+", lambda m: LENIENT.get(m.group(), m.group()), pattern)
        out += pattern
    return out

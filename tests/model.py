"""Pure-Python sequential models used as oracles in tests (never used by the library)."""

import itertools
import re

from keyline.functions.text import WHITESPACE

_INT = re.compile(r"^[+-]?[0-9]+$")


def py_parse(line):
    """(number, text) or None, following the record format's rules."""
    if line is None or line == "":
        return None
    dot = line.find(".")
    if dot == -1 or dot + 1 >= len(line):
        return None
    num = line[:dot].strip(WHITESPACE)
    text = line[dot + 1 :].strip(WHITESPACE)
    if not _INT.match(num):
        return None
    n = int(num)
    if not -(2**63) <= n < 2**63:
        return None
    return n, text


def key(rec):
    return (rec[1].encode("utf-16-be", "surrogatepass"), rec[0])


def fmt(rec):
    return f"{rec[0]}. {rec[1]}"


def audit_model(original, sorted_lines, require_duplicates=True):
    """The audit's fields of two lists of lines, each from its definition: the violation is
    the first line shown (not blank) that is no record or comes before the one above it."""
    shown = [(no, line, py_parse(line)) for no, line in enumerate(sorted_lines, 1) if line and line.strip(WHITESPACE)]
    valid = list(itertools.takewhile(lambda x: x[2] is not None, shown))
    falls = [i for i in range(1, len(valid)) if key(valid[i][2]) < key(valid[i - 1][2])]
    first_bad = falls[0] if falls else len(valid)
    held = [rec for _, _, rec in valid[:first_bad]]
    found = first_bad < len(shown)
    no, line, rec = shown[first_bad] if found else (len(sorted_lines), None, None)
    out = {
        "original_lines": len(original),
        "sorted_lines": no,
        "is_sorted": not found,
        "violation_line": no if found else -1,
        "previous_line": None,
        "current_line": (fmt(rec) if rec else line) if found else None,
        "found_duplicate": any(a[1] == b[1] for a, b in zip(held, held[1:])),
        "line_counts_match": no == len(original),
    }
    if found:
        out["previous_line"] = fmt(held[-1]) if held else "N/A (first or previous was invalid)"
    reasons = {
        "order_violation": found,
        "count_mismatch": not out["line_counts_match"],
        "no_duplicates": require_duplicates and not out["found_duplicate"],
    }
    out["status"] = next((name for name, holds in reasons.items() if holds), "ok")
    out["passed"] = out["status"] == "ok"
    return out

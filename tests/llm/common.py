"""Fixtures of the text operators' tests: documents with every odd case, and brute-force helpers."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, items string, bucket string"


def prose(seed: int, n: int, per: int = 8) -> str:
    """Invented sentences, different for each seed."""
    out, x = [], seed * 7919 + 13
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("w%x" % (x % 100003) + ("." if i % per == per - 1 else ""))
    return " ".join(out) + "."


def odd_documents():
    """Nulls, empty and white-space texts, ties, repeated rows and ids, columns with clashing names."""
    base = prose(1, 120)
    rows = [
        (1, base), (2, base), (3, base + " Extra words here."), (4, prose(2, 60)), (4, prose(2, 60)), (5, prose(3, 90) + " " + base), (6, None), (7, ""), (8, " \n\t "),
        (9, "one two"), (10, "One TWO"), (None, prose(4, 50)), (None, None), (11, prose(5, 70)), (11, prose(6, 80)), (12, "Große Straße. ÀÉ ñandú! “Zitat” 你好。世界。"), (13, prose(7, 30000)), (14, "word " * 400),
    ]
    return [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else f"s{k % 3}", None, k, "x", None) for k, (i, t) in enumerate(rows)]


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, text or "")


def ascii_lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})

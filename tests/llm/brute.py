"""Plain versions of the text operators, for small tables."""

from __future__ import annotations

import hashlib
import re

BLANK = re.compile(r"[\x20\x09-\x0D]")


def suffix_dedup(docs, length=50):
    least = {}
    for doc, text in sorted(docs):
        body = (text or "").encode()
        for place in range(len(body) - length + 1):
            least.setdefault(body[place : place + length], doc)
    out = {}
    for doc, text in docs:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for place in range(len(body) - length + 1):
            if least[body[place : place + length]] < doc:
                gone[place : place + length] = b"\1" * length
        kept = bytes(byte for byte, mark in zip(body, gone, strict=True) if not mark)
        runs = sum(1 for place in range(len(gone)) if gone[place] and (place == 0 or not gone[place - 1]))
        out[doc] = (len(body), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def words(text):
    lowered = "".join(chr(ord(letter) + 32) if "A" <= letter <= "Z" else letter for letter in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles(text, width):
    own = words(text)
    if len(own) < width:
        return {tuple(own)} if own else set()
    return {tuple(own[place : place + width]) for place in range(len(own) - width + 1)}


def near_copies(docs, width, over, under):
    sets = {doc: shingles(text, width) for doc, text in docs}
    root = {doc: doc for doc in sets}

    def top(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    ids = sorted(sets)
    for place, one in enumerate(ids):
        for two in ids[:place]:
            left, right = sets[one], sets[two]
            common = len(left & right)
            if left and right and under * common >= over * (len(left) + len(right) - common):
                one_top, two_top = sorted((top(one), top(two)))
                root[two_top] = one_top
    return {doc: (len(sets[doc]), top(doc)) for doc in sets}


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + place % 2) for place, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def personal_data(text):
    found = []
    for number, (kind, pattern) in enumerate(PII.items()):
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match.group())
            fits = {
                "email": True,
                "ip": kind != "ip" or all(int(part) <= 255 for part in match.group().split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fits:
                found.append((match.start(), number, match.end(), kind))
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found))


def edits(item, text):
    """Fewest edits that turn ``item`` into some part of ``text``."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for letter in text:
        new = [0]
        for place, own in enumerate(item, 1):
            new.append(min(row[place] + 1, new[-1] + 1, row[place - 1] + (own != letter)))
        row = new
        best = min(best, row[-1])
    return best

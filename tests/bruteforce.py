"""Plain-Python answers for small fixtures, against which the Spark operators are checked."""

from __future__ import annotations

import re

from postweave.functions import extract as X

_I = re.IGNORECASE
_IM = re.IGNORECASE | re.MULTILINE


def first(text, patterns, flags=_IM, fits=lambda s: True):
    for found in (re.search(p, text, flags) for p in patterns):
        if found and fits(found[1].strip()):
            return found[1].strip()


def title(t):
    return first(t, X.TITLE_PATTERNS)


def company(t):
    return first(t, X.COMPANY_PATTERNS)


def location(t):
    return first(t, X.LOCATION_PATTERNS, fits=lambda s: 2 < len(s) < 100)


def employment(t):
    got = first(t, X.EMPLOYMENT_PATTERNS, _I)
    return got.lower() if got is not None else None


# The salary patterns with all their optional parts.
SALARY_PATTERNS = (
    r"(?:\$|USD|GBP|EUR)?\s*(\d{2,3}(?:,\d{3})?(?:k|K)?)\s*(?:-|–|to)\s*(?:\$|USD|GBP|EUR)?\s*(\d{2,3}(?:,\d{3})?(?:k|K)?)\s*(?:\s*(?:/year|/yr|/annum|yearly|/hr|/hour|hourly|monthly|/mo))?",
    r"(?:salary|range|pay)[:\s]+(?:\$|USD|GBP|EUR)?\s*(\d[\d,]*)\s*(?:-|–|to)\s*(?:\$|USD|GBP|EUR)?\s*(\d[\d,]*)",
)


def amount(s):
    s = s.lower().replace(",", "")
    n = int(s[:-1]) * 1000 if s[-1] == "k" else int(s) if int(s) >= 1000 else 0
    return n if 0 < n < 5_000_000 else None


def salary(t):
    pairs = ([amount(a), amount(b)] for p in SALARY_PATTERNS for a, b in re.findall(p, t, _I))
    for pair in pairs:
        if None not in pair:
            return tuple(sorted(pair))


def skills(t):
    return [s for s in X.SKILLS if s.lower() in t.lower()]


def description(t):
    lines = [x.strip() for x in t.split("\n")]
    head = re.compile("(?:" + "|".join(X.DESCRIPTION_HEADERS) + r")[:\s]", _I)
    start = next((i for i, x in enumerate(lines) if head.match(x)), None)
    return t[:2000] if start is None else "\n".join([x for x in lines[start:] if x][:100])


def fingerprint_text(t):
    two = " ".join(t.strip().split("\n")[:2]).lower()
    return " ".join(re.sub(X.FINGERPRINT_NOISE, " ", two).split())


def keep_first(rows, by_fingerprint=True, target=None):
    """rows: (source, external_id, fingerprint) in arrival order → kept positions, dropped per source."""
    ids, prints, kept, dropped = set(), set(), [], {}
    for i, (source, ext, fp) in enumerate(rows):
        if target is not None and len(kept) >= target:
            break
        twice = bool(ext) and ext in ids
        if ext:
            ids.add(ext)
        if not twice and by_fingerprint:
            twice = fp in prints
            prints.add(fp)
        if twice:
            dropped[source] = dropped.get(source, 0) + 1
        else:
            kept.append(i)
    return kept, dropped

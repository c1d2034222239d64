"""Small tables with every kind of awkward row, and plain readings of the word rules."""

from __future__ import annotations

import random
import re

from postweave.llm.common import ALNUM, SPACED

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHING = (
    "key", "tkey", "size", "node", "row", "found", "n_words", "kept", "token", "before", "bin", "epoch", "given", "cut", "part", "q", "stratum",
    "component", "component_id", "taken", "target", "source_size", "k_doc_id", "items", "lines", "chunks", "host", "wrapper", "html2",
)


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def alnum(text):
    return re.findall(ALNUM, lower(text))


def spaced(text):
    return re.findall(SPACED, lower(text))


def awkward(seed: int = 1, n: int = 60):
    """Rows of ordinary texts, copies, near copies, and odd ones."""
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "Straße", "naïve", "x1", "K", "a-b", "it's", "data", "RUN", "word", "42", "é", "blue", "green"]
    rows = []
    for i in range(n):
        text = " ".join(rnd.choice(vocabulary) + str(rnd.randint(0, 40)) for _ in range(rnd.randint(0, 60)))
        rows.append((i, text, rnd.choice(["en", "de", None, "EN-us"]), rnd.choice(["a", "b", "c", None]), len(text)))
    texts = [r[1] for r in rows]
    long = " ".join(f"w{rnd.randint(0, 5000)}" for _ in range(30_000))
    odd = [None, "", " \t\n", "one", "Two words", "\n\n", "x" * 20_000, long, long + " end", texts[3], texts[3], texts[5].upper(), "😀   \x85 K"]
    rows += [(100 + i, t, "en", "a", len(t or "")) for i, t in enumerate(odd)]
    rows += [(3, texts[3], "en", "b", 0), (3, texts[3], "en", "b", 0), (None, texts[4], None, None, None), (None, None, None, None, None)]
    return rows


def clashing(df):
    """df with further columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("other") for c in CLASHING if c not in df.columns})

"""Small documents for the operators: copies, near copies, shared passages, odd rows."""

from __future__ import annotations

import random

VOCABULARY = [a + b for a in ("ka", "lo", "mi", "ne", "su", "ta") for b in ("ra", "di", "fo", "gu", "vel", "ston", "mar")]


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(VOCABULARY) + str(draw.randrange(40)) for _ in range(words))


def corpus() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) with nulls, empty and blank texts, copies and passages."""
    passage = prose(900, 70)
    texts = [prose(k, 60 + 7 * k) for k in range(14)]
    texts += [texts[3], texts[3] + " tail", texts[5].replace("ka", "KA")]
    near = texts[8].split()
    near[40] = "changed"
    texts += [" ".join(near), prose(50, 30) + " " + passage, passage + "\n" + prose(51, 45), prose(52, 20) + "\t" + passage]
    texts += [None, "", " \t\n", "one two", "one two", "ONE two", "a " * 300, "ab" * 900, prose(77, 5000)]
    rows = [(k, t, "en", f"src{k % 3}" if k % 7 else None, len(t or "")) for k, t in enumerate(texts)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

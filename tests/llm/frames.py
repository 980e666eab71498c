"""Small document tables with every awkward case."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns with names that operators use inside.
EXTRA = "size string, target string, kept string, removed string, rk string, node string, n string, l string, key string, copies string, part string, root string, _key string, _n string, n_words string"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["er", "ti", "on", "an", "the", "st", "é", "ou"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def awkward():
    """Rows with nulls in every column, empty, short and very long texts, ties and repeated rows."""
    long = prose(1, 30_000)
    base = prose(2, 120)
    near = base.replace(base.split()[60], "changed", 1)
    passage = prose(3, 60)
    return [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, near, "en", "a", 1), (3, near, "en", "a", 1), (4, None, None, None, None), (None, "text without an id here", "en", "a", 1),
        (None, base, "fr", None, 1), (5, "", "en", "b", 0), (6, " \t\n", "en", "b", 3), (7, "one", "de", "b", 3), (8, long, "en", "c", 1), (9, "x" * 20_000, "en", "c", 1),
        (10, f"{prose(4, 40)} {passage} {prose(5, 40)}", "en", "a", 1), (11, f"{prose(6, 50)} {passage} {prose(7, 20)}", "en", "a", 1), (12, "same\nsame\nother line\n" + base, "en", "a", 1),
        (13, "a b c " * 100, "en", "c", 1), (14, 'token = "0123456789abcdef0123456789abcdef"', "en", "c", 1), (15, prose(8, 80) + "\x00\U0001f600'll", "en", "d", 1),
        *[(20 + k, prose(100 + k, 30 + k), ["en", "fr", None][k % 3], ["a", "b", None][k % 3], 1) for k in range(20)],
    ]


def extended(rows):
    """The same rows with clashing extra columns."""
    names = EXTRA.split(", ")
    return [(*r, *[str(k) for k in range(len(names))]) for r in rows]

"""A small table with every awkward case: nulls, empty, long, ties, repeats, and near copies."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slot string, len int, key string"


def documents(seed=3, n=220):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéüñ") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passage = prose(120)
    base = prose(90).split()
    rows = []
    for i in range(n):
        kind = i % 11
        if kind == 0:
            text = prose(rng.randint(1, 5))
        elif kind == 1:  # near copies of one text
            own = list(base)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = rng.choice(words)
            text = " ".join(own)
        elif kind == 2:
            text = prose(40) + " " + passage + " " + prose(30)
        elif kind == 3:
            text = rows[-3][1] if len(rows) > 3 else prose(20)
        elif kind == 4:
            text = (rows[-2][1] or "").upper() if len(rows) > 3 else prose(20)
        elif kind == 5:
            text = rng.choice([None, "", " \t\n", "...", "12 34", "x"])
        elif kind == 6:
            text = prose(20) + rng.choice([' password = "hunter22x"', " AKIA" + "A1B2" * 5, " " + "0a9f" * 10, " TOKEN:abc", " api_key=abc.def/ghi"]) + " " + prose(5)
        elif kind == 7:
            text = passage[: 350 + rng.randint(0, 200)] + prose(10)
        else:
            text = prose(rng.randint(10, 200))
        lang = rng.choice(["aa", "bb", None])
        rows.append((i, text, lang, rng.choice(["s0", "s0", "s0", "s1", "s2", None]), len(text) if text else None, "x", 5, "k"))
    rows.append((n, " ".join([prose(400)] * 3 + ["z" * 5000]), "aa", "s0", 1, None, None, None))
    return rows

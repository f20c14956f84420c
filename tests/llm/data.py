"""Small tables with every odd case, and plain models of the operators."""

import random

SCHEMA = "doc_id long, text string, source string, n_chars long, id long, key string, bucket int, row string, n_lines int"
SPACES = " \t\n\x0b\x0c\r"


def words(text):
    out, word = [], ""
    for c in text or "":
        if c in SPACES:
            out, word = out + [word] if word else out, ""
        else:
            word += c
    return out + [word] if word else out


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def prose(rng, n, kinds=4000):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


def texts(seed=1):
    """Texts with nulls, blanks, copies, near copies, shared passages, repeats inside, and a long one."""
    rng = random.Random(seed)
    base, passage = prose(rng, 120), prose(rng, 50)
    near = []
    for i in range(12):
        w = base.split()
        for _ in range(i % 5):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        near.append(" ".join(w))
    shared = [prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40) for _ in range(6)]
    inside = prose(rng, 10) + " " + passage[:200] + " tail " + passage[:200]
    loop = " ".join(["a", "b"] * 60)
    long = prose(rng, 30_000, 10**6)
    odd = [None, "", "   \n\t ", "one", "One", "one two three", "ONE TWO  THREE", "é È ß Straße", "a b c　d", "日本語のテキスト" * 20]
    return odd + near + [near[0]] * 3 + [near[0].upper()] + shared + [inside, loop, loop + " c", long, "end.\n\nfoot\nend."]


def frame(spark, rows):
    """``(doc_id, text, source)`` rows with further columns whose names operators use themselves."""
    full = [(i, t, s, len(t or ""), 7, "k", 3, "r", 1) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def rows(seed=1):
    out = [(i, t, f"s{i % 3}" if i % 7 else None) for i, t in enumerate(texts(seed))]
    return out + [(None, "no id here", "s1"), out[12]]

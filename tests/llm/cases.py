"""Documents with nulls, empty and long texts, ties, repeated rows and columns that clash with the operators' own."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rest string, key long, component_id string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n, words=None):
    words = words or ["the", "of", "and", "river", "stone", "house", "quiet", "morning", "letter", "garden", "window", "paper", "music", "über", "niño", "façade"]
    return " ".join(rng.choice(words) + (rng.choice("abcdefgh") if rng.random() < 0.5 else "") for _ in range(n))


def documents(seed=1):
    rng = random.Random(seed)
    passage = prose(rng, 70)
    rows = [(i, prose(rng, rng.randint(1, 120))) for i in range(40)]
    rows += [(100 + i, rows[i][1]) for i in range(6)]  # copies
    rows += [(200 + i, rows[i][1] + " more") for i in range(6)]  # near copies
    rows += [(300 + i, f"{prose(rng, 30)}\nPage {i} of 99 pages\n{passage} {prose(rng, 20)}") for i in range(12)]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "word"), (404, prose(rng, 30_000)), (None, prose(rng, 40)), (None, None)]
    rows += [rows[3], rows[3]]  # repeated rows
    rows += [(500, "a " * 300), (501, "日本語 テキスト é́ 😀 " * 20)]
    return [(i, t, rng.choice(["en", "de", None]), "src", None if t is None else len(t), "x", 7, "c") for i, t in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def components(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}

"""Small tables with the cases every operator must survive."""

from __future__ import annotations

import random

CLASHING = "key bigint, line string, rep string, component string, shard int, _row string, a int"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    """Invented words in lines of about a dozen."""
    random.seed(seed)
    out = []
    for i in range(words):
        out.append("".join(random.choice("bcdfglmnprst") + random.choice("aeiou")
                           for _ in range(1 + random.randrange(vocabulary) % 3)))
    lines = [" ".join(out[i : i + 12]) for i in range(0, len(out), 12)]
    return "\n".join(lines)


def changed(text: str, seed: int, words: int) -> str:
    """The text with some words replaced."""
    random.seed(seed)
    parts = text.split(" ")
    for i in random.sample(range(len(parts)), words):
        parts[i] = f"x{seed}y{i}"
    return " ".join(parts)


def documents(spark, clashing: bool = True):
    """Nulls, empty and long texts, copies, near copies, ties and repeated rows."""
    base, other = prose(1, 300), prose(2, 120)
    rows = [
        (10, base), (11, base), (11, base), (12, changed(base, 3, 3)), (13, changed(base, 4, 4)),
        (14, changed(base, 5, 40)), (20, None), (21, ""), (22, " \n\t "), (23, "lone"),
        (24, "two words"), (25, "two words"), (30, other), (31, other.upper()), (32, other),
        (32, prose(9, 80)), (None, base), (None, None), (40, prose(7, 20_000)),
        (41, "zürich  ça\x0bva nicht é " * 30), (42, "same words again " * 40),
        (43, base + "\n" + other), (-5, prose(8, 60)), (44, "# * $ % & | < > 12 34\n" * 9),
    ]
    rows += [(100 + i, prose(100 + i, 70) + f"\nPage {i} of the valley news\nall rights reserved")
             for i in range(30)]
    data = [
        (d, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"host{i % 2}",
         None if t is None else len(t))
        for i, (d, t) in enumerate(rows)
    ]
    if not clashing:
        return spark.createDataFrame(data, DOCUMENTS)
    more = [(*r, i, f"l{i}", "r", None, i, "row", 1) for i, r in enumerate(data)]
    return spark.createDataFrame(more, f"{DOCUMENTS}, {CLASHING}")


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def pairs_of(df) -> list[tuple]:
    """doc_id and text of every row."""
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]

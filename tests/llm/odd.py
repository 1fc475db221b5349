"""Documents with nulls, blanks, long texts, ties, repeated rows and clashing columns, shared by the tests."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size string, kept int, target string, "
    "row string, frequent string, fingerprint string, block string, places string, label string"
)
PASSAGE = " ".join(f"passage{i}" for i in range(60))
STORY = " ".join(f"word{i * 7 % 97}" for i in range(300))
TEXTS = [
    (1, STORY), (1, STORY), (2, STORY + " tail"), (3, None), (4, ""), (5, " \n\t\x0b "), (None, "lonely words here"),
    (None, None), (6, "one"), (7, "ONE"), (8, "é ünï code 　 x"), (9, "a b " * 3000), (10, f"start {PASSAGE} end"),
    (11, f"other beginning {PASSAGE}"), (12, "\n".join(["same line of some words"] * 30)), (13, STORY.upper()),
    (14, " ".join(f"unique{i}" for i in range(120))), (15, "<|endoftext|> x  y"), (16, "x" * 20000),
]


def rows():
    sources = ["b", "a", None, "é"]
    return [
        (i, t, "en", sources[n % 4], len(t or ""), "s", 0, "t", "r", "f", "p", "b", "q", "l") for n, (i, t) in enumerate(TEXTS)
    ]


def documents(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)


def words(text):
    return WORD.findall(text or "")


def lower_words(text):
    return [w.translate(LOWER) for w in words(text)]

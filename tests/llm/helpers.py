"""Shared by the tests: a corpus with every awkward case."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int = 60, lines: int = 3) -> str:
    r = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("ba", "ke", "li", "mo", "nu", "sy", "tra") for b in ("lor", "men", "dis", "pur", "ven", "kal")]
    each = [" ".join(r.choice(vocabulary) for _ in range(words // lines)) + "." for _ in range(lines)]
    return "\n".join(each)


def docs(spark, *texts, first: int = 1):
    return spark.createDataFrame([(first + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)], DOCS)


def awkward(spark):
    """Nulls, empty, white space, one word, repeats, copies, a null id, a very long text."""
    a, b = prose(1), prose(2)
    rows = [(1, a, "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0), (4, " \t\n ", "en", "s", 4), (5, "word", "en", "s", 4), (6, a, "en", "s", 1), (6, a, "en", "s", 1), (7, b, "en", "s", 1), (None, a, "en", "s", 1), (None, None, None, None, None), (8, a + " more words at the end", "en", "s", 1), (9, "long " * 60000 + b, "en", "s", 1)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(frame, *names):
    """The frame with more columns, of names that an operator may use inside."""
    out = frame
    for n in names:
        out = out.selectExpr("*", f"'mine' AS `{n}`")
    return out


def corpus(spark, n: int = 60):
    """Prose with copies, near copies, shared lines and passages."""
    r, texts = random.Random(9), []
    shared = prose(500, 40, 1)
    for k in range(n):
        t = prose(k, r.choice([30, 90, 300]))
        if k % 5 == 0:
            t = t + "\n" + shared
        if k % 7 == 3:
            t = texts[k - 2]
        if k % 7 == 5:
            words = texts[k - 4].split(" ")
            words[len(words) // 2] = "changed"
            t = " ".join(words)
        texts.append(t)
    return docs(spark, *texts, first=1000)

"""Small tables with the awkward rows every operator must stand."""

import random

CLASH = "key string, id string, h1 string, n string, start string, end string, length string, rank string, spans string, text_ string"


def documents(spark, rows, clash=True):
    """``documents`` of (doc_id, text), with extra columns whose names operators use inside."""
    extra = ", component_id string, n_shingles string, doc_tokens string, component string, node string, __id string" if clash else ""
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}{extra}"
    width = len(schema.split(",")) - 2
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), *["x"] * (width - 3)) for i, t in rows], schema)


def prose(seed, n, vocabulary=400):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 7))) for _ in range(vocabulary)]
    return [rnd.choice(words) for _ in range(n)]


def corpus(seed=1, groups=25):
    """Random texts with copies and near copies of several strengths."""
    rnd, rows, number = random.Random(seed), [], 0
    for g in range(groups):
        base = prose(seed * 1000 + g, rnd.choice([1, 2, 3, 5, 9, 12, 20, 30, 60, 150, 400]))
        for _ in range(rnd.randint(1, 6)):
            words = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 8])):
                at = rnd.randrange(len(words))
                words[at : at + 1] = rnd.choice([[], ["new%d" % rnd.randrange(999)], [words[at], "more"]])
                words = words or ["w"]
            rows.append((number, (" " if rnd.random() < 0.8 else "\n").join(words)))
            number += 1
    rnd.shuffle(rows)
    return rows


AWKWARD = [(900, None), (901, ""), (902, " \n\t "), (None, "without an id"), (903, "word"), (904, "WORD"), (905, "word " * 30000), (906, "word " * 30000), (907, "a b"), (907, "a b")]

"""Small documents with every kind of row that an operator has to bear."""

import random

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "kept boolean, n_tokens bigint, key string, text_hash bigint, component_id bigint, node bigint, part int, "
          "`meta.url` string, __id int, __hash string, __score string, __gone int, `a``b` int")


def words(seed, n, letters="abcdefgh"):
    draw = random.Random(seed)
    return ["".join(draw.choice(letters) for _ in range(draw.randint(2, 7))) for _ in range(n)]


def edited(text, at, new="zzz"):
    found = text.split(" ")
    found[at] = new
    return " ".join(found)


def rows():
    base = " ".join(words(1, 120))
    texts = [
        (1, base), (2, base), (2, base), (3, edited(base, 5)), (4, edited(edited(base, 5), 60)),
        (5, None), (6, ""), (7, " \n\t "), (8, "Short one."), (9, "short ONE."), (10, "Short  one."),
        (None, "without an id"), (None, None), (11, base.replace(" ", "\n")), (12, base.upper()),
        (13, "\x00 a  b\x1c  c  d'll 12.5 ² 日本語 \U0001f600 "),
        (14, " ".join(words(2, 30_000))), (15, "x" * 5000), (16, "\n\n" + base + "\n\nlast line"),
        (17, "Released under the MIT License.\nother"), (18, "Short one."),
    ]
    return [(i, t, None if n % 5 == 0 else "en", None, None, True, -1, "k", 7, 8, 9, 1, "u", n, "h", "s", 3, 4) for n, (i, t) in enumerate(texts)]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs():
    """(doc_id, text) with null texts as empty."""
    return [(r[0], r[1] or "") for r in rows()]


class Groups:
    """Plain union-find."""

    def __init__(self):
        self.above = {}

    def find(self, x):
        self.above.setdefault(x, x)
        while self.above[x] != x:
            x = self.above[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)

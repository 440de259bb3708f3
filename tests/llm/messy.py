"""Small tables with everything that may go wrong in a row."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long,"
          " name string, code string, digest string, bands string, kept boolean, n long")


def sentences(rng, n, kinds=400):
    return " ".join(f"w{int(rng.paretovariate(0.6)) % kinds}" for _ in range(n))


def rows():
    rng = random.Random(3)
    base = sentences(rng, 300)
    passage = sentences(rng, 60)
    texts = [None, "", " \t\n", "a", "a b  c", "A b\tC", base, base, base.replace(" ", "  "),
             base + " tail words here", "x " + base, "la " * 200, "la " * 25,
             "one two three " * 80, sentences(rng, 30_000),
             sentences(rng, 90) + "\n" + passage + "\n" + sentences(rng, 90),
             passage + " " + sentences(rng, 200), sentences(rng, 50) + " " + passage,
             "é\u00a0ü \u3000 ß\x85 z\x1c q", "a | b | c | d | e | f | g | h | i | j | k",
             "<|endoftext|> mid<|endoftext|>dle  <|endoftext|>", "\U0001f600 ok\r\n\r\n  x'll 'S",
             "10 %%% $$$ ### 20 &&& *** 30 ||| <<< >>> 40 50 60 70"]
    texts += [sentences(rng, rng.randint(1, 400)) for _ in range(30)]
    for _ in range(25):         # near copies with a few changed words
        w = base.split()
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 6)}"
        texts.append(" ".join(w))
    out = []
    for i, t in enumerate(texts):
        source = [None, "s", "S", "a", "ü"][i % 5]
        out.append((3 * i - 40, t, None if i % 7 == 0 else "en", source, None, i, "n", "c", "d",
                    "b", None, 5))
    return out


def documents(spark, extra=()):
    return spark.createDataFrame(rows() + list(extra), SCHEMA)


def repeated():
    """A row without id, and rows that repeat others."""
    known = rows()
    return [(None, *known[6][1:]), (None, "only here " + known[14][1][:900], *known[6][2:]),
            known[7], known[20]]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)

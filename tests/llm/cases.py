"""Small tables with everything that operators must bear: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    T.StructField("row", T.StringType()), T.StructField("score", T.StringType()), T.StructField("size", T.IntegerType()), T.StructField("kept", T.BooleanType()), T.StructField("fp", T.StringType()), T.StructField("a.b c", T.StringType()),
])
WORDS = {
    "en": "the and of is with that for nation thing other water under light house again never table green".split(),
    "fr": "le la les des une pour avec être maison eau lumière très été forêt jamais toujours où déjà".split(),
    "de": "der die das und nicht mit über wasser straße licht für schön grün haus immer wieder könnte auch".split(),
}


def prose(r, lang="en", n=60):
    w = [r.choice(WORDS[lang]) + r.choice(("", "", "s", "er", "ly", "on")) for _ in range(n)]
    return " ".join(x.capitalize() if i % 12 == 0 else x + ("." if i % 12 == 11 else "") for i, x in enumerate(w))


def rows(seed=1, n=120):
    r = random.Random(seed)
    out = []
    for i in range(n):
        lang = r.choice(("en", "en", "fr", "de"))
        out.append((i, prose(r, lang, r.randint(5, 120)), lang, f"s{i % 5}"))
    texts = [x[1] for x in out]
    out += [(n + i, texts[3], "en", "hot") for i in range(40)]  # copies
    out += [(n + 50, None, None, None), (n + 51, "", "en", "s1"), (n + 52, "", None, "s2"), (None, texts[5], "en", "s1"), (None, None, None, None), (n + 53, " \n\t ", "en", "s3"), (n + 54, "12 34 !!", "en", "s3")]
    out += [out[7], out[7], (8, "other text of the same id", "en", "s4")]  # repeated rows, ties
    out.append((n + 60, " ".join([texts[9]] * 400), "en", "s1"))  # long
    out.append((n + 61, "x" * 50_000, "en", "s1"))  # one word
    return out


def frame(spark, data):
    full = [(i, t, lang, s, None if t is None else len(t), "r", "q", 7, None, None, "z") for i, t, lang, s in data]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)

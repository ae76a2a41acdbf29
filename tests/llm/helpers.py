"""Small document tables with the awkward cases every operator must take."""

import random
import zlib

WORDS = "the of and in to was for with that from river stone light house garden winter summer paper letter number".split()
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def documents(spark, texts, ids=None, lang="en"):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCUMENT)


AWKWARD = [None, "", " ", "\n\n", "a", "ÄÖ ü x", "don't  stop <|endoftext|> now", "x" * 50_000, "word " * 30_000, "🙂 é ß", "same text here", "same text here", "\t\x0b tabs \x1f", "1" * 30_000, "1 " * 20_000]


def crc(text):
    return zlib.crc32((text or "").encode())

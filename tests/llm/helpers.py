from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    syllables = "an ber cor del en fi go hu in jo ka lu mi no or pe qua ri so tu".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents(spark, rows, extra: bool = False):
    """rows: (doc_id, text) or (doc_id, text, lang, source); ``extra`` adds columns whose names operators use inside."""
    full = [(*r, *(None, None, None)[: 4 - len(r)], None if r[1] is None else len(r[1])) if len(r) < 4 else (*r, None if r[1] is None else len(r[1])) for r in rows]
    full = [r if len(r) == 5 else (r[0], r[1], None, None, r[-1]) for r in full]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:
        for name in ("tag", "n", "score", "key", "node", "first", "window", "_row", "mix_tokens", "quality_score", "item_id"):
            df = df.selectExpr("*", f"'x' as {name}")
    return df


def odd(rng: random.Random) -> list[tuple]:
    """NULLs, empty, blank and very long texts, repeated rows and ties."""
    long = prose(rng, 30_000)
    same = prose(rng, 80)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, long), (5, same), (5, same), (6, same), (7, same + " " + prose(rng, 60)),
        (8, "x" * 50_000), (9, "one two"), (10, "one two"), (None, same), (None, None),
    ]

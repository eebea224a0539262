"""Small tables with every odd case: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

WORDS = "alpha beta gamma delta the of and to licence über naïve été x 7 42 foo bar baz qux".split()


def texts(n: int, seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)
    out: list[str | None] = [None, "", " ", "\n\n\t", "a", "ñ", "7 7", "a" * 3000, "same words here " * 400, "same words here " * 400, "漢字 テスト ok", "İſK σς —’ ½ \x85 \x1c", "<|endoftext|> x"]
    while len(out) < n:
        out.append(" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 400))) + rng.choice(["", "\n", ".\nMore\nMore\n"]))
    return out[:n]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, rank int, host string, n_words long, shard int, key string, h long, n long"


def documents(spark, n: int = 60, seed: int = 1, repeat: bool = True):
    """doc_ids with a null and, if repeat, repeated rows; extra columns whose names clash with inner ones."""
    rows = [(i if i else None, t, ["en", "fr", "de", "es", None][i % 5], [None, "src0", "src0", "src1", "src2", "x"][i % 6], len(t or "")) for i, t in enumerate(texts(n, seed))]
    if repeat:
        rows += [rows[20]] * 5 + [rows[5]] * 2
    return rows, spark.createDataFrame([(*r, 1, 2, "h", 3, 4, "k", 5, 6) for r in rows], SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)

"""Language ID by hierarchical discrimination: the family first, then the language within it.

A text becomes counts of hashed byte trigrams. One-versus-one linear support vector machines choose
the family; within the family, one-versus-one machines separate its languages. All machines are trained
here, on a bounded sample of labelled documents (SAMPLE a language); predictions read whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import schema_of, shielded

#: Language families; labels that aren't listed make up the family OTHER.
FAMILIES = {"germanic": ("en", "de", "nl", "sv", "da", "no"), "romance": ("fr", "es", "it", "pt", "ro", "ca"), "slavic": ("ru", "uk", "pl", "cs", "sk", "bg")}
OTHER = "other"
BITS = 12
#: Labelled texts of each language that training reads, about, and languages that are learned at most (those with most
#: different texts). Machines are trained for pairs, so both bound the driver's work, however dirty the labels are.
SAMPLE, LANGUAGES = 500, 32
UNKNOWN = "und"
#: Texts are read in pieces of so many bytes, which bounds the memory of a very long one.
PIECE = 1 << 20


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), OTHER)


def features(text: bytes) -> np.ndarray:
    """Unit vector of square roots of hashed trigram counts; of lower-cased bytes, with digits, symbols and spaces as one space."""
    counts = np.zeros(1 << BITS)
    raw = TABLE[np.frombuffer(b" " + text + b" ", np.uint8)]
    for at in range(0, len(raw), PIECE):
        x = raw[at : at + PIECE + 2].astype(np.uint32)
        if len(x) > 2:
            code = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
            code = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
            counts += np.bincount(code, minlength=1 << BITS)
    root = np.sqrt(counts)
    norm = np.linalg.norm(root)
    return root / norm if norm else root


def byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    for c in range(97, 123):
        table[c] = table[c - 32] = c
    return table


TABLE = byte_table()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text)) if text else False


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 4.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine with squared hinge loss, by dual coordinate descent; y is 1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    diagonal = (x * x).sum(1) + 0.5 / cost
    order = np.random.default_rng(42)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)):
            g = y[i] * (x[i] @ w) - 1 + alpha[i] * 0.5 / cost
            new = max(alpha[i] - g / diagonal[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def train_pairs(x: np.ndarray, names: np.ndarray) -> dict:
    """One machine for each pair of names: {"names": [...], "w": rows in the order of combinations()}."""
    classes = sorted(set(names))
    weights = []
    for a, b in combinations(classes, 2):
        rows = (names == a) | (names == b)
        weights.append(train_svm(x[rows], np.where(names[rows] == a, 1.0, -1.0)))
    return {"names": classes, "w": np.array(weights).reshape(len(weights), x.shape[1] + 1)}


def vote(model: dict, v: np.ndarray) -> tuple[str, float]:
    """The name with most pairwise wins (then the larger summed margin) and how surely it beat the others, 0 to 1."""
    classes = model["names"]
    if len(classes) == 1:
        return classes[0], 1.0
    wins, sums, least = np.zeros(len(classes)), np.zeros(len(classes)), np.ones(len(classes))
    margins = model["w"][:, :-1] @ v + model["w"][:, -1]
    for (a, b), m in zip(combinations(range(len(classes)), 2), margins, strict=True):
        sure = 1 / (1 + np.exp(-4 * m))
        wins[a if m >= 0 else b] += 1
        sums[a] += m
        sums[b] -= m
        least[a], least[b] = min(least[a], sure), min(least[b], 1 - sure)
    best = max(range(len(classes)), key=lambda i: (wins[i], sums[i], -i))
    return classes[best], float(least[best])


def fit(x: np.ndarray, langs: np.ndarray) -> dict:
    """The machines between families, and those within each family."""
    families = np.array([family_of(a) for a in langs])
    return {"families": train_pairs(x, families), "within": {f: train_pairs(x[families == f], langs[families == f]) for f in sorted(set(families))}}


def predict(model: dict | None, text: str | None) -> tuple[str, float]:
    """(language, score). A text that is null or has no letter is `und` with score 0, as is any text if nothing was learned."""
    if model is None or not text or not has_letter(text):
        return UNKNOWN, 0.0
    v = features(text.encode())
    family, sure = vote(model["families"], v)
    lang, surer = vote(model["within"][family], v)
    return lang, sure * surer


def learn(labelled: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES) -> dict | None:
    """Machines from (text, lang): about `sample` different texts a language, chosen by a hash of the text, of the
    `languages` labels with most different texts.

    The share that is drawn follows from the number of different texts (as a sketch estimates it), so a text
    that fills a language with copies doesn't crowd out the others. The sample's feature vectors, not texts,
    reach the driver: at most about sample x languages vectors of 2**BITS floats. Null languages and texts are
    left out. None if no row is left.
    """
    known = labelled.select("text", "lang").where("lang is not null and text is not null")
    different = known.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    sizes = {r["lang"]: r["n"] for r in different.collect()}
    if not sizes:
        return None
    share = F.lit(0.0)
    for lang, n in sorted(sizes.items()):
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / max(1, n)))).otherwise(share)
    drawn = known.withColumn("_h", F.xxhash64("text")).where(F.pmod("_h", F.lit(1 << 20)) < share * (1 << 20)).dropDuplicates(["lang", "_h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(lang, features(t.encode()).astype(np.float32).tobytes()) for lang, t in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True) if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], names=["lang", "v"])

    rows = sorted(((r["lang"], bytes(r["v"])) for r in drawn.select("lang", "text").mapInArrow(run, "lang string, v binary").collect()))
    if not rows:
        return None
    x = np.array([np.frombuffer(v, np.float32) for _, v in rows], dtype=np.float64)
    return fit(x, np.array([lang for lang, _ in rows]))


def identify(docs: DataFrame, model: dict | None, keep: list[str], text: str = "text") -> DataFrame:
    """The columns in keep, lang_pred and score for every row, by predict() over the whole text."""
    source = text if text in keep else "_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict(model, t.as_py()) for t in batch[source]]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array([a for a, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=[*keep, "lang_pred", "score"])

    read = [] if text in keep else [F.col(text).alias("_text")]
    return docs.select(*keep, *read).mapInArrow(run, schema_of(docs, keep, "lang_pred string, score double"))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves remainder 0; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def label(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; learned from the rows that are not held out.

    lang, source and doc_id are no inputs of a prediction: equal texts get equal results. Without any
    labelled row all texts are `und`. An empty table gives no rows; other columns are not read.
    """
    split = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    return identify(split, learn(split.where("not held_out"), sample), ["doc_id", "held_out"])


def relabelled(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs whose text is in a language that was learned, with lang as predicted.

    Texts that are null, empty or without a letter go, as does every row where no row has a label. Repeated rows
    stay as often as they come, texts of any length are read whole, an empty table gives no rows, and extra
    columns stay, whatever their names.
    """
    rows, names = shielded(docs, ["doc_id", "text", "lang"])
    found = identify(rows, learn(rows.where(~held_out(rows["doc_id"])), sample), [c for c in rows.columns if c != "lang"])
    return found.where(found["lang_pred"] != UNKNOWN).withColumnRenamed("lang_pred", "lang").select(*rows.columns).toDF(*names)

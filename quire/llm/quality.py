"""Quality rules at two levels: each document's own statistics, and verdicts over its host.

The base rules fail single documents. Their failures are counted by host; a host's rate is shrunk
towards the corpus with a beta prior fitted to all hosts by the method of moments. A host takes all its
documents along if its posterior stands out from the corpus: the shrunk rate is above the prior's mean by
BOUND posterior standard deviations, or above MAX_HOST_RATE whatever the corpus is like.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
MIN_WORDS = 50
#: A document fails if more than this share of its words, in percent, stands in repeated windows.
MAX_REPEATED = 50
#: A host goes as a whole if its shrunk failure rate is above this, or above the corpus's by so many standard deviations.
MAX_HOST_RATE, BOUND = 0.8, 1.0
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_stats(text: bytes, symbols: bytes = SYMBOLS, window: int = 3) -> tuple[int, int, int, int, int]:
    """STATS of a UTF-8 text. bytes.split() cuts at the six ASCII spaces and nothing else."""
    words = text.split()
    n = len(words)
    raw = np.frombuffer(text, np.uint8)
    chars = len(raw) - np.count_nonzero((raw & 0xC0) == 0x80) - sum(text.count(bytes([c])) for c in SPACES)
    n_symbols = sum(text.count(bytes([c])) for c in symbols)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if n > window:
        index: dict[bytes, int] = {}
        ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
        base, codes = len(index) + 1, ids[: n - window + 1].copy()
        if base**window < 1 << 62:
            for i in range(1, window):
                codes = codes * base + ids[i : n - window + 1 + i]
        else:  # a text with millions of different words: numbers for pairs first
            for i in range(1, window):
                codes = np.unique(codes * base + ids[i : n - window + 1 + i], return_inverse=True)[1]
        order = np.argsort(codes, kind="stable")
        same = codes[order][1:] == codes[order][:-1]
        if same.any():
            twice = np.zeros(len(codes), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            covered = np.zeros(n, bool)
            for i in range(window):
                covered[i : i + len(codes)] |= twice
            repeated = int(covered.sum())
    return n, int(chars), n_symbols, len(lines) - len(set(lines)), repeated


def with_stats(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns in keep and the statistics of every whole text; a null text has none of anything."""
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes) + "".join(f", {c} long" for c in STATS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [text_stats(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in batch["_text"]]
            cols = zip(*stats, strict=True) if stats else [[]] * len(STATS)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), *(pa.array(c, pa.int64()) for c in cols)], names=[*keep, *STATS])

    return docs.select(*keep, F.col("text").cast("binary").alias("_text")).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def host_verdicts(judged: DataFrame, host: str = "host", failed: str = "base_failed", max_rate: float = MAX_HOST_RATE, bound: float = BOUND) -> DataFrame:
    """host, n, failures, rate (shrunk) and host_failed. One row a host; a null host is one too.

    The prior's mean and variance are those of the hosts' rates, each host weighing alike. Without
    spread between hosts, or with one host, the prior weighs as much as the whole corpus, and all rates are its mean.
    The posterior of a host's rate is a beta distribution of n + weight trials; its deviation is sqrt(rate (1 - rate) / (n + weight + 1)).
    """
    hosts = judged.groupBy(host).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(failed).cast("long")).alias("failures"))
    rate = F.col("failures") / F.col("n")
    prior = hosts.agg(F.avg(rate).alias("mean"), F.var_samp(rate).alias("var"), F.sum("n").alias("rows"))
    spread = F.col("mean") * (1 - F.col("mean"))
    weight = F.when((F.col("var") > 0) & (spread > F.col("var")), spread / F.col("var") - 1).otherwise(F.col("rows").cast("double"))
    prior = prior.select("mean", weight.alias("weight"))
    shrunk = (F.col("failures") + F.col("mean") * F.col("weight")) / (F.col("n") + F.col("weight"))
    rates = hosts.join(F.broadcast(prior)).withColumn("rate", shrunk)
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("weight") + 1))
    out = (F.col("rate") > max_rate) | (F.col("rate") > F.col("mean") + bound * deviation)
    return rates.select(host, "n", "failures", "rate", out.alias("host_failed"))


def judge(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE, bound: float = BOUND) -> DataFrame:
    """doc_id, host, STATS, base_failed and kept for every row.

    Null and empty texts have no words and fail. Hosts are few next to documents: their verdicts come
    back by a join that Spark may broadcast by its own size check or split where a host is large. A
    null host is a host of its own. An empty table gives no rows; repeated rows count and return as
    often as they come; other columns are not read.
    """
    stats = stored(with_stats(docs.select("doc_id", F.col(host).alias("host"), "text"), ["doc_id", "host"]).withColumn("base_failed", base_failed()))
    verdicts = host_verdicts(stats, max_rate=max_rate, bound=bound).select(F.col("host").alias("_host"), "host_failed")
    joined = stats.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")).drop("_host", "host_failed")

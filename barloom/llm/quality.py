"""Quality rules of documents and of the hosts that they come from.

Every text is measured whole. A document fails when one of ``RULES`` does. Failures of each rule, and of the
weaker ``SIGNS`` that condemn no single document, are counted by host. A host's failure rate is shrunk, rule
by rule, towards the rate of all hosts with a beta prior fitted to that rule's counts by moments: a host with few
documents says little about itself and cannot be condemned by them. A host is rejected, with all its documents, when
for one rule the lower bound of its posterior rate (mean less ``SURE`` standard deviations) passes ``host_limit``.

A host is one row, made by partial aggregation; only the priors' sums, one row, reach the driver. Defined
cases: a null or empty text has no words and fails; a null host counts as the host "". Rows that repeat
are measured and counted each. An empty table gives no rows. Very long texts are measured whole, each in one task.
Hosts with equal counts get equal verdicts. Input columns named like a measure are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import give_back, join_facts, map_batches, prepared
from barloom.session import Workspace, ship_package

#: Characters that count as symbols (fixed values).
SYMBOLS = b"#*$%&|<>"
#: Characters between words (fixed values).
SPACES = b"\t\n\x0b\x0c\r "
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: A document fails when one of these holds.
LEAST_WORDS, MOST_REPEATED = 50, 50  # words, percent of words
RULES = {
    "few_words": lambda: F.col("n_words") < LEAST_WORDS,
    "repetition": lambda: 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"),
}
#: Signs of a bad host; one document may well show them.
SIGNS = {
    "symbols": lambda: 10 * F.col("n_symbols") > F.col("word_chars"),
    "repeated_lines": lambda: 20 * F.col("n_dup_lines") > F.col("n_words"),
    "odd_words": lambda: (F.col("word_chars") < 3 * F.col("n_words")) | (F.col("word_chars") > 12 * F.col("n_words")),
}
SURE = 2.0


def repeated_words(words: list, window: int = 3) -> int:
    """Words inside windows that occur at least twice in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    key = ids[:n]
    for i in range(1, window):
        if i > 1:
            key = np.unique(key, return_inverse=True)[1]  # so that the product below stays in range
        key = key * len(seen) + ids[i : i + n]
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[place] > 1
    hit = np.zeros(len(words), bool)
    for i in range(window):
        hit[i : i + n] |= twice
    return int(hit.sum())


def measure_text(text: str | None) -> tuple[int, int, int, int, int]:
    """The values of MEASURES of one text."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split on exactly SPACES
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - (len(raw) - len(raw.translate(None, SPACES))),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def passes(text: str | None) -> bool:
    """Whether a text fails no rule."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    return len(words) >= LEAST_WORDS and 100 * repeated_words(words) <= MOST_REPEATED * len(words)


def measure(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",), host: str = "source") -> DataFrame:
    """``keep``, ``host`` (the named column as text) and MEASURES of each document."""
    prepared(documents.sparkSession)
    rows = documents.select(*keep, F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), "text")
    kinds = dict(documents.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "host string", *[f"{m} long" for m in MEASURES]])

    def work(batches):
        for batch in batches:
            texts = batch.pop("text")
            values = list(zip(*map(measure_text, texts), strict=True)) or [()] * len(MEASURES)
            yield batch | dict(zip(MEASURES, values, strict=True))

    return map_batches(rows, schema, work)


def failed() -> Column:
    out = F.lit(False)
    for rule in RULES.values():
        out = out | rule()
    return out


def with_flags(measured: DataFrame) -> DataFrame:
    """``measured`` with a column for each rule and sign, true where it is broken."""
    return measured.withColumns({name: rule() for name, rule in (RULES | SIGNS).items()})


def host_rates(flagged: DataFrame, host_limit: float = 0.5) -> DataFrame:
    """Of each host: host_docs, host_rule (the rule with the highest bound), its shrunk host_rate and host_bound, and
    host_kept. ``flagged`` has host and a column for each rule and sign."""
    names = [*RULES, *SIGNS]
    hosts = flagged.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"), *[F.count_if(name).alias(name) for name in names])
    priors = beta_priors(hosts, names)

    def posterior(name: str) -> Column:
        alpha, beta = priors[name]
        weight = F.col("host_docs") + F.lit(alpha + beta)
        rate = (F.col(name) + F.lit(alpha)) / weight
        bound = rate - F.lit(SURE) * F.sqrt(rate * (1 - rate) / (weight + 1))
        return F.struct(bound.alias("host_bound"), rate.alias("host_rate"), F.lit(name).alias("host_rule"))

    worst = hosts.select("host", "host_docs", F.array_max(F.array(*map(posterior, names))).alias("worst"))
    return worst.select("host", "host_docs", "worst.*").withColumn("host_kept", F.col("host_bound") <= host_limit)


def beta_priors(hosts: DataFrame, names: list[str]) -> dict[str, tuple[float, float]]:
    """Parameters of each rule's beta prior by moments: the mean rate, and the spread between hosts beyond what chance gives.

    ``hosts`` has host_docs and the failures of each rule. Where hosts differ by no more than chance the prior is
    worth a million documents: they are all taken to be alike.
    """
    n = F.col("host_docs")
    sums = [x for f in names for x in (F.sum(f).alias(f"{f}_f"), F.sum(F.col(f) * F.col(f) / n).alias(f"{f}_q"))]
    s = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum(n).alias("n"), *sums).first()
    if not s["n"]:
        return dict.fromkeys(names, (0.5, 0.5))
    priors = {}
    for name in names:
        failures = s[f"{name}_f"]
        mean = (failures + 0.5) / (s["n"] + 1)
        by_chance = mean * (1 - mean) * s["hosts"] / s["n"]
        between = s[f"{name}_q"] / s["n"] - (failures / s["n"]) ** 2 - by_chance
        strength = min(max(mean * (1 - mean) / between - 1, 1.0), 1e6) if between > 0 else 1e6
        priors[name] = mean * strength, (1 - mean) * strength
    return priors


def judge(documents: DataFrame, workspace: Workspace, keep: tuple[str, ...] = ("doc_id",), host: str = "source", host_limit: float = 0.5) -> DataFrame:
    """``keep``, host, MEASURES, base_failed, the host's columns and kept, one row for each document."""
    measured = measure(documents, keep, host).withColumn("base_failed", failed())
    rows = workspace.stage(measured, "measured")
    found = join_facts(rows, host_rates(with_flags(rows), host_limit), ["host"], F.struct(*keep, *MEASURES))
    return found.withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))


def kept_documents(documents: DataFrame, workspace: Workspace, host: str = "source", host_limit: float = 0.5) -> DataFrame:
    """The documents, all columns, without those that fail a rule or come from a rejected host.

    The first pass only writes measures; the second judges each text again as it reads it, which costs less
    than moving the texts to a join with their measures.
    """
    rows = workspace.stage(with_flags(measure(documents, (), host)).select("host", *RULES, *SIGNS), "failures")
    rejected = host_rates(rows, host_limit).where(~F.col("host_kept")).select("host")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([passes(t) for t in texts], pa.bool_()))
        give_back()

    ship_package(documents.sparkSession)
    passing = documents.mapInArrow(work, documents.schema)
    return passing.join(rejected, F.coalesce(F.col(host).cast("string"), F.lit("")) == rejected["host"], "left_anti")

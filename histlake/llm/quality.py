"""Quality rules with risk-controlled thresholds.

Signals of a text are compared with cutoffs. Fixed base rules reject by themselves. For
every further signal and every stratum (texts of similar length) a cutoff is selected on
labelled rows: the strictest one whose share of rejected good texts is, by the exact
binomial (Clopper-Pearson) upper bound, at most `risk`. The cutoffs of a signal are
tested from the loosest on and the first failure ends the sequence, so one error budget
covers a whole sequence; `delta` is divided by the number of signals and strata
(Bonferroni), and `risk` by the number of signals, so that all rules of a stratum together reject at most
`risk` of its good texts with probability at least 1 - `delta`.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import MEMO_WORDS, map_slices, texts, work_table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
RISK, DELTA = 0.02, 0.05
# Signals as shares; a text is rejected when one exceeds its cutoff.
SIGNALS = {
    "symbols_per_word": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "word_length": "word_chars / n_words",
}
GRIDS = {
    "symbols_per_word": [k / 20 for k in range(80, 0, -1)],
    "dup_line_share": [k / 40 for k in range(39, 1, -1)],
    "repeat_share": [k / 40 for k in range(20, 1, -1)],
    "word_length": [k / 2 for k in range(80, 12, -1)],
}
STRATA = [200, 1000]  # word counts at which the next stratum begins
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"


class Numbers(dict):
    """Numbers words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def repeated_words(words: list[bytes], numbers: Numbers) -> int:
    """Words in windows of three that the text has twice or more."""
    if len(words) < 4:
        return 0
    if len(numbers) > MEMO_WORDS:
        numbers.clear()
    n = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    if len(numbers) >= 1 << 21:  # three numbers must fit in 63 bits
        n = np.unique(n, return_inverse=True)[1]
        if n.max() >= 1 << 21:
            pairs = np.unique(n[:-1] << 31 | n[1:], return_inverse=True)[1]
            windows = pairs[:-1] << 31 | n[2:]
        else:
            windows = n[:-2] << 42 | n[1:-1] << 21 | n[2:]
    else:
        windows = n[:-2] << 42 | n[1:-1] << 21 | n[2:]
    order = np.argsort(windows, kind="stable")
    same = np.diff(windows[order]) == 0
    if not same.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[:-1]] |= same
    twice[order[1:]] |= same
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(windows)] |= twice
    return int(covered.sum())


def signals_of(text: str, numbers: Numbers) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word)."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len(text) - sum(data.count(c) for c in SPACES)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip(SPACES)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words, numbers), len(lines)


def signals(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Signals of every row: (id, text_hash, counts, shares, stratum, base_failed).

    A null text has no words. Shares without words are 0. Repeated rows each count.
    """

    def step():
        numbers = Numbers()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = zip(*(signals_of(t, numbers) for t in texts(batch.column(2)))) if batch.num_rows else [()] * 6
            return pa.record_batch([batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in columns)], names)

        return work

    names = ["id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = map_slices(rows, step, f"id {kind}, " + ", ".join(f"{n} long" for n in names[1:]))
    stratum = sum(((F.col("n_words") >= low).cast("int") for low in STRATA), F.lit(0))
    return out.withColumns(
        {name: F.coalesce(F.try_divide(*map(F.col, share.split(" / "))), F.lit(0.0)) for name, share in SIGNALS.items()}
        | {"stratum": stratum, "base_failed": F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")}
    )


def upper_bound_holds(k: int, n: int, risk: float, delta: float) -> bool:
    """Whether the exact binomial upper bound at level 1 - delta of k of n is at most `risk`.

    That is the case exactly when at most k successes of n have probability <= delta
    if the true share is `risk`.
    """
    if n == 0 or k >= n:
        return False
    log = math.log
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log(risk) + (n - i) * log(1 - risk) for i in range(k + 1)]
    top = max(logs)
    return top + log(sum(math.exp(x - top) for x in logs)) <= log(delta)


def cutoffs(measured: DataFrame, labels: DataFrame, *, id_col: str, label_col: str, risk: float = RISK, delta: float = DELTA) -> dict:
    """Cutoff by (signal, stratum), where any is safe, from all labelled rows.

    `labels` has 1 for good texts; rows without a label and base failures don't count.
    An id with several labels is good if one of them says so. The bound holds for
    independent trials, so a text counts once, however many rows have it. The counts are
    taken per signal, stratum and grid step; only that table, of fixed size, reaches the
    driver.
    """
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("good_id")).distinct()
    held = measured.where(~F.col("base_failed")).join(good, F.col("id") == F.col("good_id"))
    # One row per text; its signals follow from the text.
    held = held.select("text_hash", "stratum", *SIGNALS).dropDuplicates(["text_hash"])
    # Step of a value: how many grid cutoffs, from the loosest on, it doesn't exceed.
    steps = [
        F.struct(F.lit(name).alias("signal"), sum(((F.col(name) <= c).cast("int") for c in GRIDS[name]), F.lit(0)).alias("step"))
        for name in SIGNALS
    ]
    rows = held.select("stratum", F.explode(F.array(*steps)).alias("s")).groupBy("stratum", "s.signal", "s.step").count().collect()
    strata = len(STRATA) + 1
    found = {}
    for name in SIGNALS:
        for stratum in range(strata):
            counts = np.zeros(len(GRIDS[name]) + 1, np.int64)
            for r in rows:
                if (r.signal, r.stratum) == (name, stratum):
                    counts[r.step] = r["count"]
            total = int(counts.sum())
            for step, cutoff in enumerate(GRIDS[name]):
                # Rejected by cutoff number `step`: values that hold at most `step` cutoffs.
                rejected = int(counts[: step + 1].sum())
                if not upper_bound_holds(rejected, total, risk / len(SIGNALS), delta / (len(SIGNALS) * strata)):
                    break
                found[name, stratum] = cutoff
    return found


def kept(found: dict) -> Column:
    """Whether a measured row passes the base rules and the cutoffs."""
    verdict = ~F.col("base_failed")
    for (name, stratum), cutoff in sorted(found.items()):
        verdict = verdict & ~((F.col("stratum") == stratum) & (F.col(name) > cutoff))
    return verdict


def judge(
    df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    risk: float = RISK, delta: float = DELTA,
) -> DataFrame:
    """Signals of every row of `df` and `kept`. Ids without text or label are judged alike."""
    measured = work_table(signals(df, id_col=id_col, text_col=text_col))
    found = cutoffs(measured, labels, id_col=id_col, label_col=label_col, risk=risk, delta=delta)
    return measured.withColumn("kept", kept(found)).withColumnRenamed("id", id_col)


def keep_rows(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of `df` that are kept, unchanged.

    Texts are measured a second time instead of being joined with their verdicts, so no
    text is shuffled.
    """
    measured = work_table(signals(df, id_col=id_col, text_col=text_col))
    found = cutoffs(measured, labels, id_col=id_col, label_col=label_col)
    place = df.columns.index(text_col)

    def passes(n_words: int, word_chars: int, n_symbols: int, n_dup_lines: int, n_repeat_words: int, n_lines: int) -> bool:
        if n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words:
            return False
        shares = (n_symbols / n_words, n_dup_lines / n_lines, n_repeat_words / n_words, word_chars / n_words)
        stratum = sum(n_words >= low for low in STRATA)
        return all(share <= found.get((name, stratum), math.inf) for name, share in zip(SIGNALS, shares))

    def step():
        numbers = Numbers()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([passes(*signals_of(t, numbers)) for t in texts(batch.column(place))], pa.bool_()))

        return work

    return map_slices(df, step, df.schema)

"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

A rule is a named test of one text. Each is timed on a bounded sample, alone, and its share of
rejected texts counted; the cascade then runs the rules by rejections per second, highest first,
and stops at the first that rejects. Verdicts are a conjunction, so the order changes no verdict:
only the work, and which rule is named for a text that several would reject.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterkit.llm.common import id_and_text, map_rows

SYMBOLS = "#*$%&|<>"
_NO_SYMBOLS = str.maketrans("", "", SYMBOLS)
_SPACES = " \t\n\x0b\x0c\r"
_NO_SPACES = str.maketrans("", "", _SPACES)


class Text:
    """A text and what rules measure of it, each measured once when first asked for.

    Words are runs of anything but the six ASCII white space characters.
    """

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()  # bytes are split at ASCII white space only

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text.translate(_NO_SPACES)) if not self.text.isascii() else sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(_SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside a five-word window that the text holds twice or more."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:], w[3:], w[4:]))
        seen, again = set(), set()
        for window in windows:
            (again if window in seen else seen).add(window)
        if not again:
            return 0
        covered = end = 0
        for i, window in enumerate(windows):
            if window in again:
                covered += i + 5 - max(i, end)
                end = i + 5
        return covered

    @cached_property
    def letters(self) -> str:
        return "".join(filter(str.isalpha, self.text))

    @cached_property
    def base_failed(self) -> bool:
        return too_few_words(self) or repeats_itself(self)


def too_few_words(t: Text) -> bool:
    return t.n_words < 10


def repeats_itself(t: Text) -> bool:
    return 100 * t.n_repeat_words > 20 * t.n_words


def symbols_per_word(t: Text) -> bool:
    """More than one symbol for ten words: tables, mark-up, junk between words."""
    return 10 * t.n_symbols > t.n_words


def repeated_lines(t: Text) -> bool:
    """Over half of the lines repeat an earlier one."""
    return 2 * t.n_dup_lines > len(t.lines)


def shouting(t: Text) -> bool:
    """Over 60 % capitals among the letters, of which there are 20 at least."""
    return len(t.letters) >= 20 and 10 * sum(map(str.isupper, t.letters)) > 6 * len(t.letters)


def exclaiming(t: Text) -> bool:
    """More exclamation marks than words."""
    return t.text.count("!") > t.n_words


def few_letters(t: Text) -> bool:
    """Under 40 % letters among what is not white space."""
    return 10 * len(t.letters) < 4 * t.word_chars


def odd_word_length(t: Text) -> bool:
    """Words of under 2 or over 20 characters in the mean."""
    return not 2 * t.n_words <= t.word_chars <= 20 * t.n_words


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


RULES: tuple[Rule, ...] = tuple(Rule(f.__name__, f) for f in (
    too_few_words, repeats_itself, symbols_per_word, repeated_lines, shouting, exclaiming,
    few_letters, odd_word_length))


def order_rules(texts: Sequence[str], rules: Sequence[Rule] = RULES) -> list[Rule]:
    """Rules by rejections per second of work on the texts; those that reject none come last,
    cheapest first. Each rule measures every text anew, as if it stood alone."""
    scored = []
    for place, rule in enumerate(rules):
        began = time.perf_counter()
        rejected = sum(rule.rejects(Text(text)) for text in texts)
        cost = (time.perf_counter() - began) / max(1, len(texts)) + 1e-9
        scored.append((-rejected / max(1, len(texts)) / cost, cost, place, rule))
    return [rule for *_, rule in sorted(scored, key=lambda s: s[:3])]


def sampled_order(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 500,
                  sample_chars: int = 50_000, text_col: str = "text") -> list[Rule]:
    """The order by a sample: of the texts of at most ``sample_chars`` characters, in all partitions,
    those with the ``sample_rows`` least hashes, copies once, so the sample is the same however the rows
    are dealt. Tasks merge hashes alone; the driver holds the sample's texts, bounded by the two. It
    decides the order only. An empty table, or one of longer texts alone, leaves the rules as given."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    short = docs.select(text).filter(F.length("text") <= sample_chars).select(F.xxhash64("text").alias("h"), "text")
    last = short.select("h").orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    if last is None:
        return list(rules)
    taken = short.filter(F.col("h") <= last).groupBy("h").agg(F.min("text").alias("text")).orderBy("h").collect()
    return order_rules([r.text for r in taken], rules)


def first_rejection(t: Text, rules: Sequence[Rule]) -> str | None:
    return next((rule.name for rule in rules if rule.rejects(t)), None)


def quality_report(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 500,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, rejected_by (the rule that stopped the cascade, or null). All
    counts are returned, so all are taken here; ``keep_good`` is the cascade that stops early.

    Null and empty texts have no words and fail the base. Null ids stay null, repeated rows are
    each judged, other columns are not read, an empty table gives no rows.
    """
    ordered = sampled_order(docs, rules, sample_rows, text_col=text_col)

    def make():
        def work(batch: pa.RecordBatch) -> list:
            rows = []
            for text in batch.column("text").to_pylist():
                t = Text(text)
                by = first_rejection(t, ordered)
                rows.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words,
                             t.base_failed, by is None and not t.base_failed, by))
            return [batch.column("doc_id"), *map(list, zip(*rows))] if rows else [[]] * 9

        return work

    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return map_rows(
        id_and_text(docs, id_col, text_col), make,
        "doc_id long, " + ", ".join(f"{c} long" for c in counts)
        + ", base_failed boolean, kept boolean, rejected_by string",
        pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in counts],
                   ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("rejected_by", pa.string())]))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 500,
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text no rule rejects.

    Only the cascade runs here: a rejected text is measured no further. Null texts are empty and
    are rejected for want of words by the base rules. Repeated rows stay or go alike, other columns may
    have any names, an empty table gives an empty one.
    """
    ordered = sampled_order(docs, rules, sample_rows, text_col=text_col)

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield batch.filter(pa.array(
                [first_rejection(Text(t or ""), ordered) is None for t in texts], pa.bool_()))

    map_rows_conf(docs)
    return docs.mapInArrow(run, docs.schema)


def map_rows_conf(docs: DataFrame) -> None:
    from clusterkit.llm.common import BATCH_ROWS

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

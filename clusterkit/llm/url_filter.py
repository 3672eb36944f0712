"""URL verdicts: rules first, gradient-boosted trees on lexical features for the rest.

All in DataFrame expressions and Spark's own GBTClassifier. The trees are fitted on the URLs that a
rule labels, on a sample of bounded size; statistics of host suffixes are counted over all of
them. The features see no rule: lengths, depth, digits, entropy, parameters and how the URLs of
a suffix are labelled, smoothed towards the mean of all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (host, path, verdict): a rule fits its host and all below it, for paths that start with its own.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
FEATURES = ["length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio",
            "host_digit_ratio", "hyphens", "entropy", "parameters", "query_length", "https",
            "suffix_rate", "suffix_share", "domain_rate", "domain_share", "section_rate", "section_share"]
#: Rows of the bounded sample that a task of the many short jobs of a fit is to have at least.
TASK_ROWS = 10_000
#: Columns whose label statistics are counted over all labelled URLs.
STATISTICS = ("suffix", "domain", "section")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path, both empty where the URL is null or has no ``://``. The host ends at the
    first ``/``, ``?`` or ``#`` and has its A-Z lower-cased; the path ends at ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # a later, longer one goes first
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _ratio(n: Column, of: Column) -> Column:
    return n / F.greatest(of, F.lit(1))


def _entropy(text: str) -> Column:
    """Bits a character of a string column, 0 for the empty string."""
    return F.expr(f"""
        aggregate(array_distinct(split({text}, '')), 0D, (acc, c) -> acc + if(c = '', 0D,
            (length({text}) - length(replace({text}, c, ''))) / length({text})
            * log2(length({text}) / (length({text}) - length(replace({text}, c, ''))))))""")


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, host, path, rule, ruled) with the lexical features and the suffix
    (last label of the host), domain (last two) and section (first label of the path) whose
    statistics are to be joined."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return (
        pages.withColumn("_url", url).withColumns({
            "length": F.length(url).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "host_depth": _count(F.col("host"), r"\.").cast("double"),
            "path_depth": _count(F.col("path"), "/").cast("double"),
            "digit_ratio": _ratio(_count(url, "[0-9]"), F.length(url)),
            "host_digit_ratio": _ratio(_count(F.col("host"), "[0-9]"), F.length("host")),
            "hyphens": _count(F.col("host"), "-").cast("double"),
            "entropy": _entropy("_url"),
            "parameters": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1.0),
            "query_length": F.length(query).cast("double"),
            "https": F.startswith(url, F.lit("https:")).cast("double"),
            "suffix": F.substring_index("host", ".", -1),
            "domain": F.substring_index("host", ".", -2),
            "section": F.regexp_extract("path", "^/([^/]*)", 1),
        }).drop("_url")
    )


@dataclass
class UrlModel:
    """What judges a URL without a rule; ``trees`` is None where the labels leave no choice."""

    trees: object
    statistics: dict[str, DataFrame]
    prior: float

    def _joined(self, rows: DataFrame) -> DataFrame:
        # A hot suffix is on the side of the rows, which an adaptive join can split.
        for by, rates in self.statistics.items():
            rows = rows.join(rates, by, "left").fillna({f"{by}_rate": self.prior, f"{by}_share": 0.0})
        return rows

    def verdicts(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a column ``judged``, allow or block."""
        rows = self._joined(rows)
        if self.trees is None:
            return rows.withColumn("judged", F.lit("block" if self.prior > 0.5 else "allow"))
        rows = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows)
        return self.trees.transform(rows).withColumn(
            "judged", F.when(F.col("_block") > 0.5, "block").otherwise("allow"))


def _rates(labelled: DataFrame, by: str, prior: float, total: int, smooth: float = 20.0) -> DataFrame:
    return labelled.groupBy(by).agg(F.sum("label").alias("b"), F.count("*").alias("n")).select(
        by, ((F.col("b") + smooth * prior) / (F.col("n") + smooth)).alias(f"{by}_rate"),
        (F.col("n") / max(1, total)).alias(f"{by}_share"))


def fit_url_model(labelled: DataFrame, fit_rows: int = 50_000, trees: int = 20, depth: int = 4) -> UrlModel:
    """From features and ``label`` (1.0: block). ``fit_rows`` bounds the sample the trees are fitted
    on: different URLs are taken by their hash, about so many, each with the weight of its rows, so a
    URL that much of the table repeats is one row of the sample; the statistics count all rows. Labels
    of one kind, or none, give no trees, and that kind (or allow) for all."""
    n, blocked = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    prior = blocked / n if n else 0.0
    model = UrlModel(None, {by: _rates(labelled, by, prior, n) for by in STATISTICS}, prior)
    if 0 < blocked < n:
        share = min(1.0, fit_rows / n)
        sample = labelled.filter(F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < max(1, int(share * (1 << 20))))
        weights = sample.groupBy("url").agg(F.count("*").cast("double").alias("_weight"))
        sample = sample.dropDuplicates(["url"]).join(weights, "url")
        rows = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(model._joined(sample))
        model.trees = GBTClassifier(
            featuresCol="_features", labelCol="label", weightCol="_weight", predictionCol="_block",
            maxIter=trees, maxDepth=depth, seed=7,
        ).fit(rows.select("_features", "label", "_weight").repartition(-(-min(n, fit_rows) // TASK_ROWS)))
    return model


def prepared(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"))
    host, path = split_url(F.col("url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    rule, ruled = matched_rule(F.col("host"), F.col("path"), rules)
    return lexical(rows.withColumn("rule", rule).withColumn("ruled", ruled))


def judge_urls(pages: DataFrame, rules=RULES, fit_rows: int = 50_000, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """Columns page_id, host, path, rule, verdict: one row for each row of ``pages``.

    Null URLs and URLs without ``://`` have an empty host and path, fit no rule and are judged
    by their features. Null ids stay null, repeated rows are each judged, other columns are not
    read, an empty table gives no rows.
    """
    rows = prepared(pages, rules, id_col, url_col)
    labelled = rows.filter("ruled is not null").withColumn("label", (F.col("ruled") == "block").cast("double"))
    model = fit_url_model(labelled, fit_rows)
    judged = model.verdicts(rows)
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", "judged").alias("verdict"))


def held_out_accuracy(pages: DataFrame, rules=RULES, fit_rows: int = 50_000) -> tuple[float, float]:
    """Share of right verdicts on the fifth of ruled URLs not fitted on, and that of the more
    frequent verdict among them."""
    rows = prepared(pages, rules).filter("ruled is not null").withColumn(
        "label", (F.col("ruled") == "block").cast("double")).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(5)))
    model = fit_url_model(rows.filter("fold <> 0"), fit_rows)
    right, blocked = model.verdicts(rows.filter("fold = 0")).agg(
        F.avg((F.col("judged") == F.col("ruled")).cast("double")), F.avg("label")).first()
    return right, max(blocked, 1 - blocked)

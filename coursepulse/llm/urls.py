"""URL filter: rules for hosts and paths, and logistic regression for the rest.

The regression reads hashed character n-grams of host and path. It is trained from a small table of
labelled URLs, made below from lists of words by a rule, in which hosts and paths vary by themselves.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
FEATURES = 1 << 16
SIZES = (3, 4, 5)
THRESHOLD = 0.5

#: Words of hosts and paths that are to be blocked, by what they are about, and of ordinary ones.
BLOCKED_TOPICS = {
    "gambling": ("bet", "bets", "betting", "bonus", "casino", "gambling", "jackpot", "lottery",
                 "poker", "roulette", "slots", "winner"),
    "adult": ("adult", "cams", "escort", "hookup", "nude", "porn", "sex", "xxx"),
    "pills": ("cialis", "meds", "pharma", "pills", "viagra"),
    "piracy": ("crack", "hack", "keygen", "malware", "phish", "torrent", "warez"),
    "selling": ("ads", "adserver", "cheap", "clickbait", "coupon", "dating", "deals", "free",
                "loans", "popup", "promo", "replica", "spam", "tracker"),
}
ORDINARY_TOPICS = {
    "nature": ("astronomy", "atlas", "biology", "climate", "earth", "forest", "garden", "mountain",
               "nature", "ocean", "river", "weather"),
    "study": ("archive", "chemistry", "essay", "history", "journal", "language", "library", "lingua",
              "math", "physics", "research", "school", "science", "words"),
    "arts": ("art", "book", "bridge", "letters", "museum", "music", "paper", "poetry", "story",
             "theatre"),
    "life": ("city", "code", "cooking", "data", "health", "kitchen", "news", "sport", "travel"),
    "papers": ("business", "culture", "economy", "opinion", "politics", "society", "world"),
    "site": ("about", "article", "contact", "index", "page", "post", "wiki"),
}
BLOCKED_WORDS = tuple(word for words in BLOCKED_TOPICS.values() for word in words)
ORDINARY_WORDS = tuple(word for words in ORDINARY_TOPICS.values() for word in words)
_SYLLABLES = ("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of",
              "or", "nt", "ea", "ti", "to", "it", "st", "io", "le", "is", "ou", "ar", "as", "de",
              "tion", "ing", "ble", "wh", "ly", "sh", "ment", "que", "ung", "sch", "ción", "ado")


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, below a path."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host and path of a URL column; both empty for null and without ``://``."""
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    value = F.coalesce(F.col(url), F.lit(""))
    host = F.translate(F.regexp_extract(value, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(value, pattern, 2)


def _pairs(words: tuple[str, ...], steps: tuple[int, ...]) -> list[str]:
    return [f"{word}-{words[(at + step) % len(words)]}"
            for at, word in enumerate(words) for step in steps]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``host, path, label``: words, alone and in pairs, and made-up names of syllables.

    A URL is to be blocked if its host or its path has blocked words, so these stand in hosts with
    ordinary paths, in paths of ordinary hosts, and in both. Each name comes with every front of a host;
    ends, sections, numbers and tails take turns alike in both classes, so only words tell them apart.
    """
    fronts, ends = ("", "www.", "blog.", "m."), ("com", "net", "org")
    sections, tails = ("en", "de", "fr", "es"), ("", "/", ".html")
    made_up = [first + _SYLLABLES[(at + step) % len(_SYLLABLES)] + third
               for at, first in enumerate(_SYLLABLES) for step in (0, 1, 3, 8, 13, 21)
               for third in ("", _SYLLABLES[(at * 7 + step) % len(_SYLLABLES)])]
    bad = [*BLOCKED_WORDS, *_pairs(BLOCKED_WORDS, (1, 5, 9, 14, 22))]
    fair = [*ORDINARY_WORDS, *_pairs(ORDINARY_WORDS, (7, 19)), *made_up]

    def host(names: list[str], at: int, turn: int) -> str:
        return f"{fronts[turn % 4]}{names[at % len(names)]}.example.{ends[(at + turn) % 3]}"

    def path(names: list[str], at: int, turn: int) -> str:
        """Four shapes of paths that hold a name."""
        name, section = names[at % len(names)], sections[(at // 3 + turn) % 4]
        other = fair[(at * 5 + turn * 11) % len(fair)]
        return (f"/{section}/{name}{tails[at % 3]}", f"/{name}/{other}-{at * 37 % 997}.html",
                f"/{section}/{other}/{other}-{name}-{turn}{tails[turn % 3]}",
                f"/{other}/{2000 + at % 25}/{at % 12 + 1:02}/{name}_{turn}{tails[at // 2 % 3]}",
                )[(at + turn) % 4]

    def plain(at: int, turn: int) -> str:
        return f"/{sections[(at // 3 + turn) % 4]}/{at * 37 % 997}{tails[at // 3 % 3]}"

    turns = range(len(fronts))
    rows = [(host(bad, at, turn), plain(at, turn) if turn % 2 else path(fair, at * 3 + turn, turn), 1.0)
            for at in range(len(bad)) for turn in turns]
    rows += [(host(fair, at * 7 + turn, turn), path(bad, at, turn), 1.0)
             for at in range(len(bad)) for turn in turns]
    rows += [(host(bad, at, turn), path(bad, at * 3 + 1, turn), 1.0)
             for turn, at in enumerate(range(0, len(bad), 3))]
    rows += [(host(fair, at, turn), plain(at, turn) if turn % 2 else path(fair, at * 3 + turn, turn), 0.0)
             for at in range(len(fair)) for turn in turns]
    rows += [(host(fair, at * 7 + turn, turn), path(fair, at, turn), 0.0)
             for at in range(len(fair)) for turn in turns[:2]]
    return spark.createDataFrame(rows, "host string, path string, label double")


def _ngrams(rows: DataFrame) -> DataFrame:
    """Adds ``grams``: character n-grams of host and path, each with its origin; digits are alike."""
    parts = []
    for name in ("host", "path"):
        letters = f"{name}_letters"
        text = F.regexp_replace(F.concat(F.lit("^"), name, F.lit("$")), "[0-9]", "0")
        rows = rows.withColumn(letters, F.split(text, ""))
        for size in SIZES:
            grams = f"{name}_{size}"
            rows = NGram(n=size, inputCol=letters, outputCol=grams).transform(rows)
            parts.append(F.transform(grams, lambda g, name=name: F.concat(F.lit(name), g)))
    return rows.withColumn("grams", F.concat(*parts))


def fit_urls(spark: SparkSession) -> PipelineModel:
    """The regression, fitted on the labelled table."""
    hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features")
    regression = LogisticRegression(regParam=0.002, maxIter=60)
    table = _ngrams(labelled_urls(spark)).coalesce(1).cache()  # several passes over a few rows
    try:
        return Pipeline(stages=[hashing, regression]).fit(table)
    finally:
        table.unpersist()


def _rule(rules: Iterable[Rule], value) -> Column:
    """``value`` of the longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: (len(rule.name), rule.name)):
        host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        found = F.when(host & F.col("path").startswith(rule.path), F.lit(value(rule))
                       ).otherwise(found)
    return found


def judge(pages: DataFrame, rules: Iterable[Rule], model: PipelineModel) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``, one row per row of ``page_id, url``.

    A rule fits its host and all subdomains where the path starts with the rule's path; the longest
    wins. Without a rule, the regression's score of 0.5 or more blocks. A null URL, or one without
    ``://``, has an empty host and path, and so the regression's verdict. Other columns are not read.
    """
    rules = list(rules)
    host, path = host_and_path("url")
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    scored = model.transform(_ngrams(rows)).select(
        "page_id", "host", "path", _rule(rules, lambda rule: rule.name).alias("rule"),
        _rule(rules, lambda rule: rule.verdict).alias("ruled"),
        vector_to_array("probability")[1].alias("score"))
    own = F.when(F.col("score") >= THRESHOLD, BLOCK).otherwise(ALLOW)
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", own).alias("verdict"), "score")

"""URL filters with rules indexed by their rarest literal token.

A rule is a host with a path prefix, or a pattern of literal text with ``*`` (any
characters) and ``^`` (a separator or an end). Each rule is filed under the one of
its literal tokens that the fewest URLs have; a URL's tokens fetch the rules filed
under them, and only those run their regular expressions.

Defined cases: a null URL, or one without ``://``, has an empty host and path and no
rule; repeated rows get the same verdict; of several host rules the longest decides
(of equal length, the alphabetically last), and host rules go before patterns; an
empty table gives an empty result; rows without a place meet no rule and take no part
in the join; columns made here replace input columns of the
same name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rinkframe.llm.store import free_name

# Rules up to this number are broadcast (about 20 MB); more are joined by shuffle.
MAX_BROADCAST = 100_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SEPARATOR = "(?:^|[^0-9A-Za-z]|$)"


@dataclass(frozen=True)
class Rule:
    verdict: str  # "allow" or "block"
    host: str | None = None
    path: str = ""
    pattern: str | None = None

    @property
    def name(self) -> str:
        return self.pattern if self.host is None else self.host + self.path

    @property
    def regex(self) -> str:
        if self.host is not None:
            return r"^(?:[^/]*\.)?" + re.escape(self.name)
        parts = {"^": _SEPARATOR, "*": "(?s:.*)"}
        return "".join(parts.get(c) or re.escape(c) for c in self.pattern)

    @property
    def tokens(self) -> list[str]:
        """Literal runs of letters and digits that stand whole in every URL that fits."""
        text = "^" + self.name if self.host is not None else self.name
        found = [m[0] for m in re.finditer("[0-9A-Za-z]+", text)
                 if m.start() > 0 and m.end() < len(text)
                 and text[m.start() - 1] != "*" and text[m.end()] != "*"]
        if not found:
            raise ValueError(f"rule {self.name!r} has no whole literal token to be filed under")
        return found


# Patterns that block on their own.
PATTERNS = (
    Rule("block", pattern="^spam-farm."),
    Rule("block", pattern="^cheap-pills."),
    Rule("block", pattern="^casino^"),
    Rule("block", pattern="^phishing^"),
    Rule("block", pattern="/wp-login.php^"),
)


def _parts(url: Column) -> tuple[Column, Column]:
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, shape, 1), F.lit(""))
    return F.translate(host, _UPPER, _UPPER.lower()), F.coalesce(F.regexp_extract(url, shape, 2), F.lit(""))


def _tokens(place: Column) -> Column:
    return F.array_distinct(F.filter(F.split(place, "[^0-9A-Za-z]+"), lambda t: t != ""))


def _rule_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [(r.name, r.verdict, r.regex, r.host is not None, len(r.name), r.tokens) for r in rules]
    return spark.createDataFrame(
        rows, "rule string, verdict string, regex string, is_host boolean, size int, tokens array<string>")


def index_rules(tokens: DataFrame, rules: DataFrame, small: bool) -> DataFrame:
    """File every rule under its rarest token; ``tokens`` has one row per place and token."""
    hint = F.broadcast if small else lambda df: df
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    seen = tokens.join(hint(wanted), "token").groupBy("token").agg(F.count("*").alias("n"))
    filed = (rules.withColumn("token", F.explode("tokens")).join(hint(seen), "token", "left")
             .groupBy("rule", "verdict", "regex", "is_host", "size")
             .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token")))
    return hint(filed)


def judge(df: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (of a host rule) and ``verdict`` to every row.

    Verdicts are found once per distinct host and path, so a URL that many rows share
    counts once, and are joined back.
    """
    rules = list(dict.fromkeys(rules))
    host, path = _parts(F.col(url))
    place, hit = free_name(df, "place"), free_name(df, "hit")
    rows = df.withColumns({"host": host, "path": path}).withColumn(place, F.concat("host", "path"))
    if not rules:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")}).drop(place)
    tokens = (rows.select(F.col(place).alias("at")).distinct()
              .select("at", F.explode(_tokens(F.col("at"))).alias("token")))
    index = index_rules(tokens, _rule_frame(df.sparkSession, rules), len(rules) <= MAX_BROADCAST)
    best = F.max(F.struct("is_host", "size", "rule", "verdict"))
    hits = (tokens.join(index, "token").filter(F.regexp_like("at", F.col("regex")))
            .groupBy(F.col("at").alias(place)).agg(best.alias(hit)))
    # No token, no rule: kept out of the join, where all of them would be one key.
    met = rows.filter(F.col(place) != "").join(hits, place, "left")
    bare = rows.filter(F.col(place) == "").withColumn(hit, F.lit(None).cast(hits.schema[hit].dataType))
    return (met.unionByName(bare)
            .withColumns({
                "rule": F.when(F.col(hit)["is_host"], F.col(hit)["rule"]),
                "verdict": F.coalesce(F.col(hit)["verdict"], F.lit("allow")),
            }).drop(place, hit))

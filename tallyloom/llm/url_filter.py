"""URL filters: pattern rules indexed by their rarest literal token."""

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.llm.common import broadcast_if_small, stage_table

# Verdict of a URL that no rule fits.
DEFAULT_VERDICT = "allow"
TOKEN_SPLIT = "[^A-Za-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """A rule on ``host + path``.

    ``anchored`` rules start at the host or at one of its parent domains and match a prefix
    of what follows; others match anywhere. ``*`` in an unanchored pattern stands for any run.
    """

    verdict: str
    pattern: str
    anchored: bool = True

    def regex(self) -> str:
        literal = r"[\s\S]*".join(re.escape(part) for part in self.pattern.split("*"))
        return rf"^(?:[^/]*\.)?{re.escape(self.pattern)}" if self.anchored else literal

    def tokens(self) -> list[str]:
        """Literal tokens that are whole tokens of every URL the rule fits."""
        text = self.pattern
        found = []
        for m in re.finditer("[A-Za-z0-9]+", text):
            starts = self.anchored if m.start() == 0 else text[m.start() - 1] != "*"
            ends = m.end() < len(text) and (self.anchored or text[m.end()] != "*")
            if starts and ends:
                found.append(m.group())
        return found


# Host rules of the list, then patterns for pages that are not prose.
SITE_RULES = (
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
)
PATTERN_RULES = (
    Rule("block", "/login/", anchored=False),
    Rule("block", "/cart/*/checkout/", anchored=False),
    Rule("block", "/ads/", anchored=False),
)


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z lower-cased."""
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.char_length(url))), F.lit(""))


def _tokens(target: Column) -> Column:
    """Distinct tokens of a URL; the empty one fetches the rules that have no literal token."""
    return F.array_distinct(F.concat(F.split(target, TOKEN_SPLIT), F.array(F.lit(""))))


def rule_table(spark: SparkSession, site_rules: Sequence[Rule], pattern_rules: Sequence[Rule]) -> DataFrame:
    """One row per rule, ranked: longest site rules first, then the patterns in their order."""
    rules = [*sorted(site_rules, key=lambda r: (-len(r.pattern), r.pattern)), *pattern_rules]
    rows = [
        (rank, r.pattern if rank < len(site_rules) else None, r.verdict, r.regex(), r.tokens() or [""]) for rank, r in enumerate(rules)
    ]
    kinds = "rank int, rule string, verdict string, regex string, tokens array<string>"
    return stage_table(spark.createDataFrame(rows, kinds), "url-rules")


def rule_index(targets: DataFrame, rules: DataFrame) -> DataFrame:
    """``(token, rank, regex)``: each rule under the one of its tokens that fewest targets hold.

    Counts cover all targets; only tokens that occur in rules are counted, so the table is
    bounded by the rule list.
    """
    ranked = rules.select("rank", "regex", F.explode("tokens").alias("token"))
    wanted = stage_table(ranked.select("token").distinct(), "rule-tokens")
    counts = (
        targets.select(F.explode(_tokens(F.col("target"))).alias("token"))
        .join(broadcast_if_small(wanted, F.octet_length("token") + 24), "token", "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    rarest = F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), F.col("token")))
    return ranked.join(counts, "token", "left").groupBy("rank", "regex").agg(rarest.alias("token"))


def judge_urls(
    pages: DataFrame,
    url_column: str = "url",
    site_rules: Sequence[Rule] = SITE_RULES,
    pattern_rules: Sequence[Rule] = PATTERN_RULES,
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict``; returns them beside ``row``, a struct of the input.

    The tokens of a URL fetch candidate rules from the index and only those run their regular
    expressions. The longest site rule wins, then the patterns in their order. Matching is
    done once per distinct host and path, which are pre-aggregated on the map side; rows that
    share one URL therefore cost one candidate each, however many there are. Rules are rows
    of a table, so lists of many thousands make the same plan as short ones. Very long URLs
    are matched whole.

    A null URL, or one without ``://``, has an empty host and path, fits no rule and gets the
    default verdict with a null rule. Empty tables give empty results; repeated rows are
    judged alike; extra columns pass through inside ``row``.
    """
    url = F.col(f"`{url_column}`")
    judged = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"),
        url_host(url).alias("host"),
        url_path(url).alias("path"),
    ).withColumn("target", F.concat("host", "path"))
    if not [*site_rules, *pattern_rules]:
        none = F.lit(None).cast("string")
        return judged.select("row", "host", "path", none.alias("rule"), F.lit(DEFAULT_VERDICT).alias("verdict"))
    rules = rule_table(pages.sparkSession, site_rules, pattern_rules)
    targets = judged.select("target").distinct()
    index = stage_table(rule_index(targets, rules), "rule-index")
    width = F.octet_length("token") + F.octet_length("regex") + 24
    candidates = targets.select("target", F.explode(_tokens(F.col("target"))).alias("token")).join(
        broadcast_if_small(index, width), "token"
    )
    # The expression of the row before is kept, so in order of rules each is compiled once per task.
    fitting = candidates.sortWithinPartitions("rank").filter(F.regexp_instr("target", F.col("regex")) > 0)
    best = fitting.groupBy("target").agg(F.min("rank").alias("rank"))
    named = rules.select("rank", "rule", "verdict")
    best = best.join(broadcast_if_small(named, F.coalesce(F.octet_length("rule"), F.lit(0)) + 40), "rank").drop("rank")
    return judged.join(best, "target", "left").select(
        "row", "host", "path", "rule", F.coalesce("verdict", F.lit(DEFAULT_VERDICT)).alias("verdict")
    )

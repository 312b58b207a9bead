"""URL filter: host rules, then a list of canonical URLs behind a blocked Bloom filter.

The list is kept as a table. Its blocked Bloom filter (see ``bloom``), of bounded size, is broadcast; URLs
that may be listed go on to a hash join with the list, which removes false positives. All of it is
DataFrame work.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule, is never
listed and is allowed. A list entry is a canonical URL; nulls and repeated entries do no harm.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.bloom import blocked_bloom, may_be_in
from strata.llm.common import lowered, staged


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path, such as ``example.net/en/``."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


RULES = (
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
)

# Host labels whose pages the query lists.
LISTED_LABELS = ("spam-farm", "adult-x", "casino-win", "cheap-pills", "free-bets", "ads-track")


def url_host(url: Column) -> Column:
    return F.coalesce(lowered(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host, path and query without scheme, ``www.`` or ``m.``, default port, fragment, tracking
    parameters, a last slash or ``.html``. Null for a null url or one without ``://``."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r"^(www|m)\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(url_path(url), r"\.html$", ""), r"/+$", "")
    query = F.regexp_extract(url, r"^(?s:.*?)://[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, r"(^|&)(utm_[a-z]+|ref)=[^&]*", "")
    query = F.regexp_replace(query, r"^&+", "")
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(F.contains(url, F.lit("://")), whole)


def listed_urls(pages: DataFrame, labels: Sequence[str] = LISTED_LABELS) -> DataFrame:
    """The list the query filters by: canonical URLs of pages on hosts with a listed label."""
    wanted = r"(^|\.)(" + "|".join(labels) + r")\."
    on_host = F.regexp_like(url_host(F.col("url")), F.lit(wanted))
    return pages.filter(on_host).select(canonical_url(F.col("url")).alias("canonical")).distinct()


def rule_of(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The longest rule that fits, as its text; of equally long ones that with the longer host, then the
    smaller text. Null if none fits."""
    longest = sorted(rules, key=lambda rule: (-len(rule.text), -len(rule.host), rule.text))
    found = F.lit(None).cast("string")
    for rule in reversed(longest):
        on_host = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        found = F.when(on_host & F.startswith(path, F.lit(rule.path)), F.lit(rule.text)).otherwise(found)
    return found


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, listed."""
    url = F.col("url")
    judged = pages.select(
        "page_id", url_host(url).alias("host"), url_path(url).alias("path"),
        canonical_url(url).alias("canonical"),
    ).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    judged = staged(judged.withColumn("row_no", F.monotonically_increasing_id()), "judged")
    listed = staged(listed.filter("canonical IS NOT NULL").distinct(), "listed")
    open_pages = judged.filter("rule IS NULL AND canonical IS NOT NULL").select("row_no", "canonical")
    suspects = may_be_in(open_pages, "canonical", blocked_bloom(listed, "canonical"))
    hits = suspects.join(listed.hint("shuffle_hash"), "canonical", "left_semi")
    hits = hits.select("row_no", F.lit(True).alias("listed"))
    verdicts = {rule.text: rule.verdict for rule in rules}
    by_rule = F.lit(None).cast("string")
    for text, verdict in verdicts.items():
        by_rule = F.when(F.col("rule") == text, F.lit(verdict)).otherwise(by_rule)
    is_listed = F.coalesce(F.col("listed"), F.lit(False))
    return judged.join(hits, "row_no", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce(by_rule, F.when(is_listed, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        is_listed.alias("listed"),
    )

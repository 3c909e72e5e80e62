"""URL filters: pattern rules indexed by their rarest literal token.

A rule is found through one token that every URL it fits must contain. The tokens of a rule's
pattern are counted over all URLs, and the rarest one indexes it; a URL's tokens fetch the rules
that may fit, and only those run their regular expressions. Each distinct URL is judged once, so
copies of a URL cost a comparison, and only URLs travel, never the pages.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelscope.llm.text import own_name
from parcelscope.settings import staged

TOKEN = "[a-z0-9]+"


class Rule(NamedTuple):
    """``text`` is a host and path (``example.net/en/``: the host, its subdomains, and paths that
    start so) if ``general`` is false. A general rule is a pattern for the URL without scheme:
    ``*`` stands for anything, ``^`` for a separator or an end."""

    action: str
    text: str
    general: bool = False


# The rules of the filter.
RULES = (
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
)
# Words of the method's own rules: what advertising hosts and folders are called, what spam shops
# sell, and endings under which such names are bought by the dozen.
ADVERTISING = (
    "ads adserver adservice adsystem ad-track ads-track banner-exchange beacon clickserver doubleclick link-exchange "
    "popunder popup-ads retargeting sponsored-links track-clicks tracker tracking-pixel"
).split()
SPAM = (
    "betting cash-loans casino cheap-meds cheap-pills fake-watches free-followers hot-singles jackpot lottery-winner "
    "miracle-diet payday-loans poker replica-bags slots viagra weight-loss-pills work-from-home"
).split()
CHEAP_ENDINGS = "click loan top win xyz".split()
# Folders that write about such things rather than being them.
ABOUT = "glossary law news opt-out policy research".split()


def general_rules() -> tuple[Rule, ...]:
    """The method's own rules, for URLs that no host rule fits.

    A word of advertising or spam blocks where it is a whole label or folder, or the beginning or end
    of a hyphenated one (``casino-win``); a spam word also within a label under a cheap ending. The
    exceptions are longer, and the longest rule wins: a folder about the matter right after the word,
    and lists to opt out from advertising.
    """
    rules = []
    for word in [*ADVERTISING, *SPAM]:
        rules += [Rule("block", f"^{word}^", True), Rule("block", f"^{word}-", True), Rule("block", f"-{word}^", True)]
        rules += [Rule("allow", f"^{word}^{about}^", True) for about in ABOUT]
    for word, ending in product(SPAM, CHEAP_ENDINGS):
        rules.append(Rule("block", f"{word}*.{ending}/", True))
    return tuple(rules)


GENERAL = general_rules()
DEFAULT = "allow"
SEPARATOR = "[^A-Za-z0-9_%.-]"


def regex_of(rule: Rule) -> str:
    """The regular expression a URL's ``host + path`` must contain a match of."""
    if not rule.general:
        host, _, path = rule.text.partition("/")
        return rf"^(?:[^/]*\.)?{_quoted(host.lower())}{_quoted('/' + path)}"
    parts = re.split(r"([*^])", rule.text)
    # a separator: one that cannot be part of a name, a dot between labels, or either end
    return "(?s)" + "".join(".*" if p == "*" else rf"(?:^|$|[./]|{SEPARATOR})" if p == "^" else _quoted(p) for p in parts)


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() else "\\" + c for c in text)


def tokens_of(rule: Rule) -> list[str]:
    """Tokens that a URL must contain whole: those whose both ends the pattern fixes."""
    if not rule.general:
        host, _, path = rule.text.partition("/")
        fixed = re.findall(TOKEN, host.lower())
        inner = re.findall(rf"{TOKEN}(?=[^a-z0-9])", path.lower())  # the last may go on in the URL
        return fixed + inner
    # a general rule's ends are open: what stands there may go on in the URL
    return [m.group() for m in re.finditer(rf"(?<=[^a-z0-9*]){TOKEN}(?=[^a-z0-9*])", rule.text.lower())]


def address(url: Column) -> tuple[Column, Column]:
    """(host, path): what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, its A-Z in
    lower case; then up to ``?``, ``#`` or the end. Both empty for a null or other url."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def indexed(rules: Sequence[Rule], addresses: DataFrame) -> DataFrame:
    """(token, number, regex, action, text, general): each rule under its rarest token in the
    distinct ``address`` strings. A rule without a token of its own is under ``""``, which every
    URL fetches."""
    spark = addresses.sparkSession
    numbered = [(i, regex_of(r), r.action, r.text, r.general, tokens_of(r) or [""]) for i, r in enumerate(rules)]
    frame = spark.createDataFrame(
        numbered, "number int, regex string, action string, text string, general boolean, tokens array<string>"
    )
    known = sorted({t for r in numbered for t in r[5]})
    counts = (
        addresses.select(F.explode(F.array_distinct(F.filter(_tokens(), lambda t: t.isin(known)))).alias("token"))
        .groupBy("token").count()
    )
    choices = frame.withColumn("token", F.explode("tokens")).join(counts, "token", "left")
    rarest = F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), -F.length("token"), "token"))
    return choices.groupBy("number", "regex", "action", "text", "general").agg(rarest.alias("token"))


def _tokens() -> Column:
    return F.concat(F.array(F.lit("")), F.regexp_extract_all(F.lower("address"), F.lit(TOKEN), F.lit(0)))


def judged(pages: DataFrame, url: str = "url", rules: Sequence[Rule] = RULES, general: Sequence[Rule] = GENERAL) -> DataFrame:
    """``pages`` with host, path, rule and verdict of each url.

    The longest host rule that fits decides (ties to the one given first); failing that a general
    rule, failing that ``DEFAULT``. ``rule`` is the host rule or null. A null url, or one without
    ``://``, has empty host and path. Repeated rows are each judged; result columns replace input
    columns of the same name.
    """
    mark = own_name(pages, "_address")
    host, path = address(F.col(f"`{url}`"))
    found = pages.drop("host", "path", "rule", "verdict").withColumn("host", host).withColumn("path", path)
    found = found.withColumn(mark, F.concat("host", "path"))
    addresses = staged(found.select(F.col(mark).alias("address")).distinct(), "url-addresses")
    index = staged(indexed([*rules, *general], addresses), "url-index")
    fetched = addresses.select("address", F.explode(F.array_distinct(_tokens())).alias("token")).join(index, "token")
    fits = fetched.where(F.expr("address RLIKE regex"))
    rank = F.struct(F.col("general"), -F.length("text"), F.col("number"))
    best = fits.groupBy("address").agg(
        F.min_by(F.struct(F.when(~F.col("general"), F.col("text")).alias("rule"), F.col("action").alias("verdict")), rank).alias("best")
    )
    hits = staged(best.select(F.col("address").alias(f"{mark}_hit"), "best.rule", "best.verdict"), "url-verdicts")
    joined = found.join(hits, F.col(mark) == F.col(f"{mark}_hit"), "left")
    return joined.withColumn("verdict", F.coalesce("verdict", F.lit(DEFAULT))).drop(mark, f"{mark}_hit")

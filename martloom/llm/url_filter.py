"""URL filter: a weighted vocabulary counted with Aho-Corasick, under host and path rules."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Terms that reject alone, and terms of which several different ones reject.
STRICT = ("casino", "escort", "hentai", "porn", "porno", "xxx", "warez", "viagra", "adult-x")
SOFT = (
    "ads", "adult", "bet", "bets", "bonus", "cheap", "click", "deal", "download", "farm", "free", "game", "loan",
    "pill", "pills", "poker", "sale", "seo", "sex", "slots", "spam", "torrent", "track", "win",
)
SOFT_HITS = 2


class Rule(NamedTuple):
    """`path` as a prefix on `host` and its subdomains."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case and path; both empty for null or without ://."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, tail = rest[:end], rest[end:]
    end = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return host.translate(LOWER), tail[:end]


def rules_by_host(rules: Iterable[Rule]) -> dict[str, list[Rule]]:
    """Rules of each host, longest path first; of equal ones a block comes first."""
    out: dict[str, list[Rule]] = {}
    for rule in sorted(rules, key=lambda r: (-len(r.path), r.verdict != "block")):
        out.setdefault(rule.host, []).append(rule)
    return out


def fitting_rule(host: str, path: str, rules: dict[str, list[Rule]]) -> Rule | None:
    """The longest rule for this host or a domain above it."""
    best = None
    while host:
        rule = next((r for r in rules.get(host, ()) if path.startswith(r.path)), None)
        if rule and (best is None or len(rule.text) > len(best.text)):
            best = rule
        host = host.partition(".")[2]
    return best


def build(strict: Iterable[str], soft: Iterable[str]) -> ahocorasick.Automaton:
    words = ahocorasick.Automaton()
    for term in soft:
        words.add_word(term, (term, False))
    for term in strict:  # a term of both lists is strict
        words.add_word(term, (term, True))
    if len(words):
        words.make_automaton()
    return words


def count_terms(url: str, words: ahocorasick.Automaton) -> tuple[int, int]:
    """Strict hits and different soft terms that stand between non-alphanumerics."""
    if not len(words):
        return 0, 0
    hits, soft = 0, set()
    for end, (term, is_strict) in words.iter(url):
        start = end - len(term)
        if (start >= 0 and url[start] in WORD) or (end + 1 < len(url) and url[end + 1] in WORD):
            continue
        if is_strict:
            hits += 1
        else:
            soft.add(term)
    return hits, len(soft)


def judge_urls(
    pages: DataFrame, rules: Iterable[Rule] = RULES, strict: Iterable[str] = STRICT, soft: Iterable[str] = SOFT,
    soft_hits: int = SOFT_HITS,
) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict, strict_hits, soft_hits.

    The longest fitting rule decides; without one, a URL is blocked for one strict term
    or `soft_hits` different soft terms.  Null URLs, and URLs without ://, have an
    empty host and path and fit no rule; their terms still count.  Rules and terms are
    small parameters and travel with the code.
    """
    rules, strict, soft = tuple(rules), tuple(strict), tuple(soft)

    @F.pandas_udf("host string, path string, rule string, verdict string, strict_hits long, soft_hits long")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words, by_host = build(strict, soft), rules_by_host(rules)
        for urls in batches:
            out = []
            for url in urls:
                host, path = split_url(url)
                rule = fitting_rule(host, path, by_host)
                hard, mild = count_terms((url or "").translate(LOWER), words)
                verdict = rule.verdict if rule else "block" if hard or mild >= soft_hits else "allow"
                out.append((host, path, rule.text if rule else None, verdict, hard, mild))
            yield pd.DataFrame(out, columns=["host", "path", "rule", "verdict", "strict_hits", "soft_hits"])

    return pages.select("page_id", judge(F.col("url")).alias("judged")).select("page_id", "judged.*")


def oracle(
    rules: Iterable[Rule] = RULES, strict: Iterable[str] = STRICT, soft: Iterable[str] = SOFT,
    soft_hits: int = SOFT_HITS,
) -> str:
    """The same judgement as DuckDB SQL over the table pages."""
    rules = sorted(rules, key=lambda r: -len(r.text))

    def fits(r: Rule) -> str:
        return f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))"

    def has(term: str) -> str:
        return f"regexp_matches(low, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"

    name = " ".join(f"WHEN {fits(r)} THEN '{r.text}'" for r in rules)
    said = " ".join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in rules)
    hard = " + ".join(f"{has(t)}::INT" for t in strict) or "0"
    mild = " + ".join(f"{has(t)}::INT" for t in soft if t not in set(strict)) or "0"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH cut AS (
  SELECT page_id, translate(coalesce(url, ''), '{upper}', '{lower}') AS low,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, low, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{upper}', '{lower}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
counted AS (SELECT *, {hard} AS hard, {mild} AS mild FROM parts)
SELECT page_id, host, path, CASE {name} END AS rule,
       CASE {said} WHEN hard > 0 OR mild >= {soft_hits} THEN 'block' ELSE 'allow' END AS verdict FROM counted"""

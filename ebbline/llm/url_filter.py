"""URL filter: host rules first, else a weighted vocabulary counted by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Term:
    """A term of unwanted URLs: a strict one rejects alone, soft ones by the sum of their weights."""

    text: str
    strict: bool = False
    weight: float = 1.0


# The default vocabulary; a caller may give another one, as Terms or as a table of (term, strict, weight).
STRICT_TERMS = (
    "adult-x", "blackjack", "camgirl", "camgirls", "camsex", "casino", "casinos", "cialis", "clickbait", "cracked-apps", "escort", "escorts", "fakeid", "fake-id", "freeporn", "hentai", "hookup", "hookups", "keygen", "keygens", "levitra",
    "malware", "milf", "nudes", "onlinecasino", "payday-loan", "payday-loans", "phish", "phishing", "pills", "porn", "porno", "porntube", "pornhub", "replica-watches", "roulette", "serialz", "sex-cam", "sexcam", "sexchat", "slots-online",
    "spam", "spamfarm", "sportsbook", "stresser", "tramadol", "viagra", "warez", "webcamsex", "xanax", "xxx", "xxxvideo",
)
#: Weight of each group of soft terms: a heavy one rejects beside any other, middle and light ones only where enough of them add up.
SOFT_TERMS = {
    1.6: (
        "adult", "bet", "bets", "betting", "bingo", "crack", "dating", "earn-money", "erotic", "forex", "gambling", "get-rich", "jackpot", "loan", "loans", "lottery", "lotto", "nude", "poker", "serial", "sexy", "slots", "torrent", "torrents",
    ),
    0.8: ("affiliate", "buy-now", "discount", "doubleclick", "download-now", "giveaway", "limited-offer", "miracle", "popup", "prize", "prizes", "replica", "subscribe-now", "weight-loss", "win", "winner"),
    0.4: (
        "ad", "ads", "bargain", "bonus", "bulk", "cheap", "click", "clicks", "coupon", "coupons", "crypto", "deal", "deals", "diet", "farm", "free", "hot", "instant", "offer", "offers", "promo", "promotion", "redirect", "refid", "referral",
        "reward", "rewards", "sale", "seo", "sponsored", "track", "tracker", "tracking", "traffic", "unsubscribe",
    ),
}
TERMS = tuple([Term(t, True) for t in STRICT_TERMS] + [Term(t, False, w) for w, terms in SOFT_TERMS.items() for t in terms])
#: Soft terms reject at this sum of weights and at least two of them; a vocabulary given as a table has at most MOST_TERMS rows, as every task holds it.
SOFT_WEIGHT, MOST_TERMS = 2.0, 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))


def vocabulary(terms=TERMS):
    """One automaton over all terms; a text listed twice is strict if any of its entries is, else has the larger weight."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for term in sorted(terms, key=lambda t: (t.strict, t.weight)):
        out.add_word(term.text, term)
    out.make_automaton()
    return out


def terms_of(table: DataFrame) -> tuple[Term, ...]:
    """The vocabulary that a table of (term, strict, weight) holds, lower-cased; its size is checked, as each task gets it whole."""
    term = F.translate("term", UPPER, LOWER).alias("term")
    one = table.where("term <> ''").groupBy(term).agg(F.coalesce(F.max("strict"), F.lit(False)).alias("strict"), F.coalesce(F.max("weight"), F.lit(1.0)).alias("weight"))
    rows = one.limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"a vocabulary of more than {MOST_TERMS} terms")
    return tuple(Term(r.term, r.strict, float(r.weight)) for r in sorted(rows))


def count_terms(url: str, automaton) -> tuple[int, int, float]:
    """Distinct strict terms, distinct soft terms and the soft ones' weight, of those that stand in ``url`` between characters that are not letters or digits."""
    found = set()
    if len(automaton):
        for end, term in automaton.iter(url):
            start = end - len(term.text) + 1
            if (start == 0 or not _word(url[start - 1])) and (end + 1 == len(url) or not _word(url[end + 1])):
                found.add(term)
    soft = [t.weight for t in found if not t.strict]
    return len(found) - len(soft), len(soft), round(sum(soft), 6)


def _word(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def filter_urls(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules=RULES, terms=TERMS, soft_weight: float = SOFT_WEIGHT) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, strict_hits, soft_hits, soft_weight.

    The longest fitting rule (host plus path; the first listed among equals)
    gives the verdict; without one, a URL is blocked on one strict term, or on
    two or more distinct soft terms whose weights sum to ``soft_weight``, else
    allowed.  Terms are lower case and counted once each, in the whole URL with
    A-Z lower-cased.  ``terms`` are Terms or a table of (term, strict, weight):
    its null or empty terms are left out, of a term's rows the strict one or the
    heaviest counts, and more than MOST_TERMS terms are an error.  A null URL, or an empty one, has empty host and path, no
    hits and is allowed; null ids stay null; repeated rows give repeated
    results; an empty table gives none; further columns are not looked at.
    """
    terms = terms_of(terms) if isinstance(terms, DataFrame) else tuple(terms)

    @F.pandas_udf("strict int, soft int, weight double")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton, low = vocabulary(terms), str.maketrans(UPPER, LOWER)
        for urls in batches:
            yield pd.DataFrame([count_terms(u.translate(low), automaton) for u in urls], columns=["strict", "soft", "weight"]).astype({"strict": "int32", "soft": "int32", "weight": "float64"})

    host, path = split_url(F.col("_url"))
    out = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("_url"))
    out = out.select("page_id", host.alias("host"), path.alias("path"), hits("_url").alias("_hits"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name), reverse=True)[::-1]:
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, F.lit(r.name)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    method = F.when((F.col("_hits.strict") >= 1) | ((F.col("_hits.soft") >= 2) & (F.col("_hits.weight") >= soft_weight)), "block").otherwise("allow")
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), F.col("_hits.strict").alias("strict_hits"), F.col("_hits.soft").alias("soft_hits"), F.col("_hits.weight").alias("soft_weight"))


def oracle(terms=TERMS, rules=RULES, soft_weight: float = SOFT_WEIGHT) -> str:
    """The same in DuckDB's SQL, with regular expressions for the counting."""

    def total(chosen):
        return " + ".join(f"(CASE WHEN strpos(u, '{t.text}') > 0 AND regexp_matches(u, '(^|[^a-z0-9]){t.text}([^a-z0-9]|$)') THEN {w} ELSE 0 END)" for t, w in chosen) or "0"

    low = f"translate({{}}, '{UPPER}', '{LOWER}')"
    cases = sorted(rules, key=lambda r: len(r.name), reverse=True)
    fits = [f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))" for r in cases]
    rule = " ".join(f"WHEN {f} THEN '{r.name}'" for f, r in zip(fits, cases))
    verdict = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, cases))
    return f"""
WITH a AS (SELECT page_id, coalesce(url, '') AS u0, {low.format("coalesce(url, '')")} AS u FROM pages),
b AS (SELECT page_id, u, CASE WHEN strpos(u0, '://') > 0 THEN substr(u0, strpos(u0, '://') + 3) ELSE '' END AS rest FROM a),
c AS (SELECT page_id, u, {low.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM b),
d AS (SELECT page_id, host, path, CAST({total([(t, 1) for t in terms if t.strict])} AS INTEGER) AS strict_hits, CAST({total([(t, 1) for t in terms if not t.strict])} AS INTEGER) AS soft_hits,
  CAST({total([(t, t.weight) for t in terms if not t.strict])} AS DOUBLE) AS soft_weight FROM c)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {verdict} WHEN strict_hits >= 1 OR (soft_hits >= 2 AND soft_weight >= {soft_weight}) THEN 'block' ELSE 'allow' END AS verdict, strict_hits, soft_hits, soft_weight
FROM d"""

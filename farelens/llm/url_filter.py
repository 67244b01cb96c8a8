"""URL filter: host/path rules, then a weighted vocabulary of URL terms.

The vocabulary is searched with one Aho-Corasick pass per URL.  A term counts
only between boundaries (no ASCII letter or digit next to it) and once per
URL.  A term is a word or a group ``(?:a|b)`` of its forms.  A strict term
weighs the whole limit, a soft term a part of it; a URL is blocked when its
distinct terms reach the limit, that is on one strict term or on several soft
ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _terms(words: str) -> tuple[str, ...]:
    """One term a line; the forms of a word, joined by ``|``, are one term and count once."""
    return tuple(f"(?:{w})" if "|" in w else w for w in words.split())


# Plain words of each category, no host names.  A single letter says nothing
# by itself, so "x" stands only beside the words it marks.
_X = ("adult", "adults", "cam", "cams", "clip", "clips", "movie", "movies", "rated", "sex", "tube", "video", "videos")

STRICT_BY_CATEGORY = {
    "adult": _terms("""porn|porno|pornos|pornstar|pornstars xxx|xxxx camgirl|camgirls|sexcam|sexcams hentai milf|milfs
                       blowjob|blowjobs""") + (f"(?:{'|'.join([f'x-{w}' for w in _X] + [f'{w}-x' for w in _X])})",),
    "gambling": _terms("sportsbook|sportsbooks"),
    "ads": _terms("adserver|adservers|ad-server|ad-servers doubleclick popunder|popunders"),
    "spam": _terms("link-farm|link-farms|linkfarm|linkfarms"),
    "pharmacy": _terms("viagra cialis levitra no-prescription|without-prescription"),
    "malware": _terms("malware|malwares phishing|phisher|phishers warez keygen|keygens"),
}
SOFT_BY_CATEGORY = {
    "adult": _terms("""adult|adults dating|datings escort|escorts|escorting sex|sexy erotic|erotica nude|nudes|nudity
                       fetish|fetishes webcam|webcams hookup|hookups nsfw"""),
    "gambling": _terms("""bet|bets|betting|bettor|bettors casino|casinos jackpot|jackpots poker
                          win|wins|winner|winners|winning gamble|gambler|gamblers|gambling roulette
                          lottery|lotteries|lotto blackjack slots wager|wagers|wagering bingo"""),
    "ads": _terms("""ad|ads|advert|adverts|advertise|advertising|advertisement|advertisements
                     track|tracks|tracker|trackers|tracking banner|banners popup|popups|pop-up|pop-ups
                     sponsored|sponsor|sponsors affiliate|affiliates click|clicks|clicker promo|promos telemetry"""),
    "spam": _terms("""cheap|cheaper|cheapest deal|deals farm|farms|farming free|freebie|freebies loan|loans
                      spam|spams|spammer|spammers|spamming|spammy payday discount|discounts|discounted
                      coupon|coupons giveaway|giveaways replica|replicas backlink|backlinks bulk"""),
    "pharmacy": _terms("""pill|pills pharmacy|pharmacies|pharma meds rx tramadol xanax phentermine
                          steroid|steroids painkiller|painkillers"""),
    "malware": _terms("""crack|cracks|cracked|cracking|cracker torrent|torrents trojan|trojans spyware|adware
                         keylogger|keyloggers botnet|botnets nulled hack|hacks|hacked serial|serials"""),
}
STRICT_TERMS = tuple(t for terms in STRICT_BY_CATEGORY.values() for t in terms)
SOFT_TERMS = tuple(t for terms in SOFT_BY_CATEGORY.values() for t in terms)
SOFT_LIMIT = 2

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    host = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def match_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else NULLs.

    A rule fits its host and every subdomain where the path starts with its
    path; longest means most characters, then the smaller string.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rhost, rpath in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host == rhost) | host.endswith("." + rhost)) & path.startswith(rpath)
        rule = F.when(fits, F.lit(rhost + rpath)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def term_counter(strict=STRICT_TERMS, soft=SOFT_TERMS):
    """Pandas UDF: URL -> struct(strict, soft), the distinct terms of each kind."""

    @F.pandas_udf("strict int, soft int")
    def count_terms(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        machine = ahocorasick.Automaton()
        kind = {t: 1 for t in soft} | {t: 0 for t in strict}
        for term in kind:
            for form in term.removeprefix("(?:").removesuffix(")").split("|"):
                machine.add_word(form, (form, term))
        machine.make_automaton()
        edge = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
        for urls in batches:
            out = []
            for url in urls:
                found = set()
                if url:
                    url = url.lower()
                    for end, (form, term) in machine.iter(url):
                        start = end - len(form)
                        if (start < 0 or url[start] not in edge) and (end + 1 == len(url) or url[end + 1] not in edge):
                            found.add(term)
                n_soft = sum(kind[t] for t in found)
                out.append((len(found) - n_soft, n_soft))
            yield pd.DataFrame(out, columns=["strict", "soft"])

    return count_terms


def judge_urls(pages: DataFrame, url_col: str = "url", rules=RULES, strict=STRICT_TERMS,
               soft=SOFT_TERMS, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """``pages`` without the URL's other columns being read, plus the verdict.

    Adds host, path, rule, strict_hits, soft_hits and verdict (allow/block);
    columns of these names in ``pages`` give way to them, all others stay.
    A NULL or relative URL has empty host and path, fits no rule and is
    judged by its terms alone (NULL: none, allow).  Repeated rows are judged
    alike, long URLs are read whole, an empty table gives no rows.  One
    narrow stage: no shuffle, so hot hosts do not matter.
    """
    own = ("host", "path", "rule", "strict_hits", "soft_hits", "verdict")
    # The judgement is one column of a name the table does not have.
    name = "__judged"
    while name in pages.columns:
        name += "_"
    url = pages[f"`{url_col}`"]
    parts = pages.withColumn(name, F.struct(host_of(url).alias("host"), path_of(url).alias("path"),
                                            term_counter(strict, soft)(url).alias("terms")))
    at = parts[name]
    rule, ruled = match_rule(at["host"], at["path"], rules)
    score = (at["terms"]["strict"] * soft_limit + at["terms"]["soft"]) >= soft_limit
    verdict = F.coalesce(ruled, F.when(score, "block").otherwise("allow"))
    values = (at["host"], at["path"], rule, at["terms"]["strict"], at["terms"]["soft"], verdict)
    return parts.select(*[parts[f"`{c}`"] for c in pages.columns if c not in own],
                        *[v.alias(c) for c, v in zip(own, values)])

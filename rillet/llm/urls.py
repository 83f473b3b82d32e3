"""URL filter: host and path rules, then a weighted vocabulary found by Aho-Corasick (operator 5).

The automaton holds strict and soft terms and reads the whole URL once: scheme, host, path, query and
fragment, A-Z lower-cased after ASCII letters, digits and ``- . _ ~`` written as ``%XX`` are decoded.  A
hit counts only between boundaries (no letter or digit before or after it).  A URL without a fitting rule
is blocked by one strict hit, or by soft hits of ``distinct`` terms or more that weigh ``limit`` or more
together.  ``load_vocabulary`` takes terms and weights from a table.

Rules look like ``host/path``: a rule fits its host and all subdomains if the URL's path starts with
the rule's; the longest fitting rule decides.

Defined cases: a null URL or one without ``://`` has an empty host and path and fits no rule (the
vocabulary still reads it; a null URL has no terms and is allowed); letters outside A-Z are compared as they are; repeated rows are judged each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

# The default vocabulary: strict terms, and soft terms with weights, in several languages.
STRICT = ("porn", "porno", "pornos", "xxx", "hentai", "escort", "escorte", "putas", "sexkontakte", "adult-x", "casino-win",
          "cheap-pills", "spam-farm", "free-bets", "malware", "warez", "phishing")
SOFT = {"casino": 3, "poker": 2, "bets": 2, "betting": 2, "apuestas": 2, "wetten": 2, "paris-sportifs": 3, "gluecksspiel": 3,
        "pills": 2, "pharmacy": 1, "viagra": 3, "adult": 2, "sex": 3, "sexe": 3, "erotik": 3, "dating": 1, "loan": 1,
        "kredit": 1, "prestamos": 1, "crack": 2, "keygen": 3, "torrent": 2, "cheap": 1, "free": 1, "gratis": 1, "gratuit": 1,
        "win": 1, "ads": 1, "track": 1, "tracker": 1, "spam": 2, "farm": 1}
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


@dataclass(frozen=True)
class UrlOptions:
    rules: tuple = RULES
    strict: tuple = STRICT
    soft: tuple = tuple(SOFT.items())     # term, weight
    limit: int = 3                        # weight of distinct soft terms that blocks
    distinct: int = 2                     # and how many they must be


_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


_ESCAPED = re.compile("%([0-9A-Fa-f]{2})")
_PLAIN = {f"{ord(c):02x}": c for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-._~"}


def load_vocabulary(terms: DataFrame, **options) -> UrlOptions:
    """Options with the vocabulary of ``terms`` (term string, weight int; 0 or null: strict).

    A vocabulary is a list for the automaton of every task, so it goes through the driver.
    """
    rows = [(r[0].translate(_LOWER), r[1] or 0) for r in terms.select("term", "weight").collect() if r[0]]
    return UrlOptions(strict=tuple(sorted({t for t, w in rows if not w})),
                      soft=tuple(sorted((t, w) for t, w in dict(rows).items() if w)), **options)


def readable(url: str | None) -> str:
    """The text that the vocabulary reads: plain characters decoded (once), A-Z lower-cased."""
    url = url or ""
    if "%" in url:
        url = _ESCAPED.sub(lambda m: _PLAIN.get(m[1].lower(), m[0]), url)
    return url.translate(_LOWER)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return rest[:end].translate(_LOWER), tail[:stop]


class UrlJudge:
    def __init__(self, options: UrlOptions):
        import ahocorasick
        self._rules: dict[str, list[tuple[str, str, str]]] = {}
        for rule, verdict in options.rules:
            host, path = rule.split("/", 1)
            self._rules.setdefault(host, []).append(("/" + path, rule, verdict))
        self._limit, self._distinct = options.limit, options.distinct
        self._words = ahocorasick.Automaton()
        for term, weight in options.soft:
            self._words.add_word(term, (term, weight))
        for term in options.strict:
            self._words.add_word(term, (term, 0))             # 0: strict
        if len(self._words):
            self._words.make_automaton()

    def rule(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest fitting rule and its verdict; the host's suffixes are looked up one by one."""
        best = None
        at = 0
        while at >= 0:
            for start, rule, verdict in self._rules.get(host[at:], ()):
                if path.startswith(start) and (best is None or len(rule) > len(best[0])):
                    best = rule, verdict
            at = host.find(".", at) + 1 or -1
        return best

    def hits(self, url: str | None) -> tuple[list[str], int, int]:
        """Distinct terms hit between boundaries, how many are strict, and the weight of the soft ones."""
        text = readable(url)
        found = {}
        if len(self._words):
            for end, (term, weight) in self._words.iter(text):
                start = end - len(term) + 1
                if not (start and text[start - 1].isalnum()) and not text[end + 1:end + 2].isalnum():
                    found[term] = weight
        return sorted(found), sum(1 for w in found.values() if not w), sum(found.values())

    def judge(self, url: str | None) -> tuple:
        host, path = split_url(url)
        rule, verdict = self.rule(host, path) or (None, None)
        terms, strict, soft = self.hits(url)
        if verdict is None:
            enough = soft >= self._limit and len(terms) - strict >= self._distinct
            verdict = "block" if strict or enough else "allow"
        return host, path, rule, verdict, strict, soft, ",".join(terms)


def judge_urls(pages: DataFrame, options: UrlOptions = UrlOptions()) -> DataFrame:
    """``page_id, host, path, rule, verdict, n_strict, soft_weight, terms`` for every row of ``pages``."""
    def run(batches):
        judge = UrlJudge(options).judge
        for batch in batches:
            rows = [judge(u) for u in batch.column("url").to_pylist()]
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.string()] * 4 + [pa.int64()] * 2 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                names=["page_id", "host", "path", "rule", "verdict", "n_strict", "soft_weight", "terms"])
    return pages.select("page_id", "url").mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string, n_strict long, "
             "soft_weight long, terms string")


def oracle(options: UrlOptions = UrlOptions()) -> str:
    """DuckDB SQL for ``judge_urls`` over ``pages`` (terms and rules spelled out)."""
    terms = [(t, 0) for t in options.strict] + list(options.soft)
    values = ", ".join(f"('{t}', {w})" for t, w in terms)
    rules = ", ".join(f"('{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}')" for r, v in options.rules)
    plain = ", ".join(f"('%{code}', '{c}')" for code, c in _PLAIN.items())
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH terms(term, weight) AS (VALUES {values}), rules(rule, rhost, rpath, rverdict) AS (VALUES {rules}),
cut AS (
  SELECT page_id, url, row_number() OVER () AS r, CASE WHEN contains(coalesce(url, ''), '://')
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, r, url, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), ruled AS (
  SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(rverdict, length(rule)) AS rverdict
  FROM parts, rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY r
), tokens AS (
  SELECT r, unnest(regexp_extract_all(coalesce(url, ''), '%[0-9A-Fa-f]{{2}}|[^%]+|%')) AS token,
         generate_subscripts(regexp_extract_all(coalesce(url, ''), '%[0-9A-Fa-f]{{2}}|[^%]+|%'), 1) AS i FROM parts
), plain(code, c) AS (VALUES {plain}), readable AS (
  SELECT t.r, translate(string_agg(coalesce(p.c, t.token), '' ORDER BY t.i), '{upper}', '{lower}') AS body
  FROM tokens t LEFT JOIN plain p ON p.code = lower(t.token) GROUP BY t.r
), hit AS (
  SELECT r, term, weight FROM readable, terms
  WHERE contains(body, term) AND regexp_matches(body,
                       '(^|[^\p{{L}}\p{{N}}])' || term || '($|[^\p{{L}}\p{{N}}])')
), hits AS (
  SELECT r, count(*) FILTER (WHERE weight = 0) AS n_strict, count(*) FILTER (WHERE weight > 0) AS n_soft,
         sum(weight) AS soft_weight,
         string_agg(term, ',' ORDER BY term) AS terms FROM hit GROUP BY r
)
SELECT p.page_id, p.host, p.path, u.rule, coalesce(u.rverdict,
         CASE WHEN h.n_strict > 0 OR h.soft_weight >= {options.limit} AND h.n_soft >= {options.distinct} THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(h.n_strict, 0)::BIGINT AS n_strict, coalesce(h.soft_weight, 0)::BIGINT AS soft_weight,
       coalesce(h.terms, '') AS terms
FROM parts p LEFT JOIN ruled u ON u.r = p.r LEFT JOIN hits h ON h.r = p.r
"""

"""URL filters: host and path rules, and a logistic regression on hashed character n-grams of host and path.

The model is fitted on the driver from a small labelled URL table (at most ``MAX_LABELLED`` rows, a documented bound);
its weights are whole millionths, so that scores add up to the same number in any order and on any engine. Judging is
one projection of native expressions: no shuffle, no Python on the executors.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits no rule and gets the model's verdict
for empty strings; repeated rows are judged alike; other columns are left as they are.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import private, table

#: Size of the hashed feature space; a power of two.
DIMENSIONS = 4096
#: Rows that the labelled table may have: training runs on the driver.
MAX_LABELLED = 10_000
#: Rules are compared one after another in the projection, so their number is bounded.
MAX_RULES = 500

# Topics of the labelled table, as words that hosts and paths of such sites hold.
_UNWANTED = (
    "casino poker betting gambling roulette slots jackpot lottery bingo sportsbook viagra cialis pharmacy pills steroids porn xxx sexcam escort "
    "adult nude webcam hookup hentai milf payday loan quickcash cheap replica discount coupon torrent warez crack keygen serial cheats spam "
    "free-money get-rich forex-signals miracle slim-fast detox clickbait popads malware phish"
).split()
_WANTED = (
    "docs wiki news library research blog university museum recipes forum science history garden travel health school weather sports music books "
    "parliament court archive journal encyclopedia tutorial manual developer support faq about contact article post review city council "
    "hospital theatre cinema festival energy climate railway airport bank insurance law tax census map software hardware"
).split()
_LANGUAGES = ("en", "de", "fr", "es")
_ENDS = ("com", "net", "org", "info", "co")


def labelled_urls(unwanted: list[str] = _UNWANTED, wanted: list[str] = _WANTED) -> list[tuple[str, int]]:
    """The small labelled table, (url, 1 for unwanted): each topic as a host, inside a host, as a path and beside a number, and
    plain hosts with language folders."""
    rows = []
    for label, topics in ((1, unwanted), (0, wanted)):
        for i, topic in enumerate(topics):
            end = _ENDS[i % len(_ENDS)]
            rows += [
                (f"https://{topic}.example.{end}/", label), (f"https://www.{topic}-online.example.{end}/{topic}/{i}", label), (f"http://site{i}.example.{end}/{topic}?page={i}", label),
                (f"https://best{topic}{i}.example.{end}/{_LANGUAGES[i % 4]}/", label), (f"https://example.{end}/a/{topic}-{i * 7 % 100}.html", label), (f"https://go-{topic}zone.example.{end}/x", label),
            ]
    for i in range(40):
        for language in _LANGUAGES:
            rows.append((f"https://host{i}.example.{_ENDS[i % 3]}/{language}/{37 * i + 5}", 0))
    return rows


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty where it is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1)


def _parts(url: str | None) -> tuple[str, str]:
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def _features(host: str, path: str) -> list[int]:
    """Hashed 3-grams of ``^host$`` and ``^path$``; the same arithmetic as :func:`_score_of`."""
    out = []
    for field, text in enumerate((host, path)):
        codes = [ord(c) for c in f"^{text}$"]
        out += [(a * 961 + b * 31 + c + field * 7919) % DIMENSIONS for a, b, c in zip(codes, codes[1:], codes[2:])]
    return out


def train(rows: list[tuple[str, int]], epochs: int = 30, rate: float = 2.0, l2: float = 1e-4) -> tuple[list[int], int]:
    """Weights and bias of the logistic regression, in millionths. Deterministic: rows are taken in one shuffled order of a fixed seed.

    The gradient of a url is divided by its number of features, so that long urls don't dominate.
    """
    if len(rows) > MAX_LABELLED:
        raise ValueError(f"the labelled table has {len(rows)} rows; at most {MAX_LABELLED} are trained on the driver")
    weights, bias = [0.0] * DIMENSIONS, 0.0
    data = [(_features(*_parts(url)), label) for url, label in rows]
    random.Random(11).shuffle(data)
    for _ in range(epochs):
        for features, label in data:
            score = bias + sum(weights[i] for i in features)
            error = label - 1 / (1 + math.exp(-max(-30.0, min(30.0, score))))
            bias += 0.1 * rate * error
            for i in features:
                weights[i] += rate * (error / len(features) - l2 * weights[i])
    return [round(w * 1e6) for w in weights], round(bias * 1e6)


def _score_of(host: Column, path: Column, model: tuple[list[int], int]) -> Column:
    weights = F.from_json(F.lit(json.dumps(model[0])), "array<bigint>")
    total = F.lit(model[1]).cast("long")
    for field, text in enumerate((host, path)):
        codes = F.transform(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""), lambda c: F.ascii(c).cast("long"))
        grams = F.zip_with(codes, F.slice(codes, 2, 1 << 30), lambda a, b: a * 961 + b * 31)
        grams = F.zip_with(grams, F.slice(codes, 3, 1 << 30), lambda ab, c: (ab + c + field * 7919) % DIMENSIONS)
        total = total + F.aggregate(grams, F.lit(0).cast("long"), lambda s, i: s + F.when(i.isNull(), 0).otherwise(F.get(weights, i.cast("int"))))
    return total


def filter_urls(df: DataFrame, rules: list[tuple[str, str, str]], model: tuple[list[int], int] | None = None, url: str = "url", threshold: int = 0) -> DataFrame:
    """Add host, path, rule, logit_micro and verdict (allow or block) to each row.

    ``rules``: (verdict, host, path). A rule fits its host and all subdomains where the path starts with the rule's;
    the longest rule wins, and the model judges urls without one (block if its score is over ``threshold``).
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are applied in one projection")
    model = model or train(labelled_urls())
    (ruled,) = private(df, "ruled")
    host, path = host_and_path(F.col(url))
    df = df.withColumns({"host": host, "path": path})
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1:]))
    fits = [(F.col("host") == h) | F.col("host").endswith("." + h) for _, h, _ in ordered]
    hits = [fit & F.col("path").startswith(p) for fit, (_, _, p) in zip(fits, ordered)]
    rule = F.coalesce(*[F.when(hit, F.lit(h + p)) for hit, (_, h, p) in zip(hits, ordered)], F.lit(None).cast("string"))
    said = F.coalesce(*[F.when(hit, F.lit(v)) for hit, (v, _, _) in zip(hits, ordered)], F.lit(None).cast("string"))
    df = df.withColumns({"rule": rule, "logit_micro": _score_of(F.col("host"), F.col("path"), model), ruled: said})
    return df.withColumn("verdict", F.coalesce(ruled, F.when(F.col("logit_micro") > threshold, "block").otherwise("allow"))).drop(ruled)


#: The rules of the registered query.
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def op10_url_filters(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict", "logit_micro")


def oracle() -> str:
    weights, bias = train(labelled_urls())
    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1:]))

    def case(value: str) -> str:
        out = "CASE "
        for v, h, p in ordered:
            out += f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p if value == 'rule' else v}' "
        return out + "END"

    def grams(field: int, text: str) -> str:
        s = f"('^' || {text} || '$')"
        return f"list_sum(list_transform(range(1, length({s}) - 1), lambda i: w[((unicode({s}[i]) * 961 + unicode({s}[i + 1]) * 31 + unicode({s}[i + 2]) + {field * 7919}) % {DIMENSIONS}) + 1]))"

    return f"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
s AS (SELECT u.*, ({bias} + coalesce({grams(0, 'host')}, 0) + coalesce({grams(1, 'path')}, 0))::BIGINT AS logit_micro
      FROM u, (SELECT {weights} AS w))
SELECT page_id, host, path, {case('rule')} AS rule, coalesce({case('verdict')}, CASE WHEN logit_micro > 0 THEN 'block' ELSE 'allow' END) AS verdict, logit_micro FROM s"""

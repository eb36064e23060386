"""URL filters: host and path rules, and a character language-model ratio for the rest.

The rules decide first. The URLs they decide train two variable-order Markov models, one of accepted and
one of rejected URLs: a character's probability mixes those after no, one, two and up to ``CONTEXT``
characters by Witten-Bell weights, and a model uses a context only if it has seen it ``SEEN`` times, so
contexts get longer, and their table larger, as the URLs grow in number. A URL's score is the mean difference
of the two models' log-probabilities over its characters; the threshold is where as many accepted as rejected
URLs would be judged wrong, taking both groups' scores as normal. Everything is built-in functions, and
models and threshold come from all rows.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardbook.llm.scratch import stored

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CONTEXT, SEEN = 6, 8
# Marks for the start and the end of a URL.
_START, _END = "\x02", "\x03"



class Rule(NamedTuple):
    """``site`` is a host and the beginning of a path, like ``example.org/en/``."""

    verdict: str
    site: str


def host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule whose host is the URL's or a parent of it and whose path begins the URL's."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.site)):
        name, slash, rest = r.site.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        found = F.when(fits, r.site).otherwise(found)
    return found


def _body(url: Column) -> Column:
    """What the models read: all after ``://``, the host in lower case, or the whole text without a host."""
    named = F.concat(host(url), F.regexp_replace(_rest(url), "^[^/?#]*", ""))
    return F.coalesce(F.when(host(url) != "", named).otherwise(url), F.lit(""))


def grams(url: Column, context: int = CONTEXT) -> Column:
    """Each character with the ``context`` characters before it; the last one is the end mark."""
    text = F.concat(F.lit(_START * context), _body(url), F.lit(_END))
    # One match of no width at each character, but not between the halves of one.
    return F.regexp_extract_all(text, F.lit(f"(?s)(?!\\p{{Cs}})(?=(.{{{context + 1}}}))"), F.lit(1))


def ratio_model(counts: DataFrame, context: int = CONTEXT, seen: int = SEEN) -> DataFrame:
    """``gram`` and ``ratio``, the difference of the two models' log-probabilities of its last character.

    ``counts`` has every gram of the corpus with its numbers in accepted and rejected URLs. A context's rows are
    at most as many as there are different characters.
    """
    mixed = None
    for k in range(context + 1):
        level = counts.groupBy(F.substring("gram", context - k + 1, k + 1).alias("g")).agg(F.sum(ALLOW).alias(ALLOW), F.sum(BLOCK).alias(BLOCK))
        alike = W.partitionBy(F.substring("g", 1, k))
        both = {f"{c}_total": F.sum(c).over(alike) for c in (ALLOW, BLOCK)} | {f"{c}_kinds": F.count_if(F.col(c) > 0).over(alike) for c in (ALLOW, BLOCK)}
        if mixed is None:
            both |= {f"{c}_less": 1 / F.count("*").over(alike) for c in (ALLOW, BLOCK)}
        level = level.withColumns(both)
        if mixed is not None:
            level = level.withColumn("s", F.substring("g", 2, k)).join(mixed, "s")
        p = {c: (F.col(c) + F.col(f"{c}_kinds") * F.col(f"{c}_less")) / (F.col(f"{c}_total") + F.col(f"{c}_kinds")) for c in (ALLOW, BLOCK)}
        p = {c: F.when(F.col(f"{c}_total") >= (seen if k else 1), p[c]).otherwise(F.col(f"{c}_less")) for c in p}
        mixed = level.select(F.col("g").alias("s"), *[p[c].alias(f"{c}_less") for c in p])
    return mixed.select(F.col("s").alias("gram"), (F.log(f"{ALLOW}_less") - F.log(f"{BLOCK}_less")).alias("ratio"))


def scored(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Distinct (page_id, url) with their number ``copies``, the rules' ``decision`` and the ``score``."""
    url = F.col("url")
    decision = rule(host(url), path(url), rules)
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in (r.site, r.verdict)]) if rules else None
    decided = verdicts[decision] if rules else F.lit(None).cast("string")
    own = pages.select("page_id", "url").groupBy("page_id", "url").agg(F.count("*").alias("copies"))
    # Few bytes, but each becomes a row: dealt to as many tasks as a shuffle has, whatever their size.
    # (By the hash of the keys, since a partitioning by the keys themselves is there already and may be coalesced.)
    own = own.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("page_id", "url"))
    own = stored(own.withColumns({"decision": decided, "n": F.monotonically_increasing_id()}), "urls")
    split = own.select("n", "copies", "decision", F.explode(grams(url)).alias("gram"))
    of = lambda v: F.coalesce(F.sum(F.when(F.col("decision") == v, F.col("copies"))), F.lit(0)).alias(v)
    model = stored(ratio_model(stored(split.groupBy("gram").agg(of(ALLOW), of(BLOCK)), "grams")), "ratios")
    scores = split.select("n", "gram").join(model, "gram").groupBy("n").agg(F.avg("ratio").alias("score"))
    return stored(own.join(scores, "n").drop("n"), "scores")


def threshold(scores: DataFrame) -> DataFrame:
    """One row ``t``, between the groups' mean scores; null if one group is missing."""
    part = lambda v: F.when(F.col("decision") == v, F.col("score"))
    a, b = ((F.avg(part(v)), F.coalesce(F.stddev_pop(part(v)), F.lit(0.0)) + 1e-9) for v in (ALLOW, BLOCK))
    return scores.agg(((a[0] * b[1] + b[0] * a[1]) / (a[1] + b[1])).alias("t"))


def judged(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per row of ``pages`` (``page_id`` and ``url`` are used): ``page_id``, ``host``, ``path``, ``rule``,
    ``verdict`` and ``score``.

    A URL that no rule fits is blocked if its score is under the threshold. A null URL, or one without
    ``://``, has an empty host and path, is judged by the text it has, and matches only rules that fit those.
    If the rules accept nothing or reject nothing, there is no ratio, and all the rest is allowed. Equal rows
    are each returned; an empty table gives no rows.
    """
    scores = scored(pages, rules)
    url = F.col("url")
    parts = scores.select("page_id", "copies", "decision", "score", host(url).alias("host"), path(url).alias("path"))
    parts = parts.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    parts = parts.withColumns({"rule": rule(F.col("host"), F.col("path"), rules), "t": threshold(scores).scalar()})
    own = F.when(F.col("score") < F.col("t"), BLOCK).otherwise(ALLOW)
    rows = parts.withColumn("verdict", F.coalesce("decision", own)).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select("page_id", "host", "path", "rule", "verdict", "score")

"""URL filter: listed rules first, then association rules between tokens of a url and its verdict.

FP-growth mines the token combinations of labelled urls; those that also occur in urls too wide for it are counted level
by level, so that every combination is looked at. A combination that carries a verdict often and reliably enough
becomes a rule, unless fewer of its tokens already say the same as reliably. Each rule is posted under its rarest token;
a url looks its tokens up there and keeps the rules whose tokens it has all. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwatch.llm.support import stored

ALLOW, BLOCK = "allow", "block"
#: Share of the labelled urls, in hundredths, that must have a combination; and of those the share with its verdict.
SUPPORT, CONFIDENCE = 1, 95
#: Tokens of a rule; tokens of one url, and tokens at all (those that tell the verdicts apart best), that FP-growth takes.
#: A url with more or other tokens is wide: its combinations are counted level by level.
ANTECEDENT, WIDTH, VOCABULARY = 3, 8, 1000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_VERDICT = "verdict/"


@dataclass(frozen=True)
class Rule:
    """Holds for a host and its subdomains, for paths that start with `path`."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def _lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) up to `/`, `?`, `#` or the end, and path up to `?`, `#` or the end; empty without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    return _lower(host), path


def listed(host: Column, path: Column, rules: list[Rule]) -> Column:
    """rule and verdict of the longest listed rule that fits, else null. The list is a short, stated parameter."""
    kind = "struct<length: int, rule: string, verdict: string>"
    found = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(len(r.name)).alias("length"), F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.array_max(F.array(*found).cast(f"array<{kind}>")) if found else F.lit(None).cast(kind)


def url_tokens(host: Column, path: Column) -> Column:
    """The distinct words of host and path, each marked with where it stands."""
    def words(part: Column, mark: str) -> Column:
        return F.transform(F.regexp_extract_all(_lower(part), F.lit(_TOKEN), F.lit(0)), lambda word: F.concat(F.lit(mark), word))

    return F.array_distinct(F.concat(words(host, "h/"), words(path, "p/")))


def _counted(combinations: DataFrame) -> DataFrame:
    """tokens, verdict, freq and all (whatever the verdict) out of one row per occurrence (tokens, verdict)."""
    found = combinations.groupBy("tokens", "verdict").agg(F.count("*").alias("freq"))
    return found.withColumn("all", F.sum("freq").over(Window.partitionBy("tokens")))


def _telling(labelled: DataFrame, mixed: DataFrame, n: int, vocabulary: int) -> list[str]:
    """Of the tokens (tokens, verdict, freq, all), those whose share of blocked urls differs most from the share of all."""
    share = labelled.agg(F.count_if(F.col("verdict") == BLOCK).alias("n")).first()["n"] / n
    blocked = F.sum(F.when(F.col("verdict") == BLOCK, F.col("freq")).otherwise(0))
    counts = mixed.groupBy(F.col("tokens")[0].alias("token")).agg(blocked.alias("b"), F.first("all").alias("c"))
    lift = F.abs(F.col("b") / F.col("c") - F.lit(share))
    return [r["token"] for r in counts.select("token", lift.alias("lift")).orderBy(F.desc("lift"), "token").limit(vocabulary).collect()]


def _grown(narrow: DataFrame, least: int, antecedent: int) -> DataFrame:
    """FP-growth: tokens (two or more), verdict, freq and all of the frequent combinations of narrow urls (tokens, verdict)."""
    n = narrow.count()
    baskets = narrow.select(F.array_append("tokens", F.concat(F.lit(_VERDICT), "verdict")).alias("items"))
    if n < least:
        return baskets.sparkSession.createDataFrame([], "tokens array<string>, verdict string, freq long, all long")
    # Spark rounds the support up to whole rows; half a row less is the same number.
    mined = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=1.0).fit(baskets).freqItemsets
    sets = stored(mined.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    verdict = F.get(F.filter("items", lambda x: x.startswith(_VERDICT)), F.lit(0))
    sized = sets.withColumn("verdict", verdict).where(F.size("items").between(2, antecedent + 1))
    plain = sized.where("verdict IS NULL").select(F.col("items").alias("tokens"), F.col("freq").alias("all"))
    with_verdict = sized.where(F.col("verdict").isNotNull() & (F.size("items") > 2)).select(
        F.array_remove("items", F.col("verdict")).alias("tokens"), F.substr("verdict", F.lit(len(_VERDICT) + 1)).alias("verdict"), "freq"
    )
    return with_verdict.join(plain, "tokens").select("tokens", "verdict", "freq", "all")


def _by_levels(rows: DataFrame, least: int, antecedent: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Counts over all rows (tokens, verdict, wide) of the combinations that occur in wide ones, and these combinations.

    A combination grows by a later token of its row only if it is frequent itself: no other can become frequent.
    """
    met = rows.select("verdict", "wide", F.posexplode("tokens").alias("at", "token"), "tokens")
    met = met.select("verdict", "wide", F.array("token").alias("tokens"), F.slice("tokens", F.col("at") + 2, F.size("tokens")).alias("later"))
    counts = seen = None
    for _ in range(1, antecedent):
        longer = met.select("verdict", "wide", "tokens", F.posexplode("later").alias("at", "token"), "later").select(
            "verdict", "wide", F.array_append("tokens", F.col("token")).alias("tokens"), F.slice("later", F.col("at") + 2, F.size("later")).alias("later")
        )
        candidates = stored(longer.where("wide").select("tokens").distinct(), "candidates")
        met = stored(longer.join(candidates, "tokens", "left_semi"), "met")
        frequent = stored(_counted(met).where(F.col("freq") >= least), "frequent")
        met = met.join(frequent.select("tokens").distinct(), "tokens", "left_semi")
        counts = frequent if counts is None else counts.union(frequent)
        seen = candidates if seen is None else seen.union(candidates)
    return counts, seen


def mine_rules(labelled: DataFrame, support: int = SUPPORT, confidence: int = CONFIDENCE, antecedent: int = ANTECEDENT, width: int = WIDTH, vocabulary: int = VOCABULARY) -> DataFrame:
    """tokens, verdict, confidence, token (the rarest, to post the rule under) out of labelled(tokens, verdict).

    labelled should be a stored table: it is read several times. No labelled row gives no rule. A rule's tokens (distinct,
    `antecedent` at most) and verdict occur together in at least `support` percent of the rows (two rows at least), and
    in `confidence` percent of the rows with the tokens. All frequent tokens of all rows are mined; `width` and
    `vocabulary` only decide which rows go to FP-growth and which are counted level by level. A token that always has
    the same verdict is a rule by itself, and all its combinations say nothing more: they are left out beforehand.
    """
    spark, n = labelled.sparkSession, labelled.count()
    empty = spark.createDataFrame([], "tokens array<string>, verdict string, confidence double, token string")
    if not n:
        return empty
    least = max(2, -(-n * support // 100))
    each = labelled.withColumn("row", F.monotonically_increasing_id()).select("row", "verdict", F.explode("tokens").alias("token"))
    singles = stored(_counted(each.select(F.array("token").alias("tokens"), "verdict")).where(F.col("all") >= least), "singles")
    sets = singles.where(F.col("freq") >= least)
    mixed = singles.where(F.col("freq") < F.col("all"))
    if antecedent > 1:
        ranked = _telling(labelled, mixed, n, vocabulary)
        known = mixed.select(F.col("tokens")[0].alias("token")).distinct()
        rows = each.join(known, "token").groupBy("row", "verdict").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
        others = F.size(F.array_except("tokens", F.array(*[F.lit(t) for t in ranked]).cast("array<string>"))) > 0
        rows = stored(rows.select("verdict", "tokens", ((F.size("tokens") > width) | others).alias("wide")).where(F.size("tokens") > 1), "rows")
        combinations = _grown(rows.where("NOT wide").select("tokens", "verdict"), least, antecedent)
        if not rows.where("wide").isEmpty():
            counts, seen = _by_levels(rows, least, antecedent)
            combinations = combinations.join(seen, "tokens", "left_anti").union(counts.select("tokens", "verdict", "freq", "all"))
        sets = sets.union(combinations.select("tokens", "verdict", "freq", "all"))
    sure = stored(
        sets.where((F.col("freq") >= least) & (F.col("freq") * 100 >= F.col("all") * confidence)).select("tokens", "verdict", (F.col("freq") / F.col("all")).alias("confidence")),
        "sure",
    )
    rules = _without_redundant(sure)
    rare = singles.select(F.col("tokens")[0].alias("token"), "all").distinct()
    posted = (
        rules.select("tokens", "verdict", F.explode("tokens").alias("token"))
        .join(rare, "token")
        .groupBy("tokens", "verdict")
        .agg(F.min_by("token", F.struct("all", "token")).alias("token"))
    )
    return stored(rules.join(posted, ["tokens", "verdict"]), "rules")


def _without_redundant(rules: DataFrame) -> DataFrame:
    """Leaves out rules that have a part of their tokens as an equally sure rule."""
    tokens = F.col("tokens")
    one = F.transform(tokens, lambda x: F.array(x))
    two = F.flatten(F.transform(tokens, lambda x: F.transform(F.filter(tokens, lambda y: y > x), lambda y: F.array(x, y))))
    parts = F.filter(F.concat(one, two), lambda part: F.size(part) < F.size(tokens))
    subset = rules.select("tokens", "verdict", "confidence", F.explode(parts).alias("part"))
    other = rules.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("sure"))
    said = subset.join(other, ["part", "verdict"]).where(F.col("sure") >= F.col("confidence")).select("tokens", "verdict").distinct()
    return rules.join(said, ["tokens", "verdict"], "left_anti")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, learned: the verdict of the surest rule that fits each url with one; of equally sure ones block wins.

    urls: url, tokens. Only urls that meet a rule's rarest token are compared with it. rules should be a stored table;
    its tokens pass through the driver, so that a long url is cut to them before it is looked up. Each is in `support`
    percent of the labelled urls, so there are at most 100 / support times as many as a labelled url has on average.
    """
    known = [F.lit(r["token"]) for r in rules.select(F.explode("tokens").alias("token")).distinct().collect()]
    if not known:
        return urls.select("url", F.lit(None).cast("string").alias("learned")).limit(0)
    posted = rules.select("token", F.col("tokens").alias("wanted"), "verdict", "confidence")
    short = urls.withColumn("tokens", F.array_intersect("tokens", F.array(*known)))
    met = short.withColumn("token", F.explode("tokens")).join(posted, "token").where(F.size(F.array_except("wanted", "tokens")) == 0)
    best = F.max(F.struct("confidence", (F.col("verdict") == BLOCK).alias("block")))
    return met.groupBy("url").agg(best.alias("best")).select("url", F.when(F.col("best.block"), BLOCK).otherwise(ALLOW).alias("learned"))


def judge_urls(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", labels: DataFrame | None = None, **mining) -> DataFrame:
    """key, host, path, rule and verdict (allow or block) of every row of pages.

    The longest listed rule decides. Other urls get the verdict of mined rules, learned from labels(url, verdict) or,
    where none are given, from the verdicts of the listed rules on the distinct urls they fit; without a fitting rule
    they are allowed. Null urls and urls without `://` have empty host and path and are allowed unless a rule fits.
    Repeated rows each give a row; empty pages give an empty table. Other columns are never read.
    """
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"))
    host, path = host_and_path(F.coalesce("url", F.lit("")))
    parsed = rows.withColumns({"host": host, "path": path}).withColumn("found", listed(F.col("host"), F.col("path"), rules))
    distinct = stored(
        parsed.select("url", "host", "path", "found.verdict").distinct().withColumn("tokens", url_tokens(F.col("host"), F.col("path"))).select("url", "tokens", "verdict"),
        "urls",
    )
    known = distinct.where("verdict IS NOT NULL")
    if labels is not None:
        host, path = host_and_path(F.col("url"))
        known = stored(labels.select("verdict", url_tokens(host, path).alias("tokens")), "labelled")
    learned = match_rules(distinct.where("verdict IS NULL AND url IS NOT NULL").select("url", "tokens"), mine_rules(known, **mining))
    return parsed.join(learned, "url", "left").select(
        "key", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", "learned", F.lit(ALLOW)).alias("verdict")
    )

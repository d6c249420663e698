"""URL filters: given rules first, then association rules mined from labelled URLs."""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import stored

ALLOW, BLOCK = "allow", "block"
#: Share of the labelled URLs that a mined rule must cover, and be right about where it applies.
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.8


@dataclass(frozen=True)
class UrlRule:
    """A host, which also stands for its subdomains, and what its paths start with."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _fits(rule: UrlRule, host: Column, path: Column) -> Column:
    inside = (host == rule.host) | host.endswith("." + rule.host)
    return inside & path.startswith(rule.path)


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """The sorted tokens of a URL: parts of its host, path and query that many URLs can share."""
    labels = F.split(host, r"\.")
    after = _after_scheme(url)

    def last(count: int) -> Column:
        start = F.greatest(F.size(labels) - count, F.lit(0)) + 1
        return F.array_join(F.slice(labels, start, F.lit(count)), ".")

    directory = F.regexp_extract(path, r"^/([^/]+)/", 1)
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    query = F.regexp_extract(after, r"^[^?#]*\?([^#]*)", 1)
    arguments = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("arg="), F.regexp_extract(x, r"^[^=]*", 0)))
    single = [
        ("scheme=", F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)),
        ("top=", last(1)),
        ("domain=", F.when(F.size(labels) > 1, last(2)).otherwise("")),
        ("site=", F.when(F.size(labels) > 2, last(3)).otherwise("")),
        ("dir=", directory),
        ("end=", ending),
    ]
    named = F.array(*(F.when(part != "", F.concat(F.lit(name), part)) for name, part in single))
    all_tokens = F.concat(
        F.array_compact(named), F.filter(arguments, lambda x: x != "arg=")
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.sort_array(F.array_distinct(all_tokens))
    )


def token_classes(baskets: DataFrame, least: float) -> DataFrame:
    """(token, class): tokens of the same rows, of (row, tokens), share the smallest as class.

    Only tokens of ``least`` rows or more have one: with a share of the rows as support,
    their number is bounded by that share. Two tokens are of the same rows if their
    counts and 128 bits over the numbers of their rows agree.
    """
    each = baskets.select(F.xxhash64("row").alias("h1"), F.xxhash64(F.lit(1), "row").alias("h2"), F.explode("tokens").alias("token"))
    held = each.groupBy("token").agg(
        F.count("*").alias("freq"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")
    ).where(F.col("freq") >= least)
    smallest = held.groupBy("freq", "h1", "h2").agg(F.min("token").alias("class"))
    return stored(held.join(smallest, ["freq", "h1", "h2"]).select("token", "class", "freq"))


def _of_classes(rows: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """The rows with their tokens' different classes instead, those of ``key`` column."""
    each = rows.select(key, F.explode("tokens").alias("token")).join(classes.select("token", "class"), "token")
    return each.groupBy(key).agg(F.sort_array(F.collect_set("class")).alias("classes"))


def mined_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> tuple[DataFrame, DataFrame]:
    """(antecedent, verdict, confidence, support, key) from rows (tokens, verdict), and the classes.

    FP-growth counts the combinations of tokens and verdict; rules are those whose
    consequent is a verdict. Tokens that always come together are one item, their
    class: every combination of them has the same rows, so that a site whose URLs share
    many arguments costs no more than one with a single argument. A rule fits a URL that
    has some token of each class. ``key`` is the rarest class of the antecedent, under
    which the inverted index files the rule. Their number depends on the support
    asked for, not on the number of URLs.
    """
    mark = "verdict="
    rows = stored(
        labelled.where(F.size("tokens") > 0).select("tokens", "verdict")
    ).withColumn("row", F.monotonically_increasing_id())
    total = rows.count()
    classes = token_classes(rows, min_support * total)
    held = _of_classes(rows, classes, "row")
    verdict = F.concat(F.lit(mark), F.col("verdict"))
    baskets = rows.select("row", verdict.alias("item")).join(held, "row", "left").select(
        F.concat(F.coalesce("classes", F.array().cast("array<string>")), F.array("item")).alias("items")
    )
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(stored(baskets))
    # An antecedent holds one verdict at most; those that do are no rules about URLs.
    found = (
        model.associationRules.where(
            F.col("consequent")[0].startswith(mark)
            & ~F.exists("antecedent", lambda x: x.startswith(mark))
        )
        .select(
            F.sort_array("antecedent").alias("antecedent"),
            F.substr(F.col("consequent")[0], F.lit(len(mark) + 1)).alias("verdict"),
            "confidence",
            "support",
        )
    )
    singles = classes.where(F.col("token") == F.col("class")).select("token", "freq")
    parts = found.select("*", F.explode("antecedent").alias("token")).join(singles, "token")
    rarest = parts.groupBy("antecedent", "verdict", "confidence", "support").agg(
        F.min(F.struct("freq", "token"))["token"].alias("key")
    )
    return stored(rarest), classes


def _matched(signatures: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """(tokens, learned): the verdict of the best rule of each set of tokens that some rule fits.

    A set looks up each of its classes in the index; a rule found by its rarest class
    fits if the set has its other classes too. The best rule has the highest
    confidence, then the highest support, then the fewest classes.
    """
    held = _of_classes(signatures.withColumn("same", F.col("tokens")), classes, "same")
    looked_up = held.select(F.col("same").alias("tokens"), "classes", F.explode("classes").alias("class"))
    fitting = looked_up.join(
        rules,
        (looked_up["class"] == rules["key"])
        & (F.size(F.array_except(rules["antecedent"], looked_up["classes"])) == 0),
    )
    rank = F.struct(
        (-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"),
        F.size("antecedent").alias("n"), "antecedent", "verdict",
    )
    return fitting.groupBy("tokens").agg(F.min(rank)["verdict"].alias("learned"))


def _judged_by(rules: list[UrlRule], value) -> Column:
    """What ``value`` gives for the longest rule that fits ``host`` and ``path``; null for none."""
    ordered = sorted(rules, key=lambda rule: (-len(rule.name), rule.name))
    fitting = [F.when(_fits(r, F.col("host"), F.col("path")), F.lit(value(r))) for r in ordered]
    return F.coalesce(*fitting) if fitting else F.lit(None).cast("string")


def given_verdicts(
    pages: DataFrame, rules: list[UrlRule], id_column: str = "page_id", url_column: str = "url"
) -> DataFrame:
    """(page_id, url, host, path, rule, given) of every page: what the given rules decide."""
    url = F.coalesce(F.col("url"), F.lit(""))
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"))
    rows = rows.withColumns({"host": host_of(url), "path": path_of(url)})
    return rows.withColumns(
        {"rule": _judged_by(rules, lambda r: r.name), "given": _judged_by(rules, lambda r: r.verdict)}
    )


def judged_urls(
    pages: DataFrame,
    rules: list[UrlRule],
    id_column: str = "page_id",
    url_column: str = "url",
    labels: DataFrame | None = None,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    default: str = ALLOW,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    The longest given rule that fits decides. The other URLs are judged by rules
    mined from labels: rows (url, verdict), or without them the URLs that given
    rules decide. Where no mined rule fits, the verdict is ``default``. A null URL,
    and one without ``://``, has an empty host and path and gets the default. Null
    ids and repeated rows pass through; an empty table gives no rows.
    """
    url = F.coalesce(F.col("url"), F.lit(""))

    def tokens(frame: DataFrame) -> DataFrame:
        return frame.withColumn("tokens", tokens_of(url, F.col("host"), F.col("path")))

    rows = tokens(given_verdicts(pages, rules, id_column, url_column))
    if labels is None:
        labelled = rows.where("given IS NOT NULL").select("tokens", F.col("given").alias("verdict"))
    else:
        parsed = labels.select("url", "verdict").withColumns({"host": host_of(url), "path": path_of(url)})
        labelled = tokens(parsed).select("tokens", "verdict").where("verdict IS NOT NULL")
    mined, classes = mined_rules(labelled, min_support, min_confidence)
    signatures = rows.where("given IS NULL AND size(tokens) > 0").select("tokens").distinct()
    learned = stored(_matched(signatures, mined, classes)).withColumnRenamed("tokens", "signature")
    return rows.join(learned, rows["tokens"] == learned["signature"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("given", "learned", F.lit(default)).alias("verdict")
    )

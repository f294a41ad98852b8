"""URL filter: host and path rules, and a character language-model ratio for the rest.

Two smoothed Markov models of order 0 to 2 over 32 character classes, one for the URLs
that the rules accept and one for those they reject, give every URL a mean
log-likelihood difference per character. The accepted share of URLs begins at the
difference that best separates the two ruled groups (least sum of both error rates).
Counts come from every ruled URL; the model is a table of 32^3 weights, whatever the
number of URLs.

Defined results: NULL, or a URL without ``://``, has empty host and path and fits no
rule; an empty URL has the difference 0; without ruled URLs of both kinds the border is
0 and a difference of 0 is allowed; repeated rows keep their number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ALLOW, BLOCK = "allow", "block"

# The rules, as (verdict, host, path).
RULES = [
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Character classes 1 to 31; 0 is any other character and the start of a URL.
ALPHABET = LOWER + "0/.-?"
MERGED, MERGED_TO = "123456789_=&#%:", "000000000-?????"
CLASSES = 32
GRAMS = CLASSES**3
PRIOR = 4.0  # weight of the next shorter context
UNIT = 1_000_000  # weights are whole millionths, so that sums are exact
BINS = 100  # steps of the calibration per unit of difference

Rule = tuple[str, str, str]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; NULL where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def with_rules(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    host, path = host_and_path(F.col(url))
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    return (
        pages.withColumn("host", host)
        .withColumn("path", path)
        .withColumn("rule", name)
        .withColumn("rule_verdict", verdict)
    )


def grams(url: Column) -> Column:
    """For every character, the classes of it and of the two before it as one number."""
    plain = F.translate(ascii_lower(F.coalesce(url, F.lit(""))), MERGED, MERGED_TO)
    letters = F.filter(F.split(plain, ""), lambda c: c != "")
    classes = F.transform(letters, lambda c: F.instr(F.lit(ALPHABET), c))
    start = F.array(F.lit(0), F.lit(0))
    padded = F.concat(start, classes)
    # Position i of the zip holds three neighbours; the last two have none.
    triples = F.arrays_zip(
        padded.alias("a"), F.slice(padded, F.lit(2), F.size(padded)).alias("b"), classes.alias("c")
    )
    triples = F.slice(triples, F.lit(1), F.size(classes))
    return F.transform(triples, lambda t: t["a"] * CLASSES**2 + t["b"] * CLASSES + t["c"])


def gram_counts(ruled: DataFrame, url: str = "url") -> DataFrame:
    """(verdict, gram, n) over all ruled URLs; at most two rows per gram leave a task."""
    each = ruled.select(F.col("rule_verdict").alias("verdict"), F.explode(grams(F.col(url))).alias("gram"))
    return each.groupBy("verdict", "gram").agg(F.count(F.lit(1)).alias("n"))


def log_ratio(counts: DataFrame) -> DataFrame:
    """(gram, weight): log P(accepted) - log P(rejected) of the last class after the two before."""
    spark = counts.sparkSession
    grid = spark.range(2 * GRAMS).select(
        F.when(F.col("id") < GRAMS, ALLOW).otherwise(BLOCK).alias("verdict"), (F.col("id") % GRAMS).alias("gram")
    )
    full = grid.join(counts, ["verdict", "gram"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    parts = {
        "ab": F.floor(F.col("gram") / CLASSES),
        "bc": F.col("gram") % CLASSES**2,
        "b": F.floor(F.col("gram") / CLASSES) % CLASSES,
        "c": F.col("gram") % CLASSES,
    }
    for name, part in parts.items():
        full = full.withColumn(name, part)
        full = full.withColumn(f"n_{name}", F.sum("n").over(Window.partitionBy("verdict", name)))
    full = full.withColumn("n_all", F.sum("n").over(Window.partitionBy("verdict")))
    order_0 = (F.col("n_c") + 1) / (F.col("n_all") + CLASSES)
    order_1 = (F.col("n_bc") + PRIOR * order_0) / (F.col("n_b") + PRIOR)
    order_2 = (F.col("n") + PRIOR * order_1) / (F.col("n_ab") + PRIOR)
    signed = F.when(F.col("verdict") == ALLOW, F.log(order_2)).otherwise(-F.log(order_2))
    rounded = full.withColumn("weight", F.round(signed * UNIT).cast("long"))
    return rounded.groupBy("gram").agg(F.sum("weight").alias("weight"))


@dataclass(frozen=True)
class Ratio:
    """Weights of all grams, and the least difference (in 1/BINS) that is allowed."""

    weights: tuple[int, ...]
    border: int

    def difference(self, url: Column) -> Column:
        """Mean log-likelihood difference per character."""
        # One foldable text, so that the plan holds a single array constant.
        table = F.split(F.lit(",".join(map(str, self.weights))), ",").cast("array<bigint>")
        total = F.aggregate(grams(url), F.lit(0).cast("long"), lambda sum_, gram: sum_ + F.get(table, gram))
        size = F.size(grams(url)).cast("long")
        return F.when(size > 0, total / (size * UNIT)).otherwise(F.lit(0.0))

    def allows(self, difference: Column) -> Column:
        return F.floor(difference * BINS) >= self.border


def border_of(scored: DataFrame) -> int:
    """The difference, in 1/BINS, from which on allowing makes the least errors.

    ``scored``: (rule_verdict, difference). The differences are bounded by the weights,
    so the histogram has a few thousand rows at any size.
    """
    bins = scored.groupBy(F.floor(F.col("difference") * BINS).alias("bin")).agg(
        F.count_if(F.col("rule_verdict") == ALLOW).alias("good"),
        F.count_if(F.col("rule_verdict") == BLOCK).alias("bad"),
    )
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    errors = (
        bins.withColumn("good_below", F.coalesce(F.sum("good").over(below), F.lit(0)))
        .withColumn("bad_below", F.coalesce(F.sum("bad").over(below), F.lit(0)))
        .withColumn("goods", F.sum("good").over(everything))
        .withColumn("bads", F.sum("bad").over(everything))
        .where((F.col("goods") > 0) & (F.col("bads") > 0))
        .withColumn(
            "error",
            F.col("good_below") / F.col("goods") + (F.col("bads") - F.col("bad_below")) / F.col("bads"),
        )
    )
    best = errors.orderBy("error", F.abs("bin"), "bin").limit(1).collect()
    return best[0]["bin"] if best else 0


def train(ruled: DataFrame, url: str = "url") -> Ratio:
    """Both models from all ruled URLs; the driver gets 32^3 weights and one border."""
    rows = log_ratio(gram_counts(ruled, url)).collect()
    weights = [0] * GRAMS
    for row in rows:
        weights[row["gram"]] = row["weight"]
    ratio = Ratio(tuple(weights), 0)
    scored = ruled.select("rule_verdict", ratio.difference(F.col(url)).alias("difference"))
    return Ratio(ratio.weights, border_of(scored))


def judged(pages: DataFrame, rules: Sequence[Rule] = tuple(RULES), url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and difference; no column of the page but ``url`` is read."""
    own = ["host", "path", "rule", "verdict", "difference", "rule_verdict"]
    rest = [F.col(f"`{c}`") for c in pages.columns if c not in own]
    marked = with_rules(pages.select(*rest), rules, url)
    ratio = train(marked.where(F.col("rule_verdict").isNotNull()).select(url, "rule_verdict"), url)
    scored = marked.withColumn("difference", ratio.difference(F.col(url)))
    by_model = F.when(ratio.allows(F.col("difference")), ALLOW).otherwise(BLOCK)
    return scored.withColumn("verdict", F.coalesce("rule_verdict", by_model)).drop("rule_verdict")


def url_filter(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, difference of every page."""
    return judged(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "difference")

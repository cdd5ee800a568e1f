"""Verdicts on URLs: host rules first, then gradient-boosted trees on lexical features."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rules of the queries, host and path: (verdict, rule).
RULES = [
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]

# Labelled parts of URLs, made by hand. Harmless and harmful hosts alike have hyphens, digits and
# plain words; what tells them apart is spread over suffix, digits, entropy and length.
GOOD_HOSTS = """www.shop.example.com blog.example.org news.example.net en.encyclopedia.org
library.university.edu docs.project.org www.gardening.com recipes.example.com history.example.org
m.weather.net blog.travelling.example.com www.museum.example.net science.example.org maps.city.gov
www.long-standing-community.example.org route-66-travel.com m.formula-1-news.net 3sat-archive.org
old-town-theatre.example.com 24h-pharmacy.org the-daily-herald.net casino.example.org poker.example.net
dating.example.com loans.bank.com video.example.org bets.museum.org music-of-the-80s.example.net
www.hospital.org forum.cycling.example.net thunder.example.net""".split()
BAD_HOSTS = """casinobonus.top winbig.click freegift.win hotdates.xyz cheapmeds.top bestbets.click
prizes.win adultvideo.xyz fastloan.top cryptodouble.click x7f9q2k4.example.com a1b2c3d4e5.example.org
q8w7z5x3v1.example.net k3j9h2g8.com zx81cv72bn.net 185x220x101.org secure.login.account.update.example.com
www.paypa1.signin.verify.session.example.net free.money.now.today.only.example.org
win-cash-now.top buy-cheap-meds.click hot-dates-4u.xyz m.free-iphone-gift.win daily-casino-slots.top
xkqzjwvbpfgh.com wqxzvkjhgfdp.net""".split()
GOOD_PATHS = """/ /en/12 /en/345.html /de/78/ /fr/901?page=2 /es/23 /en/456#top /index.php?id=77
/2024/05/17/a-long-title-of-a-story /docs/user-guide.pdf /img/photo.jpg /search?q=red+sea&page=2
/about/team.html /blog/2023/11/how-to-grow-tomatoes-in-a-small-garden""".split()
BAD_PATHS = """/win-cash-now?aff=1&sub=2&clk=3&ref=4&cid=5 /go?u=a8f3k2&src=push&cid=99182&tid=7&z=1
/casino/slots/bonus?code=A8F3K2&src=push&cid=99182&sid=55 /dl/setup.exe /free/iphone.apk?id=8842
/c/8f7a6b5c4d3e2f1a0b9c8d7e6f5a4b3c /r/93847561029384756102938475 /update/flash.exe?v=12
/wp-content/plugins/x/y/z/a/b/c/login.php?e=1&t=2&s=3&q=4 /track?i=1&j=2&k=3&l=4&m=5&n=6
/cracked/games.zip /m/e/r/c/h/a/n/t/verify.php?session=8273645&token=99aa88bb77cc""".split()
SCHEMES = ("http", "https")

FEATURES = [
    "url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio",
    "host_digit_ratio", "host_hyphens", "host_entropy", "longest_label", "n_params",
    "query_length", "has_fragment", "is_https", "suffix_rate", "ending_rate",
]
# Weight of the prior in the suffix statistics, in labelled rows.
PRIOR_ROWS = 20.0


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add host, path, query and fragment flag; without "://" host and path are empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    before_fragment = F.substring_index(F.col("_rest"), "#", 1)
    before_query = F.substring_index(before_fragment, "?", 1)
    host = F.regexp_extract("_rest", r"^([^/?#]*)", 1)
    return (
        df.withColumn("_rest", rest)
        .withColumns({"_host": host, "_before": before_query, "_full": before_fragment})
        .withColumns({
            "host": ascii_lower(F.col("_host")),
            "path": F.expr("substring(_before, length(_host) + 1)"),
            "_query": F.expr("substring(_full, length(_before) + 2)"),
            "_fragment": F.length("_rest") > F.length("_full"),
        })
        .drop("_host", "_before", "_full", "_rest")
    )


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters of a text, in bits."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    size = F.size(chars).cast("double")

    def share(c: Column) -> Column:
        return (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / size

    terms = F.transform(F.array_distinct(chars), lambda c: -share(c) * F.log2(share(c)))
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)


def _digits(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^0-9]", ""))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """The lexical features but the suffix statistics."""
    text = F.coalesce(F.col(url), F.lit(""))
    labels = F.split("host", r"\.")
    plain = df.withColumns({
        "url_length": F.length(text), "host_length": F.length("host"),
        "path_length": F.length("path"), "host_depth": F.size(labels),
        "path_depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")),
        "digit_ratio": _ratio(_digits(text), F.length(text)),
        "host_digit_ratio": _ratio(_digits(F.col("host")), F.length("host")),
        "host_hyphens": F.length(F.regexp_replace("host", "[^-]", "")),
        "host_entropy": entropy(F.col("host")),
        "longest_label": F.array_max(F.transform(labels, lambda x: F.length(x))),
        "n_params": F.size(F.filter(F.split("_query", "&"), lambda x: x != "")),
        "query_length": F.length("_query"),
        "has_fragment": F.col("_fragment").cast("int"),
        "is_https": text.startswith("https://").cast("int"),
    })
    return plain.withColumns({
        "_suffix": F.substring_index("host", ".", -1),
        "_ending": F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1),
    })


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: url, label, host and path.

    A URL is one to block for its host or for its path: harmless hosts have harmful paths as well,
    so neither part decides alone.
    """
    pairs = [(h, p, 0) for h in GOOD_HOSTS for p in GOOD_PATHS]
    pairs += [(h, p, 1) for h in GOOD_HOSTS for p in BAD_PATHS]
    pairs += [(h, p, 1) for h in BAD_HOSTS for p in GOOD_PATHS]
    rows = [(f"{s}://{h}{p}", label, h, p) for h, p, label in pairs for s in SCHEMES]
    return spark.createDataFrame(rows, "url string, label int, host string, path string")


class UrlModel:
    """Boosted trees with the suffix statistics of their training table."""

    def __init__(self, trees: GBTClassificationModel, rates: dict[str, dict[str, float]],
                 prior: float):
        self.trees, self.rates, self.prior = trees, rates, prior

    @staticmethod
    def train(labelled: DataFrame, trees: int = 30, depth: int = 4) -> UrlModel:
        """Learn from (url, label); the table is small, its suffixes are too."""
        rows = lexical(url_parts(labelled.select("url", "label"))).cache()
        prior = float(rows.agg(F.avg("label")).first()[0])
        rates = {}
        for name in ("_suffix", "_ending"):
            sums = rows.groupBy(name).agg(F.sum("label"), F.count("*")).collect()
            rates[name] = {
                s: (bad + PRIOR_ROWS * prior) / (n + PRIOR_ROWS) for s, bad, n in sums
            }
        unfitted = UrlModel(None, rates, prior)
        learner = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, maxBins=32)
        model = learner.fit(unfitted.features(rows).select("features", "label"))
        rows.unpersist()
        return UrlModel(model, rates, prior)

    def _rate(self, name: str) -> Column:
        pairs = [F.lit(x) for pair in sorted(self.rates[name].items()) for x in pair]
        return F.coalesce(F.create_map(*pairs)[F.col(name)], F.lit(self.prior))

    def features(self, df: DataFrame) -> DataFrame:
        """Add the feature vector to rows with lexical features."""
        full = df.withColumns({
            "suffix_rate": self._rate("_suffix"), "ending_rate": self._rate("_ending"),
        })
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(full)

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``url_score``: how likely the URL is one to block."""
        scored = self.trees.transform(self.features(df))
        return scored.withColumn("url_score", vector_to_array("probability")[1])


def rule_of(rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits host and path, as struct(rule, verdict); null if none does.

    Of rules of the same length the one given first wins.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        host, slash, path = rule.partition("/")
        fits = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits &= F.startswith("path", F.lit(slash + path))
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value).otherwise(found)
    return found


def judge(pages: DataFrame, model: UrlModel, rules: list[tuple[str, str]]) -> DataFrame:
    """Host, path, rule, score and verdict of every row of ``pages`` (page_id, url).

    A null url or one without "://" has an empty host and path, so no rule fits it, and is
    judged by the trees. Repeated rows stay. An empty table gives an empty one.
    """
    parts = lexical(url_parts(pages.select("page_id", "url")))
    ruled = model.score(parts).withColumn("_rule", rule_of(rules))
    own = F.when(F.col("url_score") >= 0.5, "block").otherwise("allow")
    return ruled.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", own).alias("verdict"), "url_score",
    )

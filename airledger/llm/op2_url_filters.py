"""URL filters by gradient-boosted trees on lexical features, in DataFrame functions only.

Method: host and path are cut out of each url and matched with a list of allow and block
rules, the longest rule deciding. Urls under a rule are the labelled ones; at most
``TRAIN_ROWS`` of them, drawn by hash at any size, train boosted trees on length, depth,
digit ratio, entropy, parameter counts and statistics of the suffix. The trees judge all urls
without a rule.

Rules are expressions, not a join: they are a parameter with as many entries as one writes by
hand. Suffix statistics come from the training rows, so their table has at most as many rows;
it is joined without a hint.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.llm.tables import read, staged

TRAIN_ROWS = 20_000
# The rules to apply.
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
FEATURES = (
    "url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio",
    "entropy", "n_params", "n_marks", "suffix_length", "suffix_share", "suffix_block_rate",
)
TREES, DEPTH = 20, 4


def parts(pages: DataFrame) -> DataFrame:
    """``pages`` with host and path; both are empty for a null url or one without ``://``."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.expr("substring(_rest, length(_host) + 1)")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (
        pages.withColumn("_rest", rest)
        .withColumn("_host", host)
        .withColumn("path", F.regexp_extract(after, r"^[^?#]*", 0))
        .withColumn("host", F.translate("_host", upper, upper.lower()))
        .drop("_rest", "_host")
    )


def matched(rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule that fits host and path, or null."""
    found: Column | None = None
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        site, _, path = rule.partition("/")
        fits = (F.col("host") == site) | F.col("host").endswith("." + site)
        fits &= F.col("path").startswith("/" + path)
        found = F.when(fits, rule) if found is None else found.when(fits, rule)
    return F.lit(None).cast("string") if found is None else found


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` with host and path and the features that need nothing but the url."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    without = lambda column, chars: F.length(F.translate(column, chars, ""))
    size = F.length("_url")
    entropy = F.expr(
        "aggregate(transform(array_distinct(split(_url, '')), c -> "
        "cast(length(_url) - length(replace(_url, c, '')) as double) / greatest(1, length(_url))),"
        " 0D, (a, p) -> a - if(p > 0, p * log2(p), 0D))"
    )
    return (
        pages.withColumn("_url", url)
        .withColumn("suffix", F.regexp_extract("host", r"[^.]*$", 0))
        .withColumns(
            {
                "url_length": size.cast("double"),
                "host_length": F.length("host").cast("double"),
                "path_length": F.length("path").cast("double"),
                "host_depth": (F.length("host") - without("host", ".")).cast("double"),
                "path_depth": (F.length("path") - without("path", "/")).cast("double"),
                "digit_ratio": (size - without("_url", "0123456789")) / F.greatest(F.lit(1), size),
                "entropy": entropy,
                "n_params": (size - without("_url", "&=")).cast("double"),
                "n_marks": (size - without("_url", "?#-_%@")).cast("double"),
                "suffix_length": F.length("suffix").cast("double"),
            }
        )
        .drop("_url")
    )


def judged(
    pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, most: int = TRAIN_ROWS
) -> DataFrame:
    """``page_id, host, path, rule, verdict, block_score`` of every row of ``pages``.

    ``rule`` is null where none fits; then the trees' verdict holds, ``block_score`` being their
    probability. A null or odd url has empty parts and is judged like any other. Repeated rows
    are judged alike, other columns are ignored, and an empty table gives no rows. Without
    labelled urls of both kinds nothing can be learnt: the verdict is that of the one kind, or
    allow.
    """
    rows = parts(pages.select("page_id", F.col("url").cast("string").alias("url")))
    rows = lexical(rows.withColumn("rule", matched(rules)))
    verdicts = F.create_map(*[F.lit(x) for rule in rules for x in rule]) if rules else None
    ruled = F.lit(None).cast("string") if verdicts is None else verdicts[F.col("rule")]
    rows = rows.withColumn("_ruled", F.when(F.col("rule").isNotNull(), ruled))
    train = staged(
        rows.where("_ruled is not null")
        .withColumn("label", (F.col("_ruled") == "block").cast("double"))
        .orderBy(F.xxhash64("page_id", "url"), "page_id", "url")
        .limit(most),
        "urls",
    )
    seen = train.agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
    n, blocked = seen["n"], seen["blocked"] or 0.0
    out = ("page_id", "host", "path", "rule")
    if not 0 < blocked < n:
        other = "block" if n and blocked == n else "allow"
        return rows.select(
            *out,
            F.coalesce("_ruled", F.lit(other)).alias("verdict"),
            F.lit(1.0 if other == "block" else 0.0).alias("block_score"),
        )
    rate = blocked / n
    suffixes = train.groupBy("suffix").agg(
        (F.count("*") / n).alias("suffix_share"),
        ((F.sum("label") + 10 * rate) / (F.count("*") + 10)).alias("suffix_block_rate"),
    )

    def complete(df: DataFrame) -> DataFrame:
        full = df.join(suffixes, "suffix", "left").fillna(
            {"suffix_share": 0.0, "suffix_block_rate": rate}
        )
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(full)

    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7)
    model = trees.fit(complete(train).select("features", "label"))
    margin = vector_to_array("rawPrediction")[1]
    return (
        model.transform(complete(rows))
        .withColumn("block_score", F.round(1 / (1 + F.exp(-2 * margin)), 6))
        .select(
            *out,
            F.coalesce(
                "_ruled", F.when(margin > 0, F.lit("block")).otherwise(F.lit("allow"))
            ).alias("verdict"),
            "block_score",
        )
    )


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read(spark, sf_dir, "pages"))

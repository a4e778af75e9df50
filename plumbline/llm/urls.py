"""URL filter: host rules first, and a character language-model ratio where no rule fits.

URLs that the rules accept and reject train a variable-order Markov model each. A character's probability
is interpolated from contexts of 0 to ``ORDER`` characters with Witten-Bell weights, so that a context
seen rarely counts little and an unseen one not at all. A URL's score is the difference of its
log-likelihoods per character; the threshold is calibrated on rule-judged URLs that trained neither model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.text import lower_ascii
from plumbline.session import materialise

ORDER = 3
#: Rule-judged URLs whose md5 begins with a lower hexadecimal digit calibrate the threshold.
CALIBRATION = "3"
#: Characters that an unseen one is taken to be one of.
ALPHABET = 256
#: Scores are counted in steps of 1 / STEPS, between -LARGEST and LARGEST, to find the threshold.
STEPS, LARGEST = 100, 6.0

BEGIN, END = "\u0002", "\u0003"

#: (host and path, verdict)
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased and path; both empty for null or without ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1))
    rest = F.coalesce(rest, F.lit(""))
    parts = r"(?s)^([^/?#]*)([^?#]*)"
    return lower_ascii(F.regexp_extract(rest, parts, 1)), F.regexp_extract(rest, parts, 2)


def rule_of(rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits ``host`` and ``path``; null if none does."""
    fits, verdicts = [], []
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        host, _, path = rule.partition("/")
        own = (F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))
        fit = own & F.startswith(F.col("path"), F.lit(f"/{path}"))
        fits.append(F.when(fit, F.lit(rule)))
        verdicts.append(F.when(fit, F.lit(verdict)))
    nothing = F.lit(None).cast("string")
    return F.coalesce(*fits, nothing), F.coalesce(*verdicts, nothing)


def _grams(urls: DataFrame, *columns: str) -> DataFrame:
    """The columns and, per character of the whole URL and the end, the character behind its context."""
    text = F.concat(F.lit(BEGIN * ORDER), "url", F.lit(END))
    placed = urls.select(*columns, F.split(text, "").alias("chars"))
    grams = F.transform(
        F.sequence(F.lit(1), F.size("chars") - ORDER), lambda i: F.array_join(F.slice("chars", i, ORDER + 1), "")
    )
    return placed.select(*columns, F.explode(grams).alias("gram"))


def _counts(urls: DataFrame) -> DataFrame:
    """(gram, accepted, rejected): how often each longest gram occurs in the training URLs."""
    return _grams(urls, "verdict").groupBy("gram").agg(
        F.count_if(F.col("verdict") == "allow").alias("accepted"),
        F.count_if(F.col("verdict") == "block").alias("rejected"),
    )


def log_ratios(counts: DataFrame, grams: DataFrame) -> DataFrame:
    """(gram, ratio): log of the accepted over the rejected probability of each gram's last character."""
    found = grams
    for side in ("accepted", "rejected"):
        found = found.withColumn(f"p_{side}", F.lit(1.0 / ALPHABET))
    for order in range(ORDER + 1):
        n = order + 1
        level = counts.groupBy(F.substring("gram", ORDER + 1 - order, n).alias("tail")).agg(
            *[F.sum(side).alias(side) for side in ("accepted", "rejected")]
        )
        context = level.groupBy(F.substring("tail", 1, order).alias("context")).agg(
            *[F.sum(side).alias(f"n_{side}") for side in ("accepted", "rejected")],
            *[F.count_if(F.col(side) > 0).alias(f"kinds_{side}") for side in ("accepted", "rejected")],
        )
        found = found.withColumn("tail", F.substring("gram", ORDER + 1 - order, n)).withColumn(
            "context", F.substring("tail", 1, order)
        ).join(level, "tail", "left").join(context, "context", "left")
        for side in ("accepted", "rejected"):
            own, seen, kinds = (F.coalesce(name, F.lit(0)) for name in (side, f"n_{side}", f"kinds_{side}"))
            smoothed = (own + kinds * F.col(f"p_{side}")) / F.greatest(seen + kinds, F.lit(1))
            found = found.withColumn(f"p_{side}", F.when(seen > 0, smoothed).otherwise(F.col(f"p_{side}")))
        found = found.select("gram", "p_accepted", "p_rejected")
    return found.select("gram", F.log(F.col("p_accepted") / F.col("p_rejected")).alias("ratio"))


def scored(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """(url, score) of distinct URLs; every gram has a ratio."""
    return _grams(urls, "url").join(ratios, "gram").groupBy("url").agg(F.avg("ratio").alias("score"))


def threshold(judged: DataFrame) -> float:
    """The score from which on URLs are accepted, best by the mean of both classes' shares.

    It lies halfway between two scores that occur, of equally good places the one closest to 0; 0 where
    one class is missing. ``judged`` has (score, verdict).
    """
    step = F.round(F.least(F.greatest("score", F.lit(-LARGEST)), F.lit(LARGEST)) * STEPS).cast("int")
    counted = judged.groupBy(step.alias("step")).agg(
        F.count_if(F.col("verdict") == "allow").alias("accepted"),
        F.count_if(F.col("verdict") == "block").alias("rejected"),
    ).orderBy("step").collect()  # at most 2 * STEPS * LARGEST + 1 rows
    all_accepted, all_rejected = (sum(row[side] for row in counted) for side in ("accepted", "rejected"))
    if not all_accepted or not all_rejected:
        return 0.0
    best, below_accepted, below_rejected = (-1.0, 0.0, 0.0), 0, 0
    previous = counted[0]["step"] - 1
    for row in counted:
        share = (all_accepted - below_accepted) / all_accepted + below_rejected / all_rejected
        at = (row["step"] + previous) / 2 / STEPS
        previous = row["step"]
        best = max(best, (share, -abs(at), at))
        below_accepted += row["accepted"]
        below_rejected += row["rejected"]
    return best[2]


def judge(
    pages: DataFrame, *, id_column: str = "page_id", url_column: str = "url",
    rules: tuple[tuple[str, str], ...] = RULES,
) -> DataFrame:
    """Of each row: its id, host, path, rule (null if none fits), verdict (allow or block), score.

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased, and the path
    what follows up to ``?``, ``#`` or the end; both are empty for null URLs and without ``://``. A rule fits its host and
    all subdomains where the path starts with its own; the longest wins. Where none fits, a score of at
    least the threshold allows. The score is that of the whole URL as it is, scheme, query and fragment included, and
    of the empty text for null. Distinct URLs train and calibrate, so repeated rows have no weight, and come back
    as often as they occur. Without rule-judged URLs of a kind all scores compare with 0. No
    pages give no rows. Other columns are not read.
    """
    url = F.coalesce(F.col(url_column).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_column).alias("id"), url.alias("url"))
    host, path = host_and_path(F.col("url"))
    rule, verdict = rule_of(rules)
    urls = rows.select("url").distinct().select("url", host.alias("host"), path.alias("path"))
    urls = materialise(urls.select("*", rule.alias("rule"), verdict.alias("verdict")), "urls")

    known = urls.where("verdict IS NOT NULL")
    held_out = F.substring(F.md5("url"), 1, 1) < CALIBRATION
    counts = materialise(_counts(known.where(~held_out)), "grams")
    grams = _grams(urls).distinct()
    ratios = materialise(log_ratios(counts, grams), "ratios")
    scores = materialise(scored(urls, ratios), "scores")

    at = threshold(scores.join(known.where(held_out), "url").select("score", "verdict"))
    judged = urls.join(scores, "url").select(
        "url", "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("score") >= at, "allow").otherwise("block")).alias("verdict"), "score",
    )
    return rows.join(judged, "url").select(F.col("id").alias(id_column), "host", "path", "rule", "verdict", "score")

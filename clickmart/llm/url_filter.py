"""URL filters: a character language-model ratio behind host rules.

Two smoothed variable-order Markov models (Witten-Bell interpolation of
orders 0 to ``ORDER``) are trained on accepted and on rejected addresses;
an address is rejected by the mean log-likelihood difference per character
against a threshold calibrated on held-out hosts: the hosts are split into
``SITE_FOLDS``, each scored by models of the others. Rules come first.

Everything is a DataFrame: the counts of runs of ``ORDER + 1`` characters
(combined before the shuffle) give all lower orders by their suffixes, the
log ratio is worked out once per distinct run by joins of count tables, and
an address is scored by a join of its runs with that table. Nothing of the
models passes through the driver, and they grow with the corpus. A run
that most addresses share is a skewed join key, which AQE splits.

Training labels. Given a table of labelled addresses, those train and the
rest do not. Without one, a few seed words are all that is known: an address
whose host has a word of ``REJECT_WORDS`` and that no rule allows is
rejected, one that a rule blocks trains nothing, and the rest are unlabelled.
By the scores of held-out hosts, those
nearer to the seeds' median score than to the unlabelled one are
suspects and train nothing, what is left is accepted. So an unwanted host without a seed word does not teach the
model that it is wanted, and is judged by its likeness to the seeds. Digits
are modelled as one symbol; each distinct address counts once.

Defined results: a null address, or one without ``://``, has an empty host
and path, fits no rule and is judged by the model like any other; without
rejected (or accepted) examples the model allows everything; where no cut
of the held-out hosts beats chance the threshold is 0, and it is never less; an address labelled both ways is rejected; labels of
addresses that no row has train as well, null ones do not; repeated rows
each get their own row; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, read_table, staged

#: Longest context in characters.
ORDER = 4
#: Parts the hosts are split into to score addresses by models that have not seen their host.
SITE_FOLDS = 4
#: Resolution of the calibration in nats per character, and the range it covers.
BIN, LOW, HIGH = 0.01, -10.0, 10.0
#: Size of the alphabet that order -1 spreads evenly over.
ALPHABET = 256

# Fixed values: (host, path prefix, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

# Seed words, in host names that are certainly unwanted.
REJECT_WORDS = (
    "adult ads adserver bet bets betting cam cams casino cheap dating escort gamble gambling jackpot loan loans "
    "lottery pill pills pharma poker porn replica sex slots spam torrent viagra warez xxx"
).split()


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path), empty without ``://``."""
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url.cast("string"), F.lit(""))
    return ascii_lower(F.regexp_extract(text, whole, 1)), F.regexp_extract(text, whole, 2)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r[:2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _runs(text: Column, order: int) -> Column:
    """Every run of ``order + 1`` characters, the first contexts padded."""
    padded = F.concat(F.lit("\u0002" * order), text, F.lit("\u0003"))

    def runs(chars: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(chars) - order)
        return F.transform(starts, lambda i: F.array_join(F.slice(chars, i, order + 1), ""))

    # one split bound to a name: a substring would walk the address again for every run
    return F.transform(F.array(F.split(padded, "")), runs)[0]


def run_ratios(runs: DataFrame, order: int = ORDER, alphabet: int = ALPHABET, by: tuple[str, ...] = ()) -> DataFrame:
    """(run, ratio): log P(last | rest) under rejected minus accepted, from counts (run, acc, rej).

    Runs with zero counts are backed off to the contexts that were seen.
    Columns ``by`` keep the counts of several models apart.
    """
    sides = ("acc", "rej")
    below = None
    for k in range(1, order + 2):
        grams = (
            runs.groupBy(*by, F.substring("run", -k, k).alias("g"))
            .agg(*[F.sum(s).alias(s) for s in sides])
            .withColumn("ctx", F.expr(f"substring(g, 1, {k - 1})"))
        )
        context = grams.groupBy(*by, "ctx").agg(
            *[F.sum(s).alias(f"{s}_n") for s in sides],
            *[F.sum((F.col(s) > 0).cast("long")).alias(f"{s}_kinds") for s in sides],
        )
        level = grams.join(context, [*by, "ctx"])
        if below is None:
            level = level.select("*", *[F.lit(1.0 / alphabet).alias(f"{s}_low") for s in sides])
        else:
            level = level.withColumn("tail", F.expr("substring(g, 2)")).join(
                below.select(*by, F.col("g").alias("tail"), *[F.col(f"{s}_p").alias(f"{s}_low") for s in sides]),
                [*by, "tail"],
            )
        below = level.select(
            *by,
            "g",
            *[
                F.when(
                    F.col(f"{s}_n") > 0,
                    (F.col(s) + F.col(f"{s}_kinds") * F.col(f"{s}_low")) / (F.col(f"{s}_n") + F.col(f"{s}_kinds")),
                ).otherwise(F.col(f"{s}_low")).alias(f"{s}_p")
                for s in sides
            ],
        )
    return below.select(*by, F.col("g").alias("run"), (F.log("rej_p") - F.log("acc_p")).alias("ratio"))


def _count(value: int, where: Column) -> Column:
    return F.sum(F.when((F.col("label") == value) & where, 1).otherwise(0))


def other_site_scores(addresses: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, label, score): each address scored by a model of the sites outside its own fold.

    ``addresses`` has key, address, label and site_fold; runs carry the short key. A run has a row in every
    model, with zero counts where only that fold has it.
    """
    runs = addresses.select("key", "label", "site_fold", F.explode(_runs(F.col("address"), order)).alias("run"))
    counts = runs.groupBy("site_fold", "run").agg(_count(0, F.lit(True)).alias("acc"), _count(1, F.lit(True)).alias("rej"))
    other = F.col("model") != F.col("site_fold")
    counts = (
        counts.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(SITE_FOLDS - 1)).cast("array<long>")))
        .groupBy("model", "run")
        .agg(*[F.sum(F.when(other, F.col(s)).otherwise(0)).alias(s) for s in ("acc", "rej")])
    )
    ratios = staged(run_ratios(staged(counts, "url-site-runs"), order, by=("model",)), "url-site-ratios")
    return (
        runs.withColumnRenamed("site_fold", "model")
        .join(ratios, ["model", "run"])
        .groupBy("key", "label")
        .agg(F.avg("ratio").alias("score"))
    )


#: Number of calibration cells.
BINS = int((HIGH - LOW) / BIN)


def _cells(scored: DataFrame) -> dict[int, tuple[int, int]]:
    """(rejected, accepted) per cell of the scores: at most one row per cell reaches the driver."""
    cell = F.least(F.greatest(F.floor((F.col("score") - LOW) / BIN), F.lit(0)), F.lit(BINS - 1))
    rows = scored.groupBy(cell.alias("cell")).agg(F.sum("label").alias("rej"), F.sum(1 - F.col("label")).alias("acc")).collect()
    return {int(r["cell"]): (r["rej"], r["acc"]) for r in rows}


def _threshold(scored: DataFrame) -> float:
    """The cut, not below 0, with the best balanced accuracy; of a range of best cuts its middle.

    0 where none beats chance, infinite without examples of both labels.
    """
    at = _cells(scored)
    rej, acc = (sum(n[i] for n in at.values()) for i in (0, 1))
    if not rej or not acc:
        return float("inf")
    best, cuts, caught, kept = 1.0, [], rej, 0
    for b in range(BINS):  # the cut before bin b: bins from b on are rejected
        value = caught / rej + kept / acc
        if LOW + BIN * b > -BIN / 2:
            if value > best + 1e-12:
                best, cuts = value, [b]
            elif cuts and value > best - 1e-12:
                cuts.append(b)
        caught, kept = caught - at.get(b, (0, 0))[0], kept + at.get(b, (0, 0))[1]
    return LOW + BIN * (cuts[0] + cuts[-1]) / 2 if cuts else 0.0


def _between_medians(scored: DataFrame) -> float:
    """Midway between the median scores of both labels, infinite if the rejected one is not the higher.

    Unlike the best cut it does not move for unwanted addresses among the
    accepted, as long as they are the smaller part.
    """
    at = sorted(_cells(scored).items())
    medians = []
    for side in (0, 1):
        half, so_far = sum(n[side] for _, n in at) / 2, 0
        for b, n in at:
            so_far += n[side]
            if half and so_far >= half:
                medians.append(b)
                break
    if len(medians) < 2 or medians[0] <= medians[1]:
        return float("inf")
    return LOW + BIN * (sum(medians) + 1) / 2


def _address(host: Column, path: Column) -> Column:
    return F.regexp_replace(F.concat(host, path), "[0-9]", "0")


def _seeded(rows: DataFrame, reject_words: tuple[str, ...]) -> DataFrame:
    """(address, label) of distinct addresses: seeds 1, unlabelled 0, blocked ones null."""
    words = F.split("host", "[^a-z0-9\u0080-\U0010ffff]")
    marked = F.arrays_overlap(words, F.array(*[F.lit(w) for w in reject_words]).cast("array<string>"))
    label = F.when(marked & ~F.col("ruled").eqNullSafe("allow"), 1).when(~marked & ~F.col("ruled").eqNullSafe("block"), 0)
    return rows.groupBy("address").agg(F.max(label).alias("label"))


def _given(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(address, label) of distinct addresses, from a table of (url, rejected)."""
    host, path = split_url(F.col("url"))
    known = labels.where("rejected is not null").select(
        _address(host, path).alias("address"), F.col("rejected").cast("int").alias("label")
    )
    rows = rows.select("address", F.lit(None).cast("int").alias("label"))
    return rows.unionByName(known).groupBy("address").agg(F.max("label").alias("label"))


def judge_urls(
    urls: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules=RULES,
    reject_words=tuple(REJECT_WORDS),
    labels: DataFrame | None = None,
    order: int = ORDER,
) -> DataFrame:
    """Per row: id, host, path, rule, verdict, score (mean log ratio per character), threshold, label.

    ``labels`` holds (url, rejected) to train on instead of the seed words.
    ``label`` is what the address trained as: 1 rejected, 0 accepted, else null.
    """
    host, path = split_url(F.col(url_col))
    rows = urls.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, ruled = rule_columns(F.col("host"), F.col("path"), rules)
    address = _address(F.col("host"), F.col("path"))
    rows = rows.select("id", "host", "path", rule.alias("rule"), ruled.alias("ruled"), address.alias("address"))

    labelled = _seeded(rows, reject_words) if labels is None else _given(rows, labels)
    site = F.crc32(F.encode(F.substring_index("address", "/", 1), "utf-8"))  # a host has no slash
    key = F.md5(F.encode("address", "utf-8"))
    first = staged(
        labelled.withColumn("site_fold", F.pmod(site, F.lit(SITE_FOLDS))).withColumn("key", key), "url-addresses"
    )
    held_out = staged(other_site_scores(first, order), "url-site-scores")
    if labels is None:
        cut = _between_medians(held_out.where("label is not null"))
        suspect = (F.col("label") == 0) & (F.col("score") > F.lit(cut))
        held_out = held_out.withColumn("label", F.when(~suspect, F.col("label")))
    cut = _threshold(held_out.where("label is not null"))

    trained = first.select("key", "address").join(held_out, "key")
    runs = trained.select("key", "label", F.explode(_runs(F.col("address"), order)).alias("run"))
    counts = runs.groupBy("run").agg(_count(0, F.lit(True)).alias("acc"), _count(1, F.lit(True)).alias("rej"))
    ratios = staged(run_ratios(staged(counts, "url-runs"), order), "url-ratios")
    scored = runs.join(ratios, "run").groupBy("key", "label").agg(F.avg("ratio").alias("score"))
    verdict = F.coalesce("ruled", F.when(F.col("score") > F.lit(cut), "block").otherwise("allow"))
    return rows.withColumn("key", key).join(scored, "key", "left").select(
        "id", "host", "path", "rule", verdict.alias("verdict"), "score", F.lit(cut).alias("threshold"), "label"
    )


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    rows = judge_urls(read_table(spark, sf_dir, "pages", "page_id", "url"))
    return rows.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))

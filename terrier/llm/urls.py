"""URL filters: fixed host rules first, then association rules mined from labels.

URLs become sets of tokens (host labels, path segments, query keys). FP-growth mines the
combinations that occur with a blocking label in a few rows at least, however many rows
have labels; where a blocked URL has more than ``LONGEST`` tokens to combine, combinations
grow token by token instead, only while they can still give a rule. Both ways give the
same rules. Rules are pruned by confidence, which must be surely above the base rate,
and a rule is dropped if a part of its combination is as confident. A rule is filed in
an inverted index under its rarest token only; the distinct token sets of the URLs meet
the index there and are checked for the other tokens.

Built-in functions and Spark ML only; no Python in the tasks.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.session import cut_lineage

#: Tokens of a blocked URL up to which all its combinations are mined (4,095 at most).
LONGEST = 12

# Host, path and verdict of the rules that come first.
HOST_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def with_parts(pages: DataFrame) -> DataFrame:
    """``host`` and ``path`` of ``url``; both empty for NULL or without ``://``."""
    url = F.coalesce("url", F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return pages.withColumns({
        "host": F.translate(F.regexp_extract(url, pattern, 1), upper, upper.lower()),
        "path": F.regexp_extract(url, pattern, 2)})


def host_rule(rules=HOST_RULES):
    """The longest rule that fits, as a struct of rule and verdict; NULL without one."""
    fits = F.lit(None)
    for host, path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        hit = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        fits = F.when(hit, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fits)
    return fits


def url_tokens():
    """Distinct sorted tokens of a row with ``host``, ``path`` and ``url``."""
    query = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)\?([^#]*)", 1)
    named = lambda kind, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    segments = F.transform(F.split("path", "/"), lambda x: F.regexp_replace(x, "[0-9]+", "0"))
    keys = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^([^=]*)", 1))
    return F.array_sort(F.array_distinct(F.concat(named("host:", F.split("host", r"\.")), named("path:", segments), named("key:", keys))))


def lower_bound(hits, rows):
    """The share of ``hits`` that is at least so high with 95% (Wilson's bound)."""
    z = 1.645
    share = hits / rows
    return (share + z * z / (2 * rows) - z * F.sqrt(share * (1 - share) / rows + z * z / (4 * rows * rows))) / (1 + z * z / rows)


def mined(sets: DataFrame, alone: DataFrame, same: DataFrame, least: int) -> DataFrame:
    """tokens, hits and n of all combinations in ``least`` blocked rows, by FP-growth over these."""
    spark = sets.sparkSession
    rows = sets.where("blocked").select("items", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).select("items")
    size = rows.count()
    if size < least:
        return spark.createDataFrame([], "tokens array<string>, hits long, n long")
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / size, minConfidence=1.0).fit(rows)
    found = cut_lineage(model.freqItemsets.select(F.array_sort("items").alias("tokens"), F.col("freq").alias("hits")), "url-found")
    counts = same.select(F.col("item").alias("part"), "n")
    found = found.withColumn("part", F.explode("tokens")).join(counts, "part").groupBy("tokens", "hits").agg(F.min(F.struct("n", "part"))["part"].alias("rare"))
    # The rows of a combination: sets that hold its rarest item and the others.
    among = sets.select(F.explode("items").alias("rare"), "items", "rows")
    return found.join(among, "rare").where(F.size(F.array_except("tokens", "items")) == 0).groupBy("tokens", "hits").agg(F.sum("rows").alias("n"))


def grown(sets: DataFrame, alone: DataFrame, same: DataFrame, least: int) -> DataFrame:
    """tokens, hits and n of the combinations that can give a rule, grown token by token.

    A combination whose rows are all blocked is not grown: its rule is as confident as any
    with more tokens. Nor is one with the same rows as a part of it: the part has the same
    rule, also with more tokens. What is left out would be pruned, so rules stay whole.
    """
    held = cut_lineage(sets.withColumn("set", F.monotonically_increasing_id()), "url-sets")
    at = held.select("set", F.explode("items").alias("item")).select("set", F.array("item").alias("tokens"))
    level, found = alone, alone
    while True:
        after = F.filter("items", lambda x: x > F.element_at(F.col("tokens"), -1))
        wider = at.join(held, "set").withColumn("item", F.explode(after))
        wider = wider.select("set", "blocked", "rows", F.concat("tokens", F.array("item")).alias("tokens"))
        counts = wider.groupBy("tokens").agg(F.sum(F.when(F.col("blocked"), F.col("rows")).otherwise(0)).alias("hits"), F.sum("rows").alias("n"))
        counts = cut_lineage(counts.where(F.col("hits") >= least), "url-counts")
        part = F.explode(F.transform("tokens", lambda x: F.filter("tokens", lambda y: y != x))).alias("part")
        parts = level.select(F.col("tokens").alias("part"), F.col("n").alias("wide"))
        free = counts.select("tokens", "n", part).join(parts, "part").where("wide > n").groupBy("tokens").count().where(F.col("count") == F.size("tokens"))
        made = cut_lineage(counts.join(free.select("tokens"), "tokens"), "url-level")
        if not made.head(1):
            return found
        found, level = found.unionByName(made), made.where("hits < n")
        at = cut_lineage(wider.join(level.select("tokens"), "tokens", "left_semi").select("set", "tokens"), "url-places")


def mine(labelled: DataFrame, least: int, confidence: float) -> DataFrame:
    """Pruned rules (need, confidence, rare) from ``tokens`` and a boolean ``blocked``.

    A rule is a combination that at least ``least`` blocked rows have, whose share of
    blocked rows is ``confidence`` or more and surely above the share among all labelled
    rows. Tokens of the same labelled rows are one item while mining; ``need`` has the
    tokens of each item, of which one must be there. An item without an unblocked row is a
    rule alone, and no combination with it can be more confident, so it is not mined.
    ``rare`` holds the tokens of the rule's rarest item. Without labels there are no rules.
    """
    spark = labelled.sparkSession
    none = spark.createDataFrame([], "need array<array<string>>, confidence double, rare array<string>")
    rows = cut_lineage(labelled.where(F.size("tokens") > 0).select(F.monotonically_increasing_id().alias("row"), "tokens", "blocked"), "url-rows")
    every, bad = rows.agg(F.count("*"), F.count(F.when(F.col("blocked"), 1))).first()
    if bad < least:
        return none
    held = rows.select("row", "blocked", F.explode("tokens").alias("part"))
    mark = F.xxhash64("row")
    seen = held.groupBy("part").agg(F.count("*").alias("n"), F.count(F.when(F.col("blocked"), 1)).alias("bad"),
                                    F.sum(mark.cast("decimal(38,0)")).alias("s"), F.bit_xor(mark).alias("x")).where(F.col("bad") >= least)
    same = seen.groupBy("n", "bad", "s", "x").agg(F.min("part").alias("item"), F.array_sort(F.collect_set("part")).alias("parts"))
    same = cut_lineage(same.select("item", "parts", "n", F.col("bad").alias("hits")), "url-tokens")
    named = same.where("hits < n").select("item", F.explode("parts").alias("part"))
    sets = held.join(named, "part").groupBy("row", "blocked").agg(F.array_sort(F.collect_set("item")).alias("items"))
    sets = cut_lineage(sets.groupBy("items", "blocked").agg(F.count("*").alias("rows")), "url-items")
    alone = same.select(F.array("item").alias("tokens"), "hits", "n")
    longest = sets.where("blocked").agg(F.max(F.size("items"))).first()[0] or 0
    joint = (mined if longest <= LONGEST else grown)(sets, alone.where("hits < n"), same, least)
    found = alone.where("hits = n").unionByName(joint).withColumn("confidence", F.col("hits") / F.col("n"))
    found = found.where((F.col("confidence") >= confidence) & (lower_bound(F.col("hits"), F.col("n")) > bad / every))
    counts = same.select(F.col("item").alias("part"), F.col("n").alias("rows"))
    found = found.withColumn("part", F.explode("tokens")).join(counts, "part").groupBy("tokens", "confidence").agg(F.min(F.struct("rows", "part"))["part"].alias("rare"))
    found = cut_lineage(found, "url-rules")
    # A rule meets those whose first item it has; shorter ones inside it prune it.
    general = found.select(F.col("tokens")[0].alias("part"), F.col("tokens").alias("less"), F.col("confidence").alias("same"))
    pruned = found.withColumn("part", F.explode("tokens")).join(general, "part").where(
        (F.size("less") < F.size("tokens")) & (F.size(F.array_except("less", "tokens")) == 0) & (F.col("same") >= F.col("confidence"))).select("tokens").distinct()
    kept = found.join(pruned, "tokens", "left_anti").withColumn("item", F.explode("tokens")).join(same.select("item", "parts"), "item")
    return kept.groupBy("tokens", "confidence").agg(
        F.collect_list("parts").alias("need"), F.max(F.when(F.col("item") == F.col("rare"), F.col("parts"))).alias("rare")).select("need", "confidence", "rare")


def judge(pages: DataFrame, labels: DataFrame, least: int = 3, confidence: float = 0.6) -> DataFrame:
    """page_id, host, path, rule and verdict for every row of ``pages``.

    The longest host rule decides; where none fits, a URL is blocked if a mined rule
    matches and allowed otherwise, so NULL and empty URLs are allowed. A page's labels are
    those of its id: a page of quality 0 or a toxic one teaches blocking; ids with several
    labels count once, blocking first. Repeated rows are judged alike, each kept. Extra
    columns are not read.

    Distinct token sets are formed before the index is met, so copies of a URL cost one
    row; blocked sets are joined back with a left join, which Spark splits where one set
    holds many rows.
    """
    rows = with_parts(pages.select("page_id", "url")).withColumns({"fits": host_rule(), "tokens": url_tokens()}).drop("url")
    marks = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"))
    labelled = rows.join(marks.where(F.col("blocked").isNotNull()), "page_id").select("tokens", "blocked")
    rules = mine(labelled, least, confidence)
    sets = rows.where(F.col("fits").isNull()).select("tokens").distinct()
    met = sets.withColumn("rare", F.explode("tokens")).join(rules.select(F.explode("rare").alias("rare"), "need"), "rare")
    blocked = met.where(F.forall("need", lambda parts: F.arrays_overlap(parts, F.col("tokens")))).select("tokens").distinct().withColumn("blocked", F.lit(True))
    return rows.join(blocked, "tokens", "left").select(
        "page_id", "host", "path", F.col("fits")["rule"].alias("rule"),
        F.coalesce(F.col("fits")["verdict"], F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"))

"""URL filters: given host and path rules first, then association rules mined from labelled addresses.

An address becomes a set of items: its host's labels, path segments, the words of both, file ending, query keys. Items that
occur in exactly the same labelled addresses are one class, of which an address needs any member; so long paths that many
addresses share don't multiply item sets. Spark's FP-growth mines the sets of classes of labelled addresses together with the
label; a rule is ``classes -> bad`` with at least MIN_ROWS bad rows, MIN_CONFIDENCE and MIN_LIFT, and no rule with fewer of
the same classes and at least its confidence. None of these limits depends on the number of rows. Rules are matched through an
inverted index: each is filed under its rarest class, and only addresses with that class are tried. Addresses with
equal items are judged once.

Defined results: a null address, or one without ``://``, has no host, path or items and is allowed; null labels
are left out; repeated rows are judged alike; other columns are not returned; without labels there are no mined rules.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.staging import settled

MIN_ROWS = 20  # bad rows that a mined rule fits
MIN_CONFIDENCE = 0.6
MIN_LIFT = 1.1  # over the share of bad rows among all labelled ones
BAD = "=bad"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: verdict, host and path of the given rules
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), "(?s)^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), "(?s)^[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        own_host, slash, rest = text.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def items(url: Column) -> Column:
    """The items of an address, each once and in order. Numbers stand for any number."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(after_scheme(url), "(?s)^[^?#]*\\?([^#]*)", 1)
    named = lambda kind, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    plain = lambda part: F.regexp_replace(F.lower(part), "\\d+", "0")
    whole = F.concat(F.split(host, "\\."), F.split(path, "/"))
    # Words of what is no single word, where a label or segment by itself would be the same item again.
    words = F.flatten(F.transform(F.filter(whole, lambda x: x.rlike("[^A-Za-z0-9]")), lambda x: F.split(plain(x), "[^\\p{L}\\p{N}]+")))
    found = F.concat(
        named("host:", F.split(host, "\\.")), named("path:", F.transform(F.split(path, "/"), plain)), named("word:", words),
        named("ending:", F.array(F.regexp_extract(path, "\\.([A-Za-z0-9]{1,5})$", 1))),
        named("key:", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))))
    return F.array_sort(F.array_distinct(F.coalesce(found, F.array().cast("array<string>"))))


def classes(labelled: DataFrame) -> DataFrame:
    """``item, class`` from rows ``id, items``: the class is the least of the items that occur in the same rows."""
    marks = labelled.select("id", F.explode("items").alias("item")).groupBy("item").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("one"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("two"))
    least = marks.groupBy("n", "one", "two").agg(F.min("item").alias("class"))
    return settled(marks.join(least, ["n", "one", "two"]).select("item", "class"), "url-classes")


def _needed(rules: DataFrame) -> DataFrame:
    """The rules without those of which a part is as sure: ``items, both, confidence, lift`` of all frequent sets, by growing size.

    Every part of a frequent set is one, so a set only looks at those with one item less, which know the best of theirs.
    """
    sizes = rules.agg(F.max(F.size("items"))).first()[0] or 0
    level, kept = None, []
    for size in range(1, sizes + 1):
        own = rules.where(F.size("items") == size)
        best = F.lit(-1.0)
        if level is not None:
            parts = own.select("items", F.explode("items").alias("item")).select("items", F.array_remove("items", F.col("item")).alias("part"))
            known = parts.join(level.select(F.col("items").alias("part"), F.greatest("confidence", "best").alias("sure")), "part")
            own, best = own.join(known.groupBy("items").agg(F.max("sure").alias("best")), "items"), F.col("best")
        level = settled(own.select("items", "both", "confidence", "lift", best.alias("best")), "url-level")
        kept.append(level.where("confidence > best"))
    found = rules.where(F.lit(False)) if not kept else kept[0]
    for more in kept[1:]:
        found = found.unionByName(more)
    return found.where((F.col("confidence") >= MIN_CONFIDENCE) & (F.col("lift") >= MIN_LIFT))


def mined(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``items, support, confidence, key`` of the rules from rows ``items, bad``, by classes; ``key`` is the rarest. And the classes."""
    labelled = settled(labelled.where("bad is not null").select("items", "bad", F.monotonically_increasing_id().alias("id")), "url-labels")
    of = classes(labelled)
    rows, bad = labelled.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    if bad < MIN_ROWS:
        schema = "items array<string>, support double, confidence double, key string"
        return labelled.sparkSession.createDataFrame([], schema), of
    held = labelled.select("id", "bad", F.explode_outer("items").alias("item")).join(of, "item", "left")
    baskets = held.groupBy("id", "bad").agg(F.collect_set("class").alias("items"))
    baskets = baskets.select(F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items"))
    # Half a row less, so that rounding cannot ask for one row more.
    model = FPGrowth(itemsCol="items", minSupport=(MIN_ROWS - 0.5) / rows).fit(settled(baskets, "url-baskets"))
    often = settled(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "url-often")
    with_bad = often.where(F.array_contains("items", BAD) & (F.size("items") > 1)).select(
        F.array_remove("items", BAD).alias("items"), F.col("freq").alias("both"))
    sure = F.col("both") / F.col("freq")
    rules = settled(with_bad.join(often, "items").select("items", "both", sure.alias("confidence"), (sure * rows / bad).alias("lift")), "url-rules")
    found = _needed(rules)
    single = often.where("size(items) = 1").select(F.element_at("items", 1).alias("item"), "freq")
    keyed = found.select("items", F.explode("items").alias("item")).join(single, "item").groupBy("items").agg(F.min(F.struct("freq", "item")).alias("least"))
    index = found.join(keyed.select("items", F.col("least.item").alias("key")), "items")
    return settled(index.select("items", (F.col("both") / rows).alias("support"), "confidence", "key"), "url-index"), of


def fired(baskets: DataFrame, index: DataFrame, of: DataFrame) -> DataFrame:
    """``items, confidence`` of the sets of items (each once) that some rule fits, with the surest rule's confidence."""
    held = baskets.select("items", F.explode("items").alias("item")).join(of, "item").groupBy("items").agg(F.collect_set("class").alias("held"))
    tried = held.select("items", "held", F.explode("held").alias("key")).join(index.select(F.col("items").alias("part"), "confidence", "key"), "key")
    return tried.where(F.size(F.array_except("part", "held")) == 0).groupBy("items").agg(F.max("confidence").alias("confidence"))


def judged(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, confidence``. ``labels``: ``page_id, bad``.

    Labels with several rows for a page count as bad if one of them does.
    """
    held = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), items(F.col("url")).alias("items"))
    held = held.withColumn("host", F.coalesce("host", F.lit(""))).withColumn("path", F.coalesce("path", F.lit("")))
    marks = labels.groupBy("page_id").agg(F.max("bad").alias("bad"))
    index, of = mined(held.join(marks, "page_id").select("items", "bad"))
    known = settled(fired(held.select("items").distinct(), index, of), "url-verdicts")
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    found = held.join(known, "items", "left")
    mine = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return found.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, mine).alias("verdict"), "confidence")

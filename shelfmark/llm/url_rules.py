"""URL filters: association rules mined from labelled pages, matched by an inverted index.

Only DataFrame functions and Spark's own FP-growth are used.

A URL becomes a basket of items read from the whole URL: attributes of fixed
place (`ATTRIBUTES`), and all host labels, folders, words inside them, query keys
and query values. Items that too few blocked pages have are dropped first, by an
absolute count, and so are items that all labelled pages have. Items that always
occur together are one item with several names. FP-growth then gives the
combinations of any length with their counts on blocked pages and on all; count
and confidence prune the rules `itemset -> block`. A rule is filed in the index
under its rarest item, so a basket meets only the rules of its own rare items,
and is then checked in full.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: First `://`, then the host up to `/`, `?` or `#`, then the path up to `?` or `#`.
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

ATTRIBUTES = ("scheme", "host", "domain", "tld", "sub", "first", "last", "dir1", "dir2", "ext", "query")
#: Share of the labelled pages that must bear a rule out besides `MIN_COUNT`; none, so the bar does not rise with the table.
MIN_SUPPORT = 0.0
#: Blocked pages that must bear a rule out, however few or many pages are labelled: the least support.
MIN_COUNT = 10
#: Bytes of rules up to which they are broadcast to the pages.
BROADCAST_BYTES = 32 << 20
MIN_CONFIDENCE = 0.6
#: The item of blocked pages; no URL gives it, as all others have a sign of equality.
BLOCK = "block"


@dataclass(frozen=True)
class Rule:
    """A listed verdict for a host with all its subdomains, for paths that start with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Host with A-Z lower-cased; empty for a null URL or one without `://`."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Path up to `?`, `#` or the end; empty for a null URL or one without `://`."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def listed_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, else null; of equal lengths the first by name.

    The list is a parameter of the call and becomes part of the expression.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(
            fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        ).otherwise(found)
    return found


def basket(url: Column) -> Column:
    """Sorted items of a whole URL, such as `tld=org` or `dir=news`; absent attributes give none."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    name = F.when(F.size(labels) > 1, F.element_at(labels, -2)).otherwise(host)
    words = F.split(name, "-")
    folders = F.split(path, "/")

    def part(parts: Column, i: int) -> Column:
        return F.when(F.size(parts) >= abs(i), F.element_at(parts, i)).otherwise("")

    values = {
        "scheme": F.translate(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1), _UPPER, _LOWER),
        "host": host,
        "domain": F.when(F.size(labels) > 2, F.array_join(F.slice(labels, -3, 3), ".")).otherwise(host),
        "tld": F.when(F.size(labels) > 1, part(labels, -1)).otherwise(""),
        "sub": F.when(F.size(labels) > 2, part(labels, 1)).otherwise(""),
        "first": F.when(F.size(labels) > 2, F.element_at(F.split(F.element_at(labels, -3), "-"), 1)).otherwise(part(words, 1)),
        "last": F.when(F.size(labels) > 2, F.element_at(F.split(F.element_at(labels, -3), "-"), -1)).otherwise(part(words, -1)),
        "dir1": part(folders, 2),
        "dir2": part(folders, 3),
        "ext": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1),
        "query": F.regexp_extract(url, r"\?([^=&#]*)", 1),
    }
    items = F.array(*(F.when(values[k] != "", F.concat(F.lit(k + "="), values[k])) for k in ATTRIBUTES))

    def every(name: str, parts: Column) -> Column:
        named = F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(name + "="), x))
        return F.coalesce(named, F.array().cast("array<string>"))

    def words_in(parts: Column, sign: str) -> Column:
        """Words of the parts that hold several."""
        return F.flatten(F.transform(F.filter(parts, lambda x: F.rlike(x, F.lit(sign))), lambda x: F.split(x, sign)))

    pairs = F.split(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), "[&;]")
    rest = F.concat(
        every("label", labels),
        every("hostword", words_in(labels, "-")),
        every("dir", F.slice(folders, 2, F.greatest(F.size(folders), F.lit(0)))),
        every("word", words_in(folders, r"[^\p{L}\p{N}]+")),
        every("key", F.transform(pairs, lambda x: F.regexp_extract(x, "(?s)^([^=]*)", 1))),
        every("value", F.transform(pairs, lambda x: F.regexp_extract(x, "(?s)=(.*)$", 1))),
        every("arg", F.filter(pairs, lambda x: x.contains("="))),
    )
    return F.sort_array(F.array_distinct(F.concat(F.array_compact(items), rest)))


def labelled_baskets(pages: DataFrame, blocked: DataFrame) -> DataFrame:
    """Baskets of the pages whose `page_id` is in `blocked` (page_id, block); a page with any block label is blocked."""
    labels = blocked.where("page_id IS NOT NULL").groupBy("page_id").agg(F.max("block").alias("block"))
    return pages.select("page_id", basket(F.col("url")).alias("items")).join(labels, "page_id").select("items", "block")


RULE = "rule_id string, items array<string>, members array<array<string>>, key string, confidence double, support double"


def _classes(rows: DataFrame, bar: float, total: int) -> DataFrame:
    """(item, rep, n, b): items that at least `bar` blocked pages have, and the least name of those on the same pages.

    Pages are compared by their number and two sums of their hashes.
    """
    page = [F.xxhash64("id", F.lit(salt)).cast("decimal(38,0)") for salt in (1, 2)]
    items = rows.select("n", "b", *(h.alias(f"h{i}") for i, h in enumerate(page)), F.explode("items").alias("item"))
    counts = items.groupBy("item").agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.sum("h0").alias("h0"), F.sum("h1").alias("h1"))
    counts = materialize(counts.where((F.col("b") >= bar) & (F.col("n") < total)), "url-items")
    reps = counts.groupBy("n", "b", "h0", "h1").agg(F.min("item").alias("rep"))
    return materialize(counts.join(reps, ["n", "b", "h0", "h1"]).select("item", "rep", "n", "b"), "url-items")


def mine(
    baskets: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """Rules (`RULE`) that lead to the block item.

    `items` names each part of a rule by one item, `members` lists all names of
    it. A rule bears at least `min_count` blocked pages, and at least
    `min_support` of all. Of itemsets on the same labelled pages the least parts
    are given, and none that only narrows a rule of confidence 1: a matcher that
    takes the most confident needs no others. No baskets give no rules. The
    labelled pages, cut to their frequent items, are what FP-growth holds in
    memory; its combinations grow with the items that pages share without always
    sharing them.
    """
    spark = baskets.sparkSession
    rows = baskets.groupBy("items").agg(F.count("*").alias("n"), F.sum(F.col("block").cast("long")).alias("b"))
    rows = materialize(rows.withColumn("id", F.monotonically_increasing_id()), "url-baskets")
    total = rows.agg(F.sum("n").alias("n")).first().n or 0
    bar = max(min_count, min_support * total)
    classes = _classes(rows, bar, total)
    if not classes.limit(1).count():
        return spark.createDataFrame([], RULE)
    # a page with an item of confidence 1 needs no longer rule with it
    sure = classes.where("n = b")
    open_items = classes.where("n > b AND item = rep").select("item")
    held = rows.select("id", "n", "b", F.explode("items").alias("item")).join(open_items, "item")
    held = held.groupBy("id").agg(F.collect_set("item").alias("items"), F.first("n").alias("n"), F.first("b").alias("b"))
    each = F.concat(F.array_repeat(F.lit(True), F.col("b").cast("int")), F.array_repeat(F.lit(False), (F.col("n") - F.col("b")).cast("int")))
    pages = held.select("items", F.explode(each).alias("block"))
    pages = materialize(pages.select(F.when(F.col("block"), F.array_append("items", F.lit(BLOCK))).otherwise(F.col("items")).alias("items")), "url-baskets")
    n_pages = pages.count()
    single = sure.where("item = rep").select(F.array("rep").alias("items"), "n", "b")
    if n_pages:
        # half a page below the bar, so that rounding up gives the bar itself
        model = FPGrowth(itemsCol="items", minSupport=max(0.0, (bar - 0.5) / n_pages)).fit(pages)
        sets = materialize(model.freqItemsets, "url-itemsets")
        with_block = F.array_contains("items", BLOCK)
        n = sets.where(~with_block).select(F.array_sort("items").alias("items"), F.col("freq").alias("n"))
        b = sets.where(with_block & (F.size("items") > 1)).select(
            F.array_sort(F.array_remove("items", BLOCK)).alias("items"), F.col("freq").alias("b")
        )
        found = materialize(n.join(b, "items"), "url-itemsets")
        # on fewer pages than each of its parts, and no part on blocked pages alone
        parts = found.where(F.size("items") > 1).select("items", "n", F.explode("items").alias("out"))
        parts = parts.select("items", "n", F.array_remove("items", F.col("out")).alias("part"))
        wider = found.select(F.col("items").alias("part"), F.col("n").alias("of"), F.col("b").alias("of_b"))
        idle = parts.join(wider, "part").where("n = of OR of = of_b").select("items").distinct()
        found = found.join(idle, "items", "left_anti").select("items", "n", "b").unionByName(single)
    else:
        found = single
    rules = found.where(F.col("b") / F.col("n") >= min_confidence).select(
        F.array_join("items", " ").alias("rule_id"), "items",
        (F.col("b") / F.col("n")).alias("confidence"), (F.col("b") / F.lit(total)).alias("support"),
    )
    names = classes.groupBy("rep").agg(F.sort_array(F.collect_list("item")).alias("names"), F.first("n").alias("freq"))
    parts = rules.select("rule_id", "items", "confidence", "support", F.posexplode("items").alias("at", "rep")).join(names, "rep")
    filed = parts.groupBy("rule_id", "items", "confidence", "support").agg(
        F.sort_array(F.collect_list(F.struct("at", "names"))).alias("listed"), F.min_by("rep", F.struct("freq", "rep")).alias("key")
    )
    members = F.transform("listed", lambda x: x["names"])
    return materialize(filed.withColumn("members", members).select(*(c.split()[0] for c in RULE.split(", "))), "url-rules")


def judge(pages: DataFrame, rules: DataFrame, listed: list[Rule]) -> DataFrame:
    """Every row of `pages` as (page_id, host, path, rule, verdict, mined_rule, confidence).

    A listed rule decides; else a page is blocked if a mined rule fires, the
    most confident named, ties by name. Equal URLs are matched once. A null or
    malformed URL has an empty host and path and is allowed.
    """
    urls = pages.select("url").where("url IS NOT NULL").distinct()
    size = rules.agg(F.sum(F.octet_length(F.to_json("members"))).alias("n")).first().n or 0
    place = F.array_position("items", F.col("key")).cast("int") - 1
    index = rules.select(F.explode(F.get("members", place)).alias("key"), "members", "rule_id", "confidence")
    fired = (
        urls.select("url", basket(F.col("url")).alias("have"))
        .select("url", "have", F.explode("have").alias("key"))
        .join(F.broadcast(index) if size <= BROADCAST_BYTES else index, "key")
        .where(F.forall("members", lambda names: F.arrays_overlap(names, F.col("have"))))
        .groupBy("url")
        .agg(F.min(F.struct((-F.col("confidence")).alias("c"), F.col("rule_id").alias("mined_rule"))).alias("m"))
        .select("url", "m.mined_rule", (-F.col("m.c")).alias("confidence"))
    )
    url = F.col("url")
    return (
        pages.select("page_id", "url")
        .join(fired, "url", "left")
        .select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), "mined_rule", "confidence")
        .withColumn("found", listed_rule(F.col("host"), F.col("path"), listed))
        .select(
            "page_id",
            "host",
            "path",
            F.col("found.rule").alias("rule"),
            F.coalesce(
                F.col("found.verdict"), F.when(F.col("mined_rule").isNull(), "allow").otherwise("block")
            ).alias("verdict"),
            "mined_rule",
            "confidence",
        )
    )

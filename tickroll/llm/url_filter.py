"""URL filters (operator 10): host and path rules, and association rules from labels.

A url is judged by the longest fitting list rule (host with all subdomains,
path prefix). Where none fits, mined rules decide: Spark's FP-growth finds
combinations of url tokens that occur with the label *bad* (tokens of the same
labelled pages are merged first); rules are pruned
by support and confidence, and a longer rule goes if a shorter one inside it
is as sure. Rules are matched by an inverted index: each rule is filed under
its rarest token, a page looks its tokens up, and the few rules found are
checked against the page's token set, one row per page and rule.

Only DataFrame operations and Spark ML run. The urls are scanned once; the
page text is never read.

Defined cases: a NULL url, or one without ``://``, has an empty host and path,
no tokens and the verdict allow; repeated rows and NULL ids are judged row by
row; without labelled pages there are no mined rules; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickroll.llm.common import stage

# host, path, verdict; the longest fitting rule wins
LIST_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
              ("com", "/fr/", "allow"), ("com", "/de/", "block")]
MIN_SUPPORT = 0.002     # share of the labelled pages that have all tokens of a rule and the label
MIN_PAGES = 5           # and at least so many of them
MIN_CONFIDENCE = 0.75
BAD = "label:bad"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def list_rule(host: Column, path: Column, rules=LIST_RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, else NULL."""
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        said = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, said) if out is None else out.when(fits, said)
    return out


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: scheme, host labels, path words, query keys. Numbers become ``#``."""
    plain = lambda words: F.transform(F.filter(words, lambda w: w != ""), lambda w: F.regexp_replace(w, "[0-9]+", "#"))
    scheme = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    parts = F.concat(
        F.transform(plain(F.array(scheme)), lambda w: F.concat(F.lit("scheme:"), w)),
        F.transform(plain(F.split(host, r"\.")), lambda w: F.concat(F.lit("host:"), w)),
        F.transform(plain(F.split(F.lower(path), r"[/._-]")), lambda w: F.concat(F.lit("path:"), w)),
        F.transform(plain(F.transform(F.split(query, "&"), lambda w: F.regexp_extract(w, "(?s)^[^=]*", 0))),
                    lambda w: F.concat(F.lit("query:"), w)))
    return F.when(url.contains("://"), F.array_distinct(parts)).otherwise(F.array().cast("array<string>"))


def parsed(pages: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """row, page_id, host, path, tokens, rule (struct or NULL); written once."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("_u"))
    rows = rows.withColumn("host", host_of(F.col("_u"))).withColumn("path", path_of(F.col("_u")))
    return stage(rows.select(F.monotonically_increasing_id().alias("row"), "page_id", "host", "path",
                             tokens_of(F.col("_u"), F.col("host"), F.col("path")).alias("tokens"),
                             list_rule(F.col("host"), F.col("path")).alias("listed")), "url-tokens")


def merged_tokens(labelled: DataFrame, least: float, base_decides: bool) -> DataFrame:
    """``(token, item)``: tokens that the same labelled pages have are one item, named by the least of them.

    Rules can't tell such tokens apart, and a combination of k of them would
    be 2^k itemsets. Page sets are compared by their size and two hashes of
    64 bits or more. Tokens of fewer than ``least`` pages are in no rule; nor is
    one that every page has, unless the base rate alone is sure enough.
    """
    n = labelled.count()
    sets = (labelled.select("id", F.explode("tokens").alias("token")).groupBy("token")
            .agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"),
                 F.sum(F.xxhash64(F.lit("second"), "id").cast("decimal(38,0)")).alias("s"))
            .filter((F.col("n") >= least) & (F.lit(base_decides) | (F.col("n") < n))))
    sets = stage(sets, "url-token-sets")
    names = sets.groupBy("n", "x", "s").agg(F.min("token").alias("item"))
    return stage(sets.join(names, ["n", "x", "s"]).select("token", "item"), "url-items")


def as_items(pages: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """``(key, tokens)``: the distinct items of each page that has some."""
    return (pages.select(key, F.explode("tokens").alias("token")).join(items, "token")
            .groupBy(key).agg(F.collect_set("item").alias("tokens")))


def _filed(rules: DataFrame, counts: DataFrame) -> DataFrame:
    """The rules with ``token``, the rarest of their tokens by ``counts``: the inverted index."""
    rows = rules.withColumn("_id", F.concat_ws(" ", "tokens")).select("_id", "tokens", "confidence", F.explode("tokens").alias("token"))
    return (rows.join(counts, "token", "left").groupBy("_id", "tokens", "confidence")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("least"))
            .select(F.col("tokens").alias("_rule"), F.col("confidence").alias("_sure"), F.col("least.token").alias("token")))


def _token_counts(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def mine_items(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_pages: int = MIN_PAGES,
               min_confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """The pruned rules over items, ``(tokens, confidence, support)``, and the items (see ``merged_tokens``).

    ``labelled`` has ``tokens`` and ``bad``, one row per labelled page.
    """
    spark = labelled.sparkSession
    # numbered as written: page sets and support then speak of the same rows
    labelled = stage(labelled.select(F.monotonically_increasing_id().alias("id"), "tokens", "bad"), "url-labelled")
    n, n_bad = labelled.agg(F.count(F.lit(1)), F.count(F.when(F.col("bad"), 1))).first()
    if not n:
        return (spark.createDataFrame([], "tokens array<string>, confidence double, support double"),
                spark.createDataFrame([], "token string, item string"))
    support = min(1.0, max(min_support, min_pages / n))
    items = merged_tokens(labelled, int(support * n), n_bad / n >= min_confidence)
    sets = labelled.select("id", "bad").join(as_items(labelled, items, "id"), "id", "left").select(
        F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"), "bad")
    # label and rule must reach the support together, so only tokens of bad pages can matter
    marked = sets.select(F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(marked)
    found = (model.associationRules.filter(F.col("consequent") == F.array(F.lit(BAD)))
             .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"))
    found = stage(found, "url-rules").withColumn("rule", F.concat_ws(" ", "tokens"))
    # a rule is redundant if a shorter one inside it is as sure; the shorter is looked up by its rarest token
    inner = _filed(found, _token_counts(found))
    inside = (found.select("rule", "tokens", "confidence", F.explode("tokens").alias("token")).join(inner, "token")
              .filter((F.size("_rule") < F.size("tokens")) & (F.col("_sure") >= F.col("confidence"))
                      & (F.size(F.array_except("_rule", "tokens")) == 0)).select("rule").distinct())
    return stage(found.join(inside, "rule", "left_anti").select("tokens", "confidence", "support"), "url-pruned"), items


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_pages: int = MIN_PAGES,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``(tokens, confidence, support)`` of the pruned rules *tokens => bad*, each item written out as each of its tokens."""
    rules, items = mine_items(labelled, min_support, min_pages, min_confidence)
    named = items.groupBy("item").agg(F.array_sort(F.collect_list("token")).alias("names"))
    each = (rules.withColumn("rule", F.concat_ws(" ", "tokens")).select("rule", "confidence", "support", F.explode("tokens").alias("item"))
            .join(named, "item").groupBy("rule", "confidence", "support").agg(F.collect_list("names").alias("names")))
    start = F.array(F.array().cast("array<string>"))
    combined = F.aggregate("names", start, lambda done, names: F.flatten(
        F.transform(done, lambda d: F.transform(names, lambda t: F.concat(d, F.array(t))))))
    return each.select(F.explode(combined).alias("tokens"), "confidence", "support").withColumn("tokens", F.array_sort("tokens"))


def matched_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``(row, n_rules, confidence)`` of the pages that some rule fits, by an inverted index on each rule's rarest token."""
    looked = (pages.select("row", F.col("tokens").alias("_has"), F.explode("tokens").alias("token"))
              .join(_filed(rules, _token_counts(pages)), "token").filter(F.size(F.array_except("_rule", "_has")) == 0))
    return looked.groupBy("row").agg(F.count(F.lit(1)).alias("n_rules"), F.max("_sure").alias("confidence"))


def judge_urls(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url", label_id: str = "doc_id",
               bad: Column | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, n_rules, confidence.

    ``bad`` is the condition over ``labels`` that marks a bad page; a page
    that has several labels is bad if one of them is. ``n_rules`` counts rules
    over items: tokens that always come together on labelled pages are one.
    """
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1) if bad is None else bad
    urls = parsed(pages, page_id, url)
    marks = (labels.select(F.col(label_id).cast("long").alias("page_id"), F.coalesce(bad, F.lit(False)).alias("bad"))
             .groupBy("page_id").agg(F.max("bad").alias("bad")))
    rules, items = mine_items(urls.select("page_id", "tokens").join(marks, "page_id").select("tokens", "bad"))
    # a page has an item if it has one of its tokens; items that no rule asks for are not looked up
    asked = items.join(rules.select(F.explode("tokens").alias("item")).distinct(), "item", "left_semi")
    found = urls.join(matched_rules(stage(as_items(urls, asked, "row"), "url-page-items"), rules), "row", "left")
    return found.select(
        "page_id", "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce(F.col("listed.verdict"), F.when(F.col("n_rules") > 0, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.coalesce("n_rules", F.lit(0)).cast("long").alias("n_rules"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))

"""Secret scans (operator 1): corpus-wide ownership frequency.

Candidates are found in every whole text by four patterns. The value of each
is hashed, and hashes are aggregated over the whole corpus by distinct owner
and distinct repository: a value of many owners, or of many repositories of
few owners, is a widely copied example; a value that one owner alone has in few
repositories, and that looks random, is a live credential. Both are only
judgements of who has a value: ``redact`` leaves no value of a base kind that
looks random in clear, however widely it is copied.
The base kinds (assign, access, hex) are always reported; the generic kind
(token) only where the ownership count says owner-specific and live-looking.

Only built-in Spark expressions run. Each text is scanned once; what is found
(matches and the lengths between them) is written to the shared folder, and
frequencies and positions come from there. Distinct counts are taken in
steps, each combined before its shuffle, so a value that fills a third of all
rows costs one row per task.

Defined cases: NULL text is read as empty; a NULL owner or repository counts
as one owner of its own; repeated rows and NULL ids are reported row by row;
columns of the same names are ignored; an empty table gives no rows.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickroll.llm.common import stage, whole_text

# kind, pattern, least length of the value; in the order in which kinds are listed
KEYWORDS = ("[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
            "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]")
ASSIGN = f"""({KEYWORDS})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [("assign", ASSIGN, 12), ("access", "AKIA[A-Z0-9]+", 18), ("hex", "[0-9a-f]+", 16), ("token", "[A-Za-z0-9_-]+", 20)]
# The same matches with the least length in the pattern, where a run that is
# too short can hold no other match: the scan then skips every ordinary word.
SCANNED = {"access": "AKIA[A-Z0-9]{14,}", "hex": "[0-9a-f]{16,}", "token": "[A-Za-z0-9_-]{20,}"}
BASE = ["assign", "access", "hex"]

MAX_OWNERS = 1          # owners of an owner-specific value
COPIED_OWNERS = 3       # owners, or
COPIED_REPOSITORIES = 4  # (owner, repository) pairs, from which a value is a widely copied example
LEAST_DISTINCT = 8      # different characters of a value that looks random
PLACEHOLDERS = "(?i)example|sample|dummy|changeme|placeholder|xxxx|your_"


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source",
         repository: str | None = "lang") -> DataFrame:
    """One row per document: what each pattern matched, and the code points between matches."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("_t"), F.col(owner).cast("string").alias("owner"),
        (F.col(repository) if repository else F.lit("")).cast("string").alias("repository"))
    for kind, pattern, _ in KINDS:
        rows = rows.withColumn(f"_{kind}", F.regexp_extract_all("_t", F.lit(SCANNED.get(kind, pattern)), F.lit(0)))
    gaps = {kind: F.when(F.size(f"_{kind}") > 0, F.transform(F.split("_t", SCANNED.get(kind, pattern), -1), F.length))
            for kind, pattern, _ in KINDS}
    found = F.array(*[F.struct(F.lit(i).alias("order"), F.col(f"_{kind}").alias("matches"), gaps[kind].alias("gaps"))
                      for i, (kind, _, _) in enumerate(KINDS)])
    return stage(rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository", F.xxhash64("_t").alias("text_key"),
        found.alias("found")), "secret-scan")


def candidates(scanned: DataFrame) -> DataFrame:
    """One row per candidate: row, owner, repository, order, start, end, value (its SHA-256) and whether it looks random."""
    kinds = scanned.select("row", "owner", "repository", F.explode("found").alias("f")).filter(F.size("f.matches") > 0)
    each = kinds.select("row", "owner", "repository", F.col("f.order").alias("order"),
                        F.posexplode(F.arrays_zip(F.col("f.matches").alias("m"), F.col("f.gaps").alias("g"))).alias("at", "x"))
    each = each.filter(F.col("x.m").isNotNull()).select(
        "row", "owner", "repository", "order", "at", F.col("x.m").alias("match"), F.col("x.g").alias("gap"))
    # running length of gaps and matches within one document and kind
    w = Window.partitionBy("row", "order").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(w).cast("long"))
    each = each.withColumn("start", F.col("end") - F.length("match"))
    secret = F.when(F.col("order") == 0, F.regexp_extract("match", ASSIGN, 2)).otherwise(F.col("match"))
    each = each.withColumn("secret", secret)
    least = F.element_at(F.create_map(*[F.lit(x) for i, (_, _, n) in enumerate(KINDS) for x in (i, n)]), F.col("order"))
    each = each.filter(F.length("secret") >= least)
    random_looking = (F.col("secret").rlike("[0-9]") & F.col("secret").rlike("[A-Za-z]")
                      & ~F.col("secret").rlike(PLACEHOLDERS)
                      & (F.size(F.array_distinct(F.split("secret", ""))) >= LEAST_DISTINCT))
    return each.select("row", "owner", "repository", "order", "start", "end", F.sha2("secret", 256).alias("value"),
                       random_looking.alias("random_looking"))


def ownership(found: DataFrame) -> DataFrame:
    """Per value: distinct owners and distinct (owner, repository) pairs in the whole corpus."""
    return (found.select("value", "owner", "repository").distinct()
            .groupBy("value", "owner").agg(F.count(F.lit(1)).alias("_n"))
            .groupBy("value").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("_n").alias("n_repositories")))


def judged_spans(scanned: DataFrame) -> DataFrame:
    """Every reported span: row, order, kind, start, end, value, random_looking, n_owners, n_repositories, verdict.

    ``verdict`` is ``copied`` (of many owners or many repositories), ``live``
    (else owner-specific and random-looking) or ``unclear``. Base kinds are all there; the generic
    kind only where it is live and not inside a base span.
    """
    found = stage(candidates(scanned), "secret-candidates")
    # written before the join: a value of very many rows is then split by Spark
    judged = found.join(stage(ownership(found), "secret-owners"), "value").withColumn(
        "verdict", F.when((F.col("n_owners") >= COPIED_OWNERS) | (F.col("n_repositories") >= COPIED_REPOSITORIES), F.lit("copied"))
        .when((F.col("n_owners") <= MAX_OWNERS) & F.col("random_looking"), F.lit("live")).otherwise(F.lit("unclear")))
    # a generic token that meets a base span says nothing new: the base spans
    # that start before its end are known from the running ends in both directions
    base_end = F.when(F.col("order") < len(BASE), F.col("end"))
    base_start = F.when(F.col("order") < len(BASE), F.col("start"))
    before = Window.partitionBy("row").orderBy("start", "order").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("row").orderBy(F.col("start").desc(), F.col("order").desc()).rowsBetween(Window.unboundedPreceding, 0)
    judged = judged.withColumn("_reached", F.max(base_end).over(before)).withColumn("_next", F.min(base_start).over(after))
    clear = (F.coalesce("_reached", F.lit(0)) <= F.col("start")) & F.coalesce(F.col("_next") >= F.col("end"), F.lit(True))
    kind = F.element_at(F.array(*[F.lit(k) for k, _, _ in KINDS]), F.col("order") + 1)
    return (judged.filter((F.col("order") < len(BASE)) | ((F.col("verdict") == "live") & clear))
            .select("row", "order", kind.alias("kind"), "start", "end", "value", "random_looking", "n_owners", "n_repositories", "verdict"))


def report(scanned: DataFrame, spans: DataFrame) -> DataFrame:
    """One row per document: counts per base kind, digests of its spans, counts per verdict, and how widely its values are shared."""
    item = F.struct("start", "order", "end", F.concat_ws(":", "kind", "start", "end").alias("said"))
    counts = [F.count(F.when(F.col("order") == i, 1)).alias(f"n_{kind}") for i, kind in enumerate(BASE)]
    each = spans.groupBy("row").agg(*counts, F.array_sort(F.collect_list(item)).alias("_spans"),
                                    F.count(F.when(F.col("verdict") == "live", 1)).alias("n_live"),
                                    F.count(F.when(F.col("verdict") == "copied", 1)).alias("n_copied"),
                                    F.max("n_owners").alias("most_owners"), F.max("n_repositories").alias("most_repositories"))
    joined = scanned.select("row", "doc_id").join(each, "row", "left")
    said = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: s["said"]))
    none = F.array().cast("array<struct<start:long,order:int,end:long,said:string>>")
    whole = F.coalesce("_spans", none)
    return joined.select("doc_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_assign", "n_access", "n_hex")],
                         F.sha2(said(F.filter(whole, lambda s: s["order"] < len(BASE))), 256).alias("base_sha256"),
                         said(whole).alias("spans"),
                         *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_live", "n_copied", "most_owners", "most_repositories")])


def redact(docs: DataFrame, mask: str = "[SECRET]", doc_id: str = "doc_id", text: str = "text", owner: str = "source",
           repository: str | None = "lang") -> DataFrame:
    """``docs`` with every span masked but widely copied values that don't look random (placeholders); other columns stay."""
    scanned = scan(docs, doc_id, text, owner, repository)
    spans = judged_spans(scanned).filter("verdict != 'copied' or random_looking")
    w = Window.partitionBy("row").orderBy("start", "order").rowsBetween(Window.unboundedPreceding, -1)
    cut = (spans.withColumn("_from", F.greatest("start", F.coalesce(F.max("end").over(w), F.lit(0))))
           .filter(F.col("end") > F.col("_from")).groupBy("row")
           .agg(F.array_sort(F.collect_list(F.struct(F.col("_from").alias("a"), F.col("end").alias("b")))).alias("_cuts")))
    where = (scanned.select("row", F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).join(cut, "row")
             .groupBy("_id", "_key").agg(F.first("_cuts").alias("_cuts")))
    # rows travel in a struct, so their columns cannot clash with the ones made here
    source = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(doc_id).cast("long").alias("_d"), whole_text(text).alias("_t"))
    joined = source.join(where, F.col("_d").eqNullSafe(F.col("_id")) & (F.xxhash64("_t") == F.col("_key")), "left")
    previous = lambda k: F.coalesce(F.get("_cuts", k - 1)["b"], F.lit(0)).cast("int")
    kept = F.transform("_cuts", lambda c, k: F.concat(
        F.substr("_t", previous(k) + 1, c["a"].cast("int") - previous(k)), F.lit(mask)))
    tail = F.substr("_t", F.element_at("_cuts", -1)["b"].cast("int") + 1)
    old = F.col("_doc").getField(text)
    masked = F.when(F.col("_cuts").isNull(), old).otherwise(F.concat(F.array_join(kept, ""), tail))
    return joined.select(*[masked.alias(c) if c == text else F.col("_doc").getField(c).alias(c) for c in docs.columns])
